r"""Personal data by a semi-Markov conditional random field.

Plain patterns with a check (address form, octets, Luhn, digit counts) give
the base spans; they always stay.  People also write ``name (at) host (dot)
org``, leave the plus sign off a phone number or put dots into a card
number.  For these a semi-Markov field chooses whole spans: every run of up
to ``MAX_TOKENS`` tokens that could be an entity of some type is a candidate
segment with features of the span as a whole (its marks, digits, length,
what stands next to it, whether a longer candidate holds it, which cue word
comes before).  A dynamic programme over the tokens picks the set of
segments and types with the highest score; entities are bounded, so it is
linear in the text.  Segments that touch a base span are left out.

The field is trained in numpy on windows around the base spans of at most
``SAMPLE_DOCS`` documents (the bound only holds for training), each also in
rewritten forms, by maximum likelihood with the forward-backward recursions.
Only text near a digit, an at sign or a written-out one can hold an entity;
the rest is skipped by a byte scan.

Bounds of the method: an added span has at most ``MAX_TOKENS`` tokens and
``MAX_CHARS`` characters (base spans have no bound), which is what makes the
programme linear; training takes at most ``TRAIN_WINDOWS`` windows of at most
``WINDOW_CHARS`` characters.

Defined cases: null and empty texts have no spans; texts of any length are
searched whole, in time linear in their length; repeated rows get equal spans; without training windows no
spans are added; empty tables give empty results; columns named like a
result are replaced.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import LONG, STRING, Slab, byte_table, field, map_text

KINDS = ["email", "ip", "card", "phone"]
SAMPLE_DOCS = 3_000
TRAIN_WINDOWS = 900
MAX_TOKENS = 32
MAX_CHARS = 96
CONTEXT = 30
WINDOW_CHARS = 600

# The base patterns.  The lookbehind and the possessive
# quantifiers change no match; they keep long digit runs linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(ch for ch in s if "0" <= ch <= "9")


def octets(s: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in re.findall(r"[0-9]+", s)))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from their at signs."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The base spans of a text by kind."""
    cards = [(m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    phones = [(m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15] if "+" in text else []
    ips = [(m.start(), m.end()) for m in IP.finditer(text) if octets(m[0])]
    return {"email": emails(text), "ip": ips, "card": cards, "phone": phones}


# What a segment must look like to be of a kind at all, rewritten forms included.
SHAPES = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*\s?(?:@|\(at\)|\[at\])\s?[A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\])\s?[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[\x20./-]?[0-9])+"),
    "phone": re.compile(r"\+?\(?[0-9][\x20().0-9/-]*[0-9]"),
}
INTEREST = re.compile(r"[0-9@]|[(\[]at[)\]]")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.DOTALL)
# Words that announce an entity of a kind.
CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
        "card": ("card", "visa", "credit", "account"), "phone": ("phone", "tel", "call", "fax", "mobile")}
N_FEATURES = 19


def possible(kind: str, s: str) -> bool:
    if not SHAPES[kind].fullmatch(s):
        return False
    if kind == "email":
        return True
    d = digits_of(s)
    if kind == "ip":
        return octets(s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15 and s.count("(") == s.count(")") and any(ch in "+()-/. " for ch in s)


def segments(text: str) -> tuple[int, list[tuple[int, int, str, np.ndarray, int, int]]]:
    """Number of tokens and the candidate segments: token from and to, kind, features, character from and to."""
    cuts = [m.start() for m in TOKEN.finditer(text)] + [len(text)]
    n, found = len(cuts) - 1, []
    for i in range(n):
        first = text[cuts[i]]
        if not (first.isascii() and (first.isalnum() or first in "+(")):
            continue
        for j in range(i + 1, min(n, i + MAX_TOKENS) + 1):
            a, b = cuts[i], cuts[j]
            if b - a > MAX_CHARS:
                break
            last = text[b - 1]
            if b - a < 7 or not (last.isascii() and last.isalnum()):
                continue
            s = text[a:b]
            if not INTEREST.search(s):
                continue
            found += [(i, j, kind, a, b) for kind in KINDS if possible(kind, s)]
    # Candidates come by their start: what ends farthest among those that start before, and among those that start there.
    out, held = [], _held(found)
    for (i, j, kind, a, b), inner in zip(found, held, strict=True):
        s, before, after = text[a:b], text[max(0, a - 1): a], text[b: b + 1]
        lead = text[max(0, a - 20): a].lower()
        x = [1, s[0] == "+", "(" in s, " " in s, "-" in s, "." in s, "@" in s, "(at)" in s or "[at]" in s,
             len(digits_of(s)) / 16, bool(before) and (before.isalnum() or before in "._%+-@="), bool(after) and (after.isalnum() or after in "@_=-"),
             not before or before.isspace(), not after or after.isspace() or after in ".,;:!?)", (j - i) / MAX_TOKENS,
             inner, any(c in lead for c in CUES["email"]), any(c in lead for c in CUES["ip"]),
             any(c in lead for c in CUES["card"]), any(c in lead for c in CUES["phone"])]
        out.append((i, j, kind, np.array(x, dtype=np.float64), a, b))
    return n, out


def _held(found: list[tuple]) -> list[bool]:
    """Whether another candidate of the same kind holds each; ``found`` ascends by start."""
    farthest: dict[tuple[int, str], int] = {}
    for i, j, kind, _, _ in found:
        farthest[i, kind] = max(j, farthest.get((i, kind), j))
    before, at, out = dict.fromkeys(KINDS, -1), {}, []
    for i, j, kind, _, _ in found:
        start, reach = at.get(kind, (i, -1))
        if start < i:
            before[kind] = max(before[kind], reach)
        at[kind] = (i, farthest[i, kind])
        out.append(before[kind] >= j or farthest[i, kind] > j)
    return out


def windows(text: str) -> list[tuple[int, int]]:
    """Character ranges that hold all text near a possible entity, grown to white space."""
    out = []
    for m in INTEREST.finditer(text):
        a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    grown = []
    for a, b in out:
        while a > 0 and b - a < 400 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b - a < 400 and not text[b].isspace():
            b += 1
        if grown and a < grown[-1][1]:
            grown[-1] = (grown[-1][0], max(b, grown[-1][1]))
        else:
            grown.append((a, b))
    return grown


def best_segments(n: int, segs: list, scores: list[float]) -> list[int]:
    """The non-overlapping segments with the highest total score (outside costs nothing)."""
    ending: dict[int, list[int]] = {}
    for k, s in enumerate(segs):
        ending.setdefault(s[1], []).append(k)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in ending.get(j, ()):
            total = best[segs[k][0]] + scores[k]
            if total > best[j]:
                best[j], back[j] = total, k
    out, j = [], n
    while j > 0:
        k = back[j]
        if k >= 0:
            out.append(k)
            j = segs[k][0]
        else:
            j -= 1
    return out[::-1]


def marginals(n: int, segs: list, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Log partition and each segment's probability, by forward and backward sums."""
    ending, starting = {}, {}
    for k, s in enumerate(segs):
        ending.setdefault(s[1], []).append(k)
        starting.setdefault(s[0], []).append(k)
    alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
    for j in range(1, n + 1):
        ks = ending.get(j)
        alpha[j] = alpha[j - 1] if ks is None else np.logaddexp.reduce([alpha[j - 1], *(alpha[segs[k][0]] + scores[k] for k in ks)])
    for i in range(n - 1, -1, -1):
        ks = starting.get(i)
        beta[i] = beta[i + 1] if ks is None else np.logaddexp.reduce([beta[i + 1], *(beta[segs[k][1]] + scores[k] for k in ks)])
    return alpha[n], np.exp([alpha[s[0]] + scores[k] + beta[s[1]] - alpha[n] for k, s in enumerate(segs)])


def rewritten(kind: str, s: str) -> list[str]:
    """Other ways to write an entity, for training."""
    if kind == "email":
        name, _, host = s.rpartition("@")
        return [f"{name} (at) {host.replace('.', ' (dot) ')}", f"{name}[at]{host}", f"{name} [at] {host.replace('.', '[dot]')}"]
    if kind == "ip":
        return [s.replace(".", "[.]")]
    if kind == "card":
        d = digits_of(s)
        return [sep.join(d[k: k + 4] for k in range(0, len(d), 4)) for sep in (".", " ", "/")]
    bare = re.sub(r"^\+[0-9]{1,2}[\x20.-]?", "", s)
    return [x for x in (bare, bare.replace(" ", "-"), re.sub(r"[() ]+", ".", bare).strip("."), s[1:]) if 9 <= len(digits_of(x)) <= 15]


def train_field(examples: list[tuple[str, list[tuple[str, int, int]]]], steps: int = 25, rate: float = 0.3, decay: float = 0.002) -> np.ndarray:
    """Weights (kind, feature) by stochastic gradient ascent (Adagrad) on the likelihood of the examples' segmentations."""
    prepared = []
    for text, gold in examples:
        n, segs = segments(text)
        want = {(a, b, k) for k, a, b in gold}
        y = np.array([(s[4], s[5], s[2]) in want for s in segs], dtype=np.float64)
        # A window whose entities are not all candidates (too long, say) has no segmentation to learn from.
        if segs and y.sum() == len(want):
            prepared.append((n, segs, np.array([KINDS.index(s[2]) for s in segs]), np.stack([s[3] for s in segs]), y))
    w, squares = np.zeros((len(KINDS), N_FEATURES)), np.full((len(KINDS), N_FEATURES), 1e-3)
    for _ in range(steps):
        for n, segs, kind, x, y in prepared:
            _, p = marginals(n, segs, (w[kind] * x).sum(axis=1))
            g = np.zeros_like(w)
            np.add.at(g, kind, (y - p)[:, None] * x)
            g -= decay * w
            squares += g * g
            w += rate * g / np.sqrt(squares)
    return w


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], w: np.ndarray) -> list[tuple[str, int, int]]:
    """What the field finds beside the base spans."""
    # The base spans as stretches that do not overlap, so that a place is looked up among their ends.
    starts, ends = [], []
    for p, q in sorted(s for spans in base.values() for s in spans):
        if ends and p < ends[-1]:
            ends[-1] = max(ends[-1], q)
        else:
            starts.append(p)
            ends.append(q)

    def free(p: int, q: int) -> bool:
        k = bisect_right(ends, p)
        return k == len(ends) or starts[k] >= q

    out = []
    for a, b in windows(text):
        _, segs = found = segments(text[a:b])
        segs = [s for s in segs if free(a + s[4], a + s[5])]
        if segs:
            scores = [float(w[KINDS.index(s[2])] @ s[3]) for s in segs]
            out += [(segs[k][2], a + segs[k][4], a + segs[k][5]) for k in best_segments(found[0], segs, scores)]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


MARKS = byte_table(b"0123456789@")


def texts_with_marks(slab: Slab):
    """Index and text of those texts that can hold a span."""
    raw = slab.buf.tobytes()
    some = slab.per_doc(MARKS[slab.buf]) > 0
    if b"(at)" in raw or b"[at]" in raw:
        some |= np.array([b"(at)" in raw[a:b] or b"[at]" in raw[a:b] for a, b in zip(slab.off[:-1], slab.off[1:], strict=True)])
    for k in np.flatnonzero(some):
        yield int(k), raw[slab.off[k]: slab.off[k + 1]].decode("utf-8", "replace")


def training_slab(slab: Slab) -> list:
    """Windows around base spans: text index, window, and its spans (joined)."""
    doc, text_of, spans_of = [], [], []
    for k, text in texts_with_marks(slab):
        base = base_spans(text)
        if not any(base.values()):
            continue
        ordered = sorted((p, q, kind) for kind, spans in base.items() for p, q in spans)
        for a, b in windows(text):
            inside = [(kind, p - a, q - a) for p, q, kind in ordered[bisect_left(ordered, (a,)): bisect_left(ordered, (b,))] if q <= b]
            free, last = [], -1
            for s in sorted(inside, key=lambda s: (s[1], -s[2])):
                if s[1] >= last:
                    free.append(s)
                    last = s[2]
            if b - a <= WINDOW_CHARS:
                doc.append(k)
                text_of.append(text[a:b])
                spans_of.append(joined(free))
    return [np.array(doc, dtype=np.int64), text_of, spans_of]


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS) -> np.ndarray:
    """The field's weights, from the base spans of a bounded sample."""
    some = docs.select(F.xxhash64(id_col, text).alias("key"), F.col(text).alias("text")).where(F.col("text").rlike(r"@|[0-9]{3}"))
    # The rows are chosen by hash alone; only the texts of those chosen (``sample`` at most) are moved.
    chosen = some.select("key").orderBy("key").limit(sample).distinct()
    some = some.join(F.broadcast(chosen), "key", "left_semi").dropDuplicates(["key"])
    got = map_text(some, "text", [], [field("window", STRING), field("spans", STRING)], lambda: training_slab, explode=True)
    rows = sorted({(r["window"], r["spans"]) for r in got.orderBy(F.xxhash64("window"), "window").limit(TRAIN_WINDOWS).collect()})
    examples = []
    for k, (window, spans) in enumerate(rows):
        gold = [(p[0], int(p[1]), int(p[2])) for p in (s.split(":") for s in spans.split(",") if s)]
        examples.append((window, gold))
        for m, (kind, a, b) in enumerate(gold[:2]):
            forms = rewritten(kind, window[a:b])
            if forms:
                new = forms[(k + m) % len(forms)]
                # Every other span of the window moves with the text.
                shift = len(new) - (b - a)
                moved = [(x, p + shift * (p >= b), q + shift * (p >= b)) if (p, q) != (a, b) else (x, a, a + len(new)) for x, p, q in gold]
                examples.append((window[:a] + new + window[b:], moved))
    return train_field(examples)


def find_pii(docs: DataFrame, weights: np.ndarray | None = None, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_sha256, spans (all, joined) and span_list (structs)."""
    span = T.StructType([T.StructField("kind", STRING), T.StructField("start", LONG), T.StructField("end", LONG)])
    fields = [field(f"n_{k}", LONG) for k in KINDS] + [field("base_sha256", STRING), field("spans", STRING), field("span_list", T.ArrayType(span))]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(slab: Slab):
        counts = [np.zeros(slab.n, dtype=np.int64) for _ in KINDS]
        nothing = hashlib.sha256(b"").hexdigest()
        digest, spans, lists = [nothing] * slab.n, [""] * slab.n, [[]] * slab.n
        for k, body in texts_with_marks(slab):
            base = base_spans(body)
            for c, name in zip(counts, KINDS, strict=True):
                c[k] = len(base[name])
            fixed = [(name, a, b) for name in KINDS for a, b in base[name]]
            digest[k] = hashlib.sha256(joined(fixed).encode()).hexdigest()
            found = fixed + (added_spans(body, base, weights) if weights is not None else [])
            spans[k] = joined(found)
            lists[k] = [{"kind": x, "start": a, "end": b} for x, a, b in sorted(found, key=lambda s: s[1:])]
        return [*counts, digest, spans, pa.array(lists, kind)]

    return map_text(docs, text, docs.columns if carry is None else carry, fields, lambda: run)


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """The texts of :func:`find_pii`'s result with ``<KIND>`` in place of each span (spans that overlap become one)."""
    piece = F.aggregate(
        "span_list",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substr(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                     F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out"), s["end"].alias("at"))
        ).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))))
    return found.withColumn("__r", piece).withColumn(
        text, F.concat("__r.out", F.substr(F.col(text), (F.col("__r.at") + 1).cast("int")))).drop("__r")


def op10_semi_crf_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = find_pii(docs, train(docs), carry=["doc_id"])
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans")

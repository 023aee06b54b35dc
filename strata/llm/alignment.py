r"""Alignment of two tokenizers over the same texts, by pointer jumping.

Both tokenizers read a space and the text.  The byte offsets where tokens of
both end cut a text into groups: the connected components of overlapping
tokens.  Every token points to the token that overlaps it and reaches
farthest right (of two that end alike, the second tokenizer's); doubling the
successors (``succ = succ[succ]``) until nothing changes brings every token to
the last one of its component, which labels the group.  All tokens of a
slab's new units are jumped together, in numpy.

A text is cut into units where neither tokenizer joins characters: before
white space that follows something else (only such white space as the second
vocabulary has in no piece but at its start), and nowhere in texts with white
space beyond ASCII.  So a unit's tokens are the same alone as in its text, and
a worker tokenises and aligns each different unit once.

Links are all pairs of an A and a B token in one group; an id pair's count is
the number of documents that have it linked.  Within a group, equal ids are
counted before they are paired, and a document hands on each of its id pairs
once, with the times it occurs.  Texts are tokenised once; the table of links
is written to the shared folder, its pairs are counted (combined map-side),
and then each document's links meet their counts:

* the most frequent pairs, ``TOP_PAIRS`` at most, are broadcast.  What to take
  is read off a histogram of the counts, so the number is known before;
* all other links go through a join on the pair.  None of those pairs is
  frequent, so the join has no hot key.

Defined cases: null and empty texts, and texts that a tokenizer does not give
back byte for byte, have no tokens: zeros and an empty string; strings of
special tokens in a text are plain text; texts of any length are aligned
whole; repeated rows count as documents of their own; an empty table gives no
rows; columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .arrays import LONG, STRING, Slab, byte_table, field, map_text, worker_cache
from .packing import tokenizer_path

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Pairs whose counts are broadcast, at most.
TOP_PAIRS = 1 << 20
#: Units that a worker remembers.
MAX_UNITS = 250_000
#: Steps of the histogram of counts for each doubling.
STEPS = 8

WHITE = byte_table(bytes([9, 10, 11, 12, 13, 32]))
SPACE = "▁"
RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_level(entry: str) -> bytes:
    """The bytes of a byte-level vocabulary entry: printable Latin-1 characters stand for themselves, the others for 256, 257 ..."""
    return bytes(_byte_of()[c] for c in entry)


def _byte_of() -> dict[str, int]:
    cache = worker_cache()
    if "byte_of" not in cache:
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        rest = [b for b in range(256) if b not in set(own)]
        cache["byte_of"] = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}
    return cache["byte_of"]


class Vocabularies:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        added = self.a.get_added_tokens_decoder()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, k in self.a.get_vocab().items():
            self.bytes_a[k] = entry.encode() if k in added else byte_level(entry)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(k) else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.space = self.b.piece_to_id(SPACE)
        # White space that a piece has elsewhere than at its start, after something else, cuts nothing.
        inside = {c for p in pieces for k, c in enumerate(p) if k and p[k - 1] != c}
        self.cuts = [c for c in " \n\t" if (SPACE if c == " " else c) not in inside]

    def encode_a(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]

    def encode_b(self, units: list[str]) -> list[list[int]]:
        """Ids of units as they stand: the tokenizer puts a space before each, which is the unit's own or goes again."""
        got = self.b.encode([u[1:] if u[:1] == " " else u for u in units], num_threads=1)
        return [ids or [self.space] if u[:1] == " " else ids[1:] for u, ids in zip(units, got, strict=True)]


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The label of each A and each B token: the B token at which its component ends.

    The tokens of either side cover the same bytes; ``ends`` are where they end.
    """
    n = len(ends_a)
    over_a = n + np.searchsorted(ends_b, ends_a)
    at = np.searchsorted(ends_a, ends_b)
    over_b = np.where(ends_a[at] > ends_b, at, n + np.arange(len(ends_b))) if n else at
    succ = np.concatenate([over_a, over_b])
    while True:
        twice = succ[succ]
        if np.array_equal(twice, succ):
            return succ[:n] - n, succ[n:] - n
        succ = twice


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers end to end, and how many each list has."""
    n = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(n.sum())), n


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first .. first + count - 1`` of each range, end to end."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


def _distinct(group: np.ndarray, ids: np.ndarray, n_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and times of the different ids of each group, by group."""
    both, times = np.unique(group * n_ids + ids, return_counts=True)
    return both // n_ids, both % n_ids, times


class Units:
    """Tokens, groups and links of all units that a worker has seen."""

    def __init__(self, path_a: str, path_b: str):
        self.words = Vocabularies(path_a, path_b)
        self.size_b = len(self.words.bytes_b)
        self.spelling = np.array([[f"{k}{mark}" for k in range(max(len(self.words.bytes_a), self.size_b))] for mark in ",|;"], dtype=object)
        self.clear()

    def clear(self):
        # Hashes of the units in order, and the row of each.
        self.known, self.known_row = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        # For each unit: valid, A tokens, B tokens, groups, links; its groups as text; its pairs and their times.
        self.facts = np.zeros((0, 5), dtype=np.int64)
        self.text: list[str] = []
        self.keys, self.times, self.off = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def rows(self, slab: Slab, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The row of each unit, new ones aligned first."""
        keys, at, inverse = np.unique(slab.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > MAX_UNITS:
            self.clear()
        place = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != keys[inside]
        if new.any():
            raw, n = slab.buf.tobytes(), len(self.text)
            self.add([raw[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
            self.known, self.known_row = (np.insert(have, place[new], more) for have, more in (
                (self.known, keys[new]), (self.known_row, np.arange(n, len(self.text)))))
        return self.known_row[np.searchsorted(self.known, keys)][inverse]

    def add(self, units: list[bytes]) -> None:
        words = self.words
        texts = [u.decode("utf-8", "replace") for u in units]
        ids_a, ids_b = words.encode_a(texts), words.encode_b(texts)
        whole = self._whole(units, ids_a, words.bytes_a, words.length_a) & self._whole(units, ids_b, words.bytes_b, words.length_b)
        if not whole.all():
            ids_a = [a if ok else [] for ok, a in zip(whole, ids_a, strict=True)]
            ids_b = [b if ok else [] for ok, b in zip(whole, ids_b, strict=True)]
        (a, n_a), (b, n_b) = _flat(ids_a), _flat(ids_b)
        label_a, label_b = jump(np.cumsum(words.length_a[a]), np.cumsum(words.length_b[b]))
        # Groups by number, and the unit of each.
        last, group_b = np.unique(label_b, return_inverse=True)
        group_a = np.searchsorted(last, label_a)
        unit = np.repeat(np.arange(len(units)), n_b)[last]
        in_a, in_b = np.bincount(group_a, minlength=len(last)), np.bincount(group_b, minlength=len(last))
        n_groups = np.bincount(unit, minlength=len(units))
        n_links = np.zeros(len(units), dtype=np.int64)
        np.add.at(n_links, unit, in_a * in_b)
        self.facts = np.concatenate([self.facts, np.stack([whole, n_a, n_b, n_groups, n_links], axis=1)])
        self._spell(a, b, group_a, group_b, in_a, in_b, n_a + n_b)
        self._pair(a, b, group_a, group_b, unit, len(units))

    @staticmethod
    def _whole(units: list[bytes], ids: list[list[int]], token: list[bytes], length: np.ndarray) -> np.ndarray:
        """Whether the tokens give back each unit."""
        flat, n = _flat(ids)
        size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        ends = np.concatenate([[0], np.cumsum(length[flat])])[np.cumsum(n)]
        # All at once if they do, else unit by unit.
        if np.array_equal(ends, np.cumsum(size)) and b"".join([token[k] for k in flat.tolist()]) == b"".join(units):
            return np.ones(len(units), dtype=bool)
        return np.array([b"".join([token[k] for k in x]) == u for u, x in zip(units, ids, strict=True)], dtype=bool)

    def _spell(self, a, b, group_a, group_b, in_a, in_b, n_tokens) -> None:
        """Each unit's groups as text: all tokens in order, each with the mark that follows it."""
        size = len(a) + len(b)
        at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
        at_b = np.arange(len(b)) + np.cumsum(in_a)[group_b]
        marked = np.zeros(size, dtype=np.int64)
        marked[at_a], marked[at_b] = a, b
        # 0, 1, 2: more of the same side, then the other side, then the next group.
        mark = np.zeros(size, dtype=np.int64)
        mark[at_a[np.cumsum(in_a) - 1]] = 1
        mark[at_b[np.cumsum(in_b) - 1]] = 2
        spelled = self.spelling[mark, marked].tolist()
        hi = 0
        for n in n_tokens.tolist():
            lo, hi = hi, hi + n
            self.text.append("".join(spelled[lo:hi])[:-1])

    def _pair(self, a, b, group_a, group_b, unit, n_units) -> None:
        g_a, id_a, times_a = _distinct(group_a, a, len(self.words.bytes_a))
        g_b, id_b, times_b = _distinct(group_b, b, self.size_b)
        first, count = np.searchsorted(g_b, g_a), np.searchsorted(g_b, g_a, "right") - np.searchsorted(g_b, g_a)
        left, right = np.repeat(np.arange(len(g_a)), count), _ragged(first, count)
        key, times = id_a[left] * self.size_b + id_b[right], times_a[left] * times_b[right]
        owner = unit[g_a[left]]
        order = np.lexsort((key, owner))
        key, times, owner = key[order], times[order], owner[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(new)
        self.keys = np.concatenate([self.keys, key[begin]])
        self.times = np.concatenate([self.times, np.add.reduceat(times, begin) if len(begin) else times])
        self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(np.bincount(owner[begin], minlength=n_units))])


def spaced(slab: Slab) -> Slab:
    """The slab with a space before each text."""
    buf = np.insert(slab.buf, slab.off[:-1], np.uint8(32))
    return Slab(buf, slab.off + np.arange(slab.n + 1))


def unit_bounds(slab: Slab, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of each text, in order."""
    buf, off, n = slab.buf, slab.off, slab.n
    white = WHITE[buf]
    cut = byte_table("".join(cuts).encode())[buf] if cuts else np.zeros(len(buf), dtype=bool)
    cut[1:] &= ~white[:-1]
    # White space beyond ASCII, and the four separators that libraries judge differently: such a text stays whole.
    odd = (buf >= 0x1C) & (buf <= 0x1F)
    b1, b2 = np.append(buf[1:], 0)[: len(buf)], np.append(buf[2:], [0, 0])[: len(buf)]
    odd |= (buf == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))
    odd |= ((buf == 0xE1) | (buf == 0xE2) | (buf == 0xE3)) & ((b1 == 0x9A) | (b1 == 0x80) | (b1 == 0x81)) & (b2 <= 0xAF)
    whole = slab.per_doc(odd) > 0
    if whole.any():
        cut &= ~np.repeat(whole, np.diff(off))
    cut[off[:-1]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], len(buf))


def align_slab(slab: Slab, units: Units, keep_groups: bool) -> list:
    """Per text: A tokens, B tokens, groups, links, the groups' hash (and text), its pairs and their times."""
    empty = np.diff(slab.off) == 0
    slab = spaced(slab)
    starts, ends = unit_bounds(slab, units.words.cuts)
    rows = units.rows(slab, starts, ends)
    first = np.searchsorted(starts, slab.off)
    doc = np.repeat(np.arange(slab.n), np.diff(first))
    facts = units.facts[rows]
    ok = ~empty & (np.bincount(doc, facts[:, 0] == 0, minlength=slab.n) == 0)
    total = np.zeros((slab.n, 5), dtype=np.int64)
    np.add.at(total, doc, facts)
    total[~ok] = 0
    spelled, hashed = [], []
    listed, text = rows.tolist(), units.text
    for k, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        s = ";".join([text[r] for r in listed[lo:hi]]) if ok[k] else ""
        hashed.append(hashlib.sha256(s.encode()).hexdigest() if s else "")
        spelled.append(s if keep_groups else None)
    # A text's different units, then their pairs, then its different pairs.
    n_rows = len(text)
    both, often = np.unique(doc[ok[doc]] * n_rows + rows[ok[doc]], return_counts=True)
    owner, row = both // n_rows, both % n_rows
    count = units.off[row + 1] - units.off[row]
    at = _ragged(units.off[row], count)
    key, times, owner = units.keys[at], units.times[at] * np.repeat(often, count), np.repeat(owner, count)
    span = len(units.words.bytes_a) * units.size_b
    order = np.argsort(owner * span + key, kind="stable")
    key, times, owner = key[order], times[order], owner[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    begin = np.flatnonzero(new)
    times = np.add.reduceat(times, begin) if len(begin) else times
    off = pa.array(np.searchsorted(owner[begin], np.arange(slab.n + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(off, pa.array(x, pa.int64())) for x in (key[begin], times)]
    return [*total[:, 1:].T, hashed, *([spelled] if keep_groups else []), *lists]


def align(docs: DataFrame, text: str = "text", carry: list[str] | None = None, path_a: str | None = None,
          path_b: str | None = None, keep_groups: bool = False) -> DataFrame:
    """The ``carry`` columns with n_a, n_b, n_groups, n_links, groups_sha256, links (pairs as A id * size of B + B id) and times.

    With ``keep_groups`` also groups: ``a1,a2|b1;a3|b2,b3``.
    """
    path_a, path_b = path_a or tokenizer_path(VOCABULARY_A), path_b or tokenizer_path(VOCABULARY_B)
    longs = T.ArrayType(LONG, False)
    fields = [*[field(c, LONG) for c in RESULTS[:4]], field("groups_sha256", STRING), *([field("groups", STRING)] if keep_groups else []),
              field("links", longs), field("times", longs)]

    def make():
        cache = worker_cache()
        units = cache.get(("units", path_a, path_b)) or cache.setdefault(("units", path_a, path_b), Units(path_a, path_b))
        return lambda slab: align_slab(slab, units, keep_groups)

    return map_text(docs, text, docs.columns if carry is None else carry, fields, make)


def vocabulary_sizes(path_a: str | None = None, path_b: str | None = None) -> tuple[int, int]:
    words = Vocabularies(path_a or tokenizer_path(VOCABULARY_A), path_b or tokenizer_path(VOCABULARY_B))
    return len(words.bytes_a), len(words.bytes_b)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """key, n (documents that hold the pair linked) and best (n is the highest of the pair's A id)."""
    counts = aligned.select(F.explode("links").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")) \
                    .withColumn("a", F.floor(F.col("key") / F.lit(size_b)).cast("int")).checkpoint()
    # A row for each id of the vocabulary at most.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("__most")))
    return counts.join(highest, "a").select("key", "n", (F.col("n") == F.col("__most")).alias("best"))


def _step() -> F.Column:
    return F.floor(F.log2(F.col("n").cast("double")) * F.lit(STEPS)).cast("int")


def frequent(counts: DataFrame, top: int = TOP_PAIRS) -> int:
    """The least step of the histogram of counts from which on there are at most ``top`` pairs."""
    steps = counts.groupBy(_step().alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    seen, least = 0, 64 * STEPS
    for step, pairs in sorted(((r["step"], r["pairs"]) for r in steps), reverse=True):
        seen += pairs
        if seen > top:
            break
        least = step
    return least


def with_counts(aligned: DataFrame, counts: DataFrame, top: int = TOP_PAIRS) -> DataFrame:
    """``aligned`` (a written table) without links and times, with n_best and count_sum."""
    least = frequent(counts, top)
    known = counts.where(_step() >= least).toPandas().sort_values("key")
    keys, n, best = (known[c].to_numpy(dtype=k) for c, k in (("key", np.int64), ("n", np.int64), ("best", bool)))
    own = [c for c in aligned.columns if c not in ("links", "times")]
    longs = T.ArrayType(LONG, False)
    fields = [field(c, LONG) for c in ("n_best", "count_sum")] + [field(c, longs) for c in ("links", "times")]
    schema = T.StructType([aligned.schema[c] for c in own] + fields)

    def run(batches):
        for batch in batches:
            links, times = batch.column(len(own)), batch.column(len(own) + 1)
            off = links.offsets.to_numpy().astype(np.int64)
            off, key = off - off[0], links.flatten().to_numpy()
            many = times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), dtype=bool)
            sums = []
            for value in (np.where(hit, best[at], False) * many, np.where(hit, n[at], 0) * many) if len(keys) else (np.zeros(len(key), dtype=np.int64),) * 2:
                total = np.concatenate([[0], np.cumsum(value)])
                sums.append(pa.array(total[off[1:]] - total[off[:-1]], pa.int64()))
            left = np.concatenate([[0], np.cumsum(~hit)])[off]
            rest = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~hit], pa.int64())) for x in (key, many)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(own))], *sums, *rest], names=schema.names)

    part = aligned.select(*own, "links", "times").mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    rest = part.select("__row", F.explode(F.arrays_zip("links", "times")).alias("x")).select("__row", "x.links", "x.times")
    rare = counts.where(_step() < least)
    more = rest.hint("merge").join(rare, rest["links"] == rare["key"]).groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"), F.sum(F.col("n") * F.col("times")).alias("__sum"))
    out = part.drop("links", "times").join(more, "__row", "left")
    return out.select(*[F.col(f"`{c}`") for c in own], (F.col("n_best") + F.coalesce("__best", F.lit(0))).alias("n_best"),
                      (F.col("count_sum") + F.coalesce("__sum", F.lit(0))).alias("count_sum"))


def aligned_documents(docs: DataFrame, text: str = "text", carry: list[str] | None = None, path_a: str | None = None,
                      path_b: str | None = None, keep_groups: bool = False, top: int = TOP_PAIRS) -> DataFrame:
    """The ``carry`` columns of all documents with RESULTS (and groups)."""
    spark = docs.sparkSession
    carry = [c for c in (docs.columns if carry is None else carry) if c not in (*RESULTS, "links", "times", "groups")]
    path = scratch_path(spark, "alignment")
    align(docs, text, carry, path_a, path_b, keep_groups).write.option("compression", "zstd").parquet(path)
    aligned = spark.read.parquet(path)
    counts = pair_counts(aligned, vocabulary_sizes(path_a, path_b)[1])
    return with_counts(aligned, counts, top)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: how a byte-level and a piece vocabulary align on them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return aligned_documents(docs, carry=["doc_id"]).select("doc_id", *RESULTS)

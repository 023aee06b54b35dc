r"""Toxicity by non-negative positive-unlabelled learning.

The confirmed toxic texts are positives; the sampled other texts count as
unlabelled, whatever their label says, for a label 0 may only mean that
nobody found the insult.  The class prior is the share of confirmed toxic
rows among the labelled training rows.

1. Words (and their first 4, 5 and 6 bytes) get evidence: the log ratio of
   their document rates among positives and negatives, where the negative
   rate is the unlabelled one less the positives hidden in it, and never
   less than zero.  It is lowered by two standard errors, so that rare words
   say nothing.
2. A logistic classifier over the pooled evidence of a text (its strongest
   words, how many there are, how dense they are) is trained in numpy on the
   non-negative risk: prior * R+(positives) + max(0, R-(unlabelled) - prior *
   R-(positives)); where the second part turns negative its gradient is
   reversed.  Evidence used in training comes from the other half of the
   sample, so a text never meets evidence it gave itself.

Scoring is one pass over whole texts with a table of at most
``MAX_EVIDENCE`` words.

Defined cases: null and empty texts get the score of a text without words;
texts of any length are scored whole; repeated rows get equal scores; without
a positive or an unlabelled sample every score is the prior (0 if there are
no labels); columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM_WORD, BINARY, DOUBLE, LONG, Slab, doc_of, field, map_text, mix64, own_columns
from .labelled import held_out, labelled_sample

#: Sampled texts of each class, at most.
SAMPLE = 12_000
#: Words and prefixes with evidence, at most.
MAX_EVIDENCE = 50_000
THRESHOLD = 0.3
PREFIXES = (4, 5, 6)


def word_features(slab: Slab) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of each word and of its prefixes (a shorter word stands for itself), and the first word of each text."""
    starts, ends, first = slab.words(ALNUM_WORD)
    out = [slab.hashes(starts, ends, lower=True)]
    for k in PREFIXES:
        out.append(mix64(slab.hashes(starts, np.minimum(ends, starts + k), lower=True) + np.uint64(k)))
    return out, first


def distinct_slab(slab: Slab) -> list[np.ndarray]:
    """Text index and feature, once per text."""
    hashes, first = word_features(slab)
    doc = doc_of(first)
    pairs = np.unique(np.rec.fromarrays([np.tile(doc, len(hashes)), np.concatenate(hashes).view(np.int64)], names="d,h"))
    return [pairs["d"], pairs["h"]]


def evidence(pos: np.ndarray, unl: np.ndarray, n_pos: float, n_unl: float, prior: float) -> np.ndarray:
    """Lower bound of the log rate ratio of positives and prior-corrected negatives."""
    hidden = prior * pos / max(n_pos, 1)
    neg = np.maximum(0, (unl / max(n_unl, 1) - hidden) / max(1 - prior, 1e-6)) * max(n_pos, 1)
    return np.log((pos + 1) / (neg + 1)) - 2 * np.sqrt(1 / (pos + 1) + 1 / (neg + 1))


def pool(slab: Slab, keys: np.ndarray, weights: list[np.ndarray]) -> list[np.ndarray]:
    """For each set of weights, the pooled evidence of each text."""
    hashes, first = word_features(slab)
    n_words = np.diff(first).astype(np.float64)
    doc = doc_of(first)
    found = []
    for h in hashes:
        at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        found.append((at, keys[at] == h if len(keys) else np.zeros(len(h), dtype=bool)))
    out = []
    for w in weights:
        r = np.zeros(len(doc))
        for at, hit in found:
            r[hit] = np.maximum(r[hit], w[at[hit]])
        rows = np.flatnonzero(r > 0)
        rows = rows[np.lexsort((-r[rows], doc[rows]))]
        d = doc[rows]
        rank = np.arange(len(rows)) - np.searchsorted(d, d)
        x = np.zeros((slab.n, 9))
        for k in range(3):
            x[d[rank == k], k] = r[rows[rank == k]]
        x[:, 3] = np.log1p(np.bincount(d, r[rows], slab.n))
        for k, least in enumerate((0.5, 1.5, 3.0)):
            x[:, 4 + k] = np.log1p(np.bincount(d[r[rows] > least], minlength=slab.n))
        x[:, 7] = np.bincount(d[r[rows] > 1.5], minlength=slab.n) / np.sqrt(n_words + 1)
        x[:, 8] = np.log1p(n_words) / 10
        out.append(x)
    return out


def nnpu_fit(xp: np.ndarray, xu: np.ndarray, prior: float, steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (the last is the bias) of a logistic classifier on the non-negative risk, by Adam."""
    xp, xu = (np.hstack([x, np.ones((len(x), 1))]) for x in (xp, xu))
    w = np.zeros(xp.shape[1])
    w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        zp, zu = xp @ w, xu @ w
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
        as_pos = prior * (xp.T @ (sp - 1)) / len(xp)
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        as_neg = (xu.T @ su) / len(xu) - prior * (xp.T @ sp) / len(xp)
        g = (as_pos + as_neg if negative_risk >= 0 else -as_neg) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return w


class ToxicityModel:
    """Sorted feature hashes, their evidence, and the classifier's weights."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, classifier: np.ndarray):
        self.keys, self.weights, self.classifier = keys, weights, classifier

    def scores(self, slab: Slab) -> np.ndarray:
        x = pool(slab, self.keys, [self.weights])[0]
        z = x @ self.classifier[:-1] + self.classifier[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = SAMPLE, max_evidence: int = MAX_EVIDENCE) -> ToxicityModel:
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    prior = rows.agg(F.avg(label)).first()[0] or 0.0
    sample = labelled_sample(docs, labels, label, per_class, id_col, text)
    # Unlabelled: both classes in the corpus's proportion.  All sampled rows of class 0, and of the toxic ones as
    # many as belong to them, chosen by a hash; they count there like any other text.
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_zero = sizes.get(1, 0), sizes.get(0, 0)
    none = ToxicityModel(np.zeros(0, dtype=np.uint64), np.zeros(0), np.append(np.zeros(9), np.log(max(prior, 1e-9) / max(1 - prior, 1e-9))))
    if not n_pos or not n_zero:
        return none
    share = min(1.0, n_zero * prior / max(1 - prior, 1e-6) / n_pos)
    spread = F.pmod(F.xxhash64(F.lit(7), id_col), F.lit(1_000_000))
    sample = sample.select("text", (F.col("y") == 1).cast("int").alias("p"), ((F.col("y") == 0) | (spread < share * 1_000_000)).cast("int").alias("u"),
                           F.pmod(F.xxhash64(F.lit(11), id_col), F.lit(2)).cast("int").alias("half")).checkpoint()

    seen = map_text(sample, "text", ["p", "u", "half"], [field("h", LONG)], lambda: distinct_slab, explode=True)
    sums = [F.sum(F.when(F.col("half") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in (0, 1) for c in ("p", "u")]
    counts = seen.groupBy("h").agg(*sums).where("p0 + p1 >= 3").orderBy(F.desc(F.expr("p0 + p1 - u0 - u1")), "h").limit(max_evidence).toPandas()
    n = sample.groupBy("half").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).toPandas().set_index("half")
    size = {(c, k): float(n.loc[k, c]) if k in n.index else 0.0 for c in "pu" for k in (0, 1)}
    keys = counts["h"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys, counts = keys[order], counts.iloc[order]
    c = {name: counts[name].to_numpy(dtype=np.float64) for name in ("p0", "u0", "p1", "u1")}
    # Texts of half 0 are pooled with the evidence of half 1, and the reverse.
    weights = [evidence(c["p1"], c["u1"], size["p", 1], size["u", 1], prior), evidence(c["p0"], c["u0"], size["p", 0], size["u", 0], prior)]

    def make():
        def run(slab: Slab):
            pooled = np.stack(pool(slab, keys, weights), axis=1).astype("<f4")
            return [[x.tobytes() for x in pooled]]
        return run

    got = map_text(sample, "text", ["p", "u", "half"], [field("x", BINARY)], make).toPandas()
    x = np.stack([np.frombuffer(b, dtype="<f4").reshape(2, -1)[h] for b, h in zip(got["x"], got["half"], strict=True)]).astype(np.float64)
    classifier = nnpu_fit(x[got["p"] == 1], x[got["u"] == 1], prior)
    final = evidence(c["p0"] + c["p1"], c["u0"] + c["u1"], size["p", 0] + size["p", 1], size["u", 0] + size["u", 1], prior)
    return ToxicityModel(keys, final, classifier)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, one pass."""
    return map_text(docs, text, docs.columns if carry is None else carry, [field("score", DOUBLE)],
                    lambda: lambda slab: [model.scores(slab)])


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold."""
    model = train(docs, labels)
    return own_columns(docs, lambda own, at: score(own, model, at["text"]).where(F.col("score") < threshold))


def op2_pu_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, train(docs, labels), carry=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

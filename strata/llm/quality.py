r"""Quality by attention-based multiple-instance learning.

Labels belong to documents, but what makes one bad may sit in a few of its
passages.  Every document is a bag of passages (runs of ``PASSAGE`` words;
the whole text, so nothing is cut off).  A passage is encoded from what its
characters and words look like; a hidden layer embeds it; gated attention
(tanh times sigmoid) gives each passage of a bag its weight; a logistic
output scores the weighted mean.  Embedding, attention and output are learnt
together in numpy from the documents' labels alone.

Training reads at most ``SAMPLE`` labelled documents of each class and at
most ``TRAIN_PASSAGES`` evenly spread passages of each; scoring reads every
passage of every text.

Defined cases: null and empty texts are a bag with one empty passage;
repeated rows get equal scores; with one class or none in the sample every
score is the share of good labels (0.5 without labels); empty tables give
empty results; columns named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BINARY, DOUBLE, SPACE_WORD, Slab, doc_of, field, map_text, mix64
from .labelled import held_out, labelled_sample

SAMPLE = 6_000
TRAIN_PASSAGES = 64
PASSAGE = 48
THRESHOLD = 0.7
HIDDEN, GATE = 24, 12


def _classes() -> np.ndarray:
    """Each byte's class: 0 lower case, 1 upper case, 2 digits, 3 lead bytes, 4 continuation bytes, 5 space, 6 line end, 7 control, 8.. punctuation."""
    t = np.full(256, 7, dtype=np.int64)
    t[97:123], t[65:91], t[48:58], t[0xC0:], t[0x80:0xC0], t[32], t[10] = 0, 1, 2, 3, 4, 5, 6
    marks = [b for b in range(33, 127) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]
    t[marks] = 8 + np.arange(len(marks))
    return t


N_CLASSES = 40
N_FEATURES = N_CLASSES + 10


def passages(slab: Slab) -> tuple[np.ndarray, np.ndarray]:
    """The encoded passages of all texts in a row, and each text's first passage (one more at the end)."""
    starts, ends, first = slab.words(SPACE_WORD)
    n_words = np.diff(first)
    n_pass = np.maximum(1, -(-n_words // PASSAGE))
    pfirst = np.concatenate([[0], np.cumsum(n_pass)])
    p = int(pfirst[-1])
    out = np.zeros((p, N_FEATURES))
    if len(starts):
        doc = doc_of(first)
        at = pfirst[doc] + (np.arange(len(starts)) - first[doc]) // PASSAGE
        words = np.bincount(at, minlength=p)
        # A passage's bytes: from its first word to the next one's (or the text's end).
        begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        head = starts[begin]
        tail = np.minimum(np.r_[head[1:], slab.off[-1]], slab.off[doc[begin] + 1])
        size = tail - head
        byte_at = np.repeat(at[begin], size)
        byte_ix = np.repeat(head - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        counts = np.bincount(byte_at * N_CLASSES + _classes()[slab.buf[byte_ix]], minlength=p * N_CLASSES).reshape(p, N_CLASSES)
        out[:, :N_CLASSES] = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        h = slab.hashes(starts, ends)
        length = (ends - starts).astype(np.float64)
        mean = np.bincount(at, length, p) / np.maximum(1, words)
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        _, one = np.unique(h ^ mix64(at.astype(np.uint64)), return_index=True)
        _, one_doc = np.unique(h ^ mix64(doc.astype(np.uint64)), return_index=True)
        last = slab.buf[ends - 1]
        n = np.maximum(1, words)
        out[:, N_CLASSES:] = np.stack([
            mean / 10, np.sqrt(np.maximum(0, np.bincount(at, length ** 2, p) / n - mean ** 2)) / 10,
            np.bincount(at[same], minlength=p) / n, np.bincount(at[one], minlength=p) / n,
            np.bincount(at[one_doc], minlength=p) / n,
            np.bincount(at[(last == 46) | (last == 33) | (last == 63)], minlength=p) / n,
            np.bincount(at[length == 1], minlength=p) / n, words / PASSAGE, words == 0,
            np.repeat(np.log1p(n_words) / 10, n_pass)], axis=1)
    else:
        out[:, -2] = 1
    return out, pfirst


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class QualityModel:
    """Scaling, embedding (w, b), attention (v, u, a) and output (c, d)."""

    def __init__(self, mean, scale, params):
        self.mean, self.scale, self.params = mean, scale, params

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        """All values on the way from passages to scores."""
        w, b, v, u, a, c, d = self.params
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ w + b)
        t, s = np.tanh(h @ v), _sigmoid(h @ u)
        e = (t * s) @ a
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), np.diff(first)))
        att = e / np.repeat(np.add.reduceat(e, first[:-1]), np.diff(first))
        z = np.add.reduceat(att[:, None] * h, first[:-1], axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "att": att, "z": z, "p": _sigmoid(z @ c + d[0])}

    def scores(self, slab: Slab) -> np.ndarray:
        return self.forward(*passages(slab))["p"]


def gradients(model: QualityModel, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean logistic loss of the bags."""
    w, b, v, u, a, c, d = model.params
    f = model.forward(x, first)
    n = np.diff(first)
    dlogit = (f["p"] - y) / len(y)
    dz = np.repeat(np.outer(dlogit, c), n, axis=0)
    dh = f["att"][:, None] * dz
    datt = (dz * f["h"]).sum(axis=1)
    de = f["att"] * (datt - np.repeat(np.add.reduceat(f["att"] * datt, first[:-1]), n))
    dt = np.outer(de, a) * f["s"] * (1 - f["t"] ** 2)
    ds = np.outer(de, a) * f["t"] * f["s"] * (1 - f["s"])
    dh += dt @ v.T + ds @ u.T
    dpre = dh * (1 - f["h"] ** 2)
    return [f["x"].T @ dpre, dpre.sum(axis=0), f["h"].T @ dt, f["h"].T @ ds, (f["t"] * f["s"]).T @ de, f["z"].T @ dlogit, np.array([dlogit.sum()])]


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, steps: int = 900, bags: int = 256, rate: float = 0.01, decay: float = 1e-3) -> QualityModel:
    """Train on bags by Adam; the seed is fixed, so equal samples give equal models."""
    rng = np.random.default_rng(7)
    size = [(N_FEATURES, HIDDEN), (HIDDEN,), (HIDDEN, GATE), (HIDDEN, GATE), (GATE,), (HIDDEN,), (1,)]
    params = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in (4, 5) else np.zeros(s) for k, s in enumerate(size)]
    model = QualityModel(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), params)
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(y), min(bags, len(y)))
        n = first[pick + 1] - first[pick]
        rows = np.repeat(first[pick] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        grads = gradients(model, x[rows], np.concatenate([[0], np.cumsum(n)]), y[pick])
        for k, g in enumerate(grads):
            g = g + decay * params[k] * (k != 6)
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            params[k] -= rate * min(1, 3 * (1 - step / steps)) * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-9)
    return model


def bag_slab(slab: Slab) -> list:
    """Each text's training passages as bytes."""
    x, first = passages(slab)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        rows = a + np.unique(np.linspace(0, b - a - 1, min(b - a, TRAIN_PASSAGES)).astype(np.int64))
        out.append(x[rows].astype("<f4").tobytes())
    return [out]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = SAMPLE) -> QualityModel:
    sample = labelled_sample(docs, labels, label, per_class, id_col, text)
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    good = rows.agg(F.avg(label)).first()[0]
    good = 0.5 if good is None else good
    got = map_text(sample, "text", ["y", id_col], [field("x", BINARY)], lambda: bag_slab).toPandas().sort_values(id_col)
    if got["y"].nunique() < 2:
        params = [np.zeros((N_FEATURES, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros((1, 1)), np.zeros(1), np.zeros(1),
                  np.array([np.log(max(good, 1e-9) / max(1 - good, 1e-9))])]
        return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), params)
    bags = [np.frombuffer(b, dtype="<f4").reshape(-1, N_FEATURES) for b in got["x"]]
    x = np.concatenate(bags).astype(np.float64)
    y = got["y"].to_numpy(dtype=np.float64)
    model = fit(x, np.concatenate([[0], np.cumsum([len(b) for b in bags])]), y)
    # The sample holds the classes in other shares than the labels: move the bias by the difference of their log odds.
    sampled = min(max(y.mean(), 1e-6), 1 - 1e-6)
    model.params[6] = model.params[6] + np.log(max(good, 1e-6) / max(1 - good, 1e-6)) - np.log(sampled / (1 - sampled))
    return model


def score(docs: DataFrame, model: QualityModel, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score``, one pass."""
    return map_text(docs, text, docs.columns if carry is None else carry, [field("score", DOUBLE)],
                    lambda: lambda slab: [model.scores(slab)])


def op6_mil_quality(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = score(docs, train(docs, labels), carry=["doc_id"])
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

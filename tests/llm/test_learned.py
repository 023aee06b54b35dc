"""Toxicity, quality and personal data: held-out accuracy, contracts and edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from common import frame, prose

from strata.llm import pii, quality, toxicity
from strata.llm.labelled import labelled_ids

BAD = ["grumbol", "snarkly", "vexorat"]


def toxic_corpus():
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(700):
        bad = k % 5 == 0
        words = prose(rng, rng.randint(20, 200)).split(" ")
        if bad:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(BAD) + rng.choice(["", "ix", "um"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    rows += [(9000, None), (9001, ""), (None, "x"), (9002, "grumbol " * 3000), rows[0], rows[0]]
    return rows, labels + [(1, None), (None, 1), (8888, 1)]


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_toxicity_held_out(spark):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(spark, rows, score="clash")
    out = toxicity.score(docs, toxicity.train(docs, table), carry=["doc_id", "text"]).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    y = {i: t for i, t in labels if i is not None and t is not None}
    test = [(r.score >= toxicity.THRESHOLD, y[r.doc_id]) for r in out if r.doc_id in y and held(r.doc_id)]
    assert len(test) > 100
    assert np.mean([bool(a) == bool(b) for a, b in test]) > 0.97
    same = {r.score for r in out if r.doc_id == rows[0][0]}
    assert len(same) == 1 and next(r.score for r in out if r.doc_id == 9002) > 0.5
    kept = toxicity.reject_toxic(docs.drop("score"), table)
    assert kept.columns == docs.drop("score").columns and kept.where("doc_id = 9002").count() == 0 and kept.where("doc_id = 9001").count() == 1


def test_toxicity_without_labels_or_documents(spark):
    rows, labels = toxic_corpus()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = frame(spark, rows[:20])
    assert {round(r.score, 6) for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    model = toxicity.train(docs.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_labels_of_held_out_rows_are_never_learnt(spark):
    _, labels = toxic_corpus()
    ids = labelled_ids(spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic", 40).collect()
    assert len(ids) == 80 and not any(held(r.doc_id) for r in ids)


def test_nonnegative_risk_recovers_the_classes():
    rng = np.random.default_rng(1)
    pos, neg = rng.normal(2, 1, (400, 2)), rng.normal(-2, 1, (900, 2))
    unlabelled = np.vstack([neg, rng.normal(2, 1, (100, 2))])
    w = toxicity.nnpu_fit(pos, unlabelled, 0.1)
    score = lambda x: x @ w[:-1] + w[-1]
    assert (score(rng.normal(2, 1, (300, 2))) > 0).mean() > 0.85 and (score(rng.normal(-2, 1, (300, 2))) < 0).mean() > 0.98


def quality_corpus():
    rng = random.Random(7)
    rows, labels = [], []
    for k in range(500):
        text = [prose(rng, 40) for _ in range(rng.randint(1, 6))]
        if k % 4 == 0:
            junk = rng.choice([" | ".join(WORD for WORD in prose(rng, 60).split(" ")), " ".join(["For"] * 80), prose(rng, 50).upper().replace(" ", "!! ")])
            text[rng.randrange(len(text))] = junk
        rows.append((k, "\n".join(text)))
        labels.append((k, int(k % 4 != 0)))
    return rows + [(9000, None), (9001, ""), (None, "x"), (9002, "For " * 20_000), rows[0], rows[0]], labels


def test_quality_held_out(spark):
    rows, labels = quality_corpus()
    docs = frame(spark, rows, score=1)
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.score(docs, quality.train(docs, table), carry=["doc_id"]).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    y = dict(labels)
    test = [(r.score >= quality.THRESHOLD) == bool(y[r.doc_id]) for r in out if r.doc_id in y and held(r.doc_id)]
    assert np.mean(test) > 0.95
    assert next(r.score for r in out if r.doc_id == 9002) < 0.7


def test_quality_without_labels(spark):
    rows, _ = quality_corpus()
    docs = frame(spark, rows[:10])
    model = quality.train(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_quality_gradients():
    rng = np.random.default_rng(2)
    x, first, y = rng.normal(size=(9, quality.N_FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])
    model = quality.fit(x, first, y, steps=2)
    loss = lambda: -np.mean(y * np.log(p := model.forward(x, first)["p"]) + (1 - y) * np.log(1 - p))
    for param, g in zip(model.params, quality.gradients(model, x, first, y), strict=True):
        at = tuple(rng.integers(0, s) for s in param.shape)
        old = param[at]
        param[at] = old + 1e-5
        up = loss()
        param[at] = old - 1e-5
        down = loss()
        param[at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-6


# The contract's patterns, as they stand.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def pii_corpus():
    rng = random.Random(11)
    rows = []
    for k in range(240):
        what = rng.choice([f"a{k}.x@mail{k % 7}.example.com", f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.3.{k % 256}", "4539 1488 0343 6467",
                           f"+1 (555) 010-{1000 + k}", f"{rng.randrange(10**6)}", "2024-01-05", "token=83b8a6c644842984c9"])
        rows.append((k, f"{prose(rng, 15)} {what} {prose(rng, 15)}"))
    odd = ["a@b.c_d@e.f", "x@@y.z a@b", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3", "+1 2 3 4 5 6 7 8 9 +12", "4539-1488-0343-6467 4539148803436467 1234567812345678",
           "é ä 10.0.0.1, mail: ü@x.y a.b+c%d@e-f.g-h.i.", "1" * 5000, "+1 " * 500, "a@" * 300, "0001.002.3.4", "4539 1488 0343 6467 10.0.0.1"]
    return rows + [(1000 + k, t) for k, t in enumerate(odd)] + [(2000, None), (2001, ""), (None, "+1 (555) 010-1234"), rows[1], rows[1]]


def test_base_spans_stay_and_rewritten_forms_are_found(spark):
    rows = pii_corpus()
    docs = frame(spark, rows, spans=5)
    weights = pii.train(docs)
    new = [(3000, "write to jane.roe (at) mail5 (dot) example (dot) org today"), (3001, "my card 4539.1488.0343.6467 is new"),
           (3002, "call (555) 010-7788 at noon"), (3003, prose(random.Random(1), 200)), (3004, "in 2019 we sold 12345 of 678")]
    out = {r.doc_id: r for r in pii.find_pii(frame(spark, rows + new), weights).collect()}
    for i, t in rows:
        base = plain(t)
        r = out[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in base) for kind in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))
    found = {i: [t[a:b] for a, b in [(s.start, s.end) for s in out[i].span_list]] for i, t in new}
    assert found[3000] == ["jane.roe (at) mail5 (dot) example (dot) org"]
    assert found[3001] == ["4539.1488.0343.6467"] and found[3002] == ["(555) 010-7788"] and found[3003] == found[3004] == []
    clean = {r.doc_id: r.text for r in pii.redact(pii.find_pii(frame(spark, rows + new), weights)).collect()}
    assert clean[3001] == "my card <CARD> is new" and clean[2001] == "" and clean[2000] is None


@pytest.mark.parametrize("seed", range(20))
def test_decoding_is_the_best_segmentation(seed):
    rng = random.Random(seed)
    n = 7
    segs = [(i, j, "email", None, i, j) for i in range(n) for j in range(i + 1, min(n, i + 3) + 1) if rng.random() < 0.5]
    scores = [rng.uniform(-2, 2) for _ in segs]

    def every(k, last):
        yield []
        for m in range(k, len(segs)):
            if segs[m][0] >= last:
                for rest in every(m + 1, segs[m][1]):
                    yield [m, *rest]
    segs, scores = zip(*sorted(zip(segs, scores, strict=True), key=lambda x: x[0][:2]), strict=True) if segs else ((), ())
    totals = [sum(scores[m] for m in c) for c in every(0, 0)]
    assert abs(sum(scores[m] for m in pii.best_segments(n, list(segs), list(scores))) - max(totals)) < 1e-9
    z, p = pii.marginals(n, list(segs), np.array(scores))
    assert abs(z - np.log(np.sum(np.exp(totals)))) < 1e-9
    assert all(-1e-9 <= x <= 1 + 1e-9 for x in p)


def test_pii_without_sample_or_rows(spark):
    docs = frame(spark, [(1, "nothing here")])
    assert pii.find_pii(docs, pii.train(docs)).first().spans == ""
    assert pii.find_pii(docs.limit(0), None).count() == 0

"""Filter stages keep the user's columns, whatever their names; classes keep their near copies apart; PII in long texts."""

import time

import corpus_pipeline as C
from common import frame, prose
from test_pipeline import write_tables

from strata.llm import pii
from strata.llm.labelled import labelled_sample

CLASH = {"score": 0.9, "kept": "mine", "n_shingles": 7, "component_id": "c", "n_removed": 3, "n_words": 111, "n_hit": 5, "n_items": 6,
         "items": "i", "contaminated": "no", "key": 1, "id": 2}


def test_stages_leave_clashing_columns_alone(spark, tmp_path):
    rows = write_tables(spark, str(tmp_path))
    docs = frame(spark, rows[:40] + rows[-4:], **CLASH)
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes, name
        got = out.select(*CLASH).distinct().collect()
        assert [r.asDict() for r in got] == [CLASH], name


def test_a_near_copy_of_the_other_class_stays(spark):
    import random
    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(10)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, t + " scum") for k, t in enumerate(texts)] + [(200 + k, t) for k, t in enumerate(texts)]
    labels = spark.createDataFrame([(k, int(100 <= k < 200)) for k, _ in rows], "doc_id long, toxic int")
    got = labelled_sample(frame(spark, rows), labels, "toxic", 100).collect()
    by = {y: {r.doc_id % 100 for r in got if r.y == y} for y in (0, 1)}
    from strata.llm.labelled import held_out
    ids = {r.doc_id for r in labels.where(~held_out("doc_id")).collect()}
    assert by[1] == {k % 100 for k in ids if 100 <= k < 200} and by[0] == {k % 100 for k in ids if not 100 <= k < 200}
    assert len([r for r in got if r.y == 0]) == len(by[0])


def test_pii_of_long_and_odd_texts():
    assert pii.base_spans("0" * 5000 + ".1.1.1")["ip"] == [(0, 5006)]
    assert pii.base_spans("256.1.1.1 and 000.0.00.255") == {"email": [], "ip": [(14, 26)], "card": [], "phone": []}
    import random
    rng = random.Random(8)
    w = pii.train_field([("mail me at ann (at) example.org now", [("email", 11, 29)])])
    took = []
    for n in (4_000, 16_000):
        text = " ".join(str(rng.randrange(10 ** 6)) for _ in range(n))
        start = time.perf_counter()
        pii.added_spans(text, pii.base_spans(text), w)
        took.append(time.perf_counter() - start)
    assert took[1] < 10 * took[0] + 1


def test_candidates_held_by_others():
    import random
    rng = random.Random(9)
    for _ in range(200):
        found = sorted({(i, i + rng.randint(1, 6), rng.choice(pii.KINDS), 0, 0) for i in (rng.randrange(15) for _ in range(12))}, key=lambda s: s[0])
        plain = [any(k == kind and p <= i and j <= q and (p, q) != (i, j) for p, q, k, _, _ in found) for i, j, kind, _, _ in found]
        assert pii._held(found) == plain

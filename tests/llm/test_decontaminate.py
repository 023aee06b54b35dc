import hashlib
import re

import pytest
from common import AZ, corpus, frame, prose

import strata.llm.decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, body in items:
        b = words(body)
        n = min(13, len(b))
        for s in range(len(b) - n + 1) if b else ():
            for k in range(len(w) - n + 1):
                if w[k:k + n] == b[s:s + n]:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def tables():
    import random
    rng = random.Random(3)
    items = [(k, prose(rng, 30)) for k in range(12)] + [(20, "tiny item"), (21, "É ß Ünique Ärger"), (22, None), (23, "..."), (20, "tiny item"), (110, "")]
    rows = [r for r in corpus(n=25) if r[0] != 306]
    for k in range(8):
        body = items[k][1].split(" ")
        rows.append((500 + k, prose(rng, 40 + 40 * k) + " " + " ".join(body[k:k + 13 + k]).upper() + ", " + prose(rng, 10)))
    rows += [(600, items[1][1] + ". " + items[2][1]), (601, "A TINY-ITEM here"), (602, "é ß Ünique ärger"), (603, "É ß Ünique Ärger"), (604, prose(rng, 900) + " tiny item")]
    return rows, items


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_matches_brute_force(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(D, "MAX_BROADCAST_ROWS", broadcast_rows)
    rows, items = tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.decontaminate(frame(spark, rows, n_hit="x", items=1), bench).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == brute(r.text, items)
    assert sum(r.contaminated for r in out) >= 8 and sum(r.n_hit > 0 and not r.contaminated for r in out) >= 1


def test_query_digest_and_stage(spark):
    rows, items = tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = {r.doc_id for r in D.drop_contaminated(frame(spark, rows), bench).collect()}
    assert kept == {i for i, t in rows if not brute(t, items)[3]}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_empty_tables(spark):
    rows, items = tables()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert D.decontaminate(frame(spark, rows).limit(0), bench).count() == 0
    assert D.decontaminate(frame(spark, rows), bench.limit(0)).where("contaminated").count() == 0


def test_plan_is_native(spark):
    rows, items = tables()
    plan = D.matches(frame(spark, rows), "doc_id", "text", spark.createDataFrame([(1, ["a"], 1, "a", 0)], "wid long, words array<string>, len int, word string, at int"))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_words_counted_as_written(spark):
    """Counting words needs no lower-cased texts; the words of the corpus' counts are lower-cased."""
    text = "THE École the Éte THE-x À"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    said = docs.select("doc_id", D.raw_words("text").alias("raw"), D.words_of("text").alias("w")).collect()
    assert {r.doc_id: r.raw for r in said} == {1: ["THE", "École", "the", "Éte", "THE", "x", "À"], 2: [], 3: []}
    assert all([w.translate(AZ) for w in r.raw] == r.w for r in said)
    counted = D.word_counts(docs, "text", spark.createDataFrame([("the",), ("École",), ("no",)], "word string"))
    assert {r.word: r.n for r in counted.collect()} == {"the": 3, "École": 1}
    hits = spark.createDataFrame([("q", "nothing of this")], "item_id string, text string")
    plan = D.decontaminate(docs, hits)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" not in plan


def test_word_classes_are_listed_one_by_one(spark):
    """Ranges make Java walk a chain of predicates for each character; listed characters are looked up in a table."""
    for regex, old in ((D.WORD, WORD), (D.RAW_WORD, re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))):
        assert "-" not in regex
        text = "".join(f"{chr(k)}ab{chr(k)}" for k in range(0x180)) + "中文 x́y 😀z"
        assert re.findall(regex, text) == old.findall(text)
    said = spark.createDataFrame([(text,)], "text string").select(D.raw_words("text").alias("raw"), D.words_of("text").alias("w")).first()
    assert said.raw == old.findall(text) and said.w == words(text)

import random
from itertools import combinations

import pytest
from common import AZ, Groups, corpus, frame, prose, ws_words

import strata.llm.linking as L
from strata.llm.neardup import keep_one, near_duplicates


def shingles(text):
    w = ws_words((text or "").translate(AZ))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    g, sets = Groups(), [shingles(t) for _, t in rows]
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and 100 * len(a & b) >= 85 * len(a | b):
            g.join(i, j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            root = g.find(k)
            least[root] = min(i, least.get(root, i))
    return [(i, len(sets[k]), least.get(g.find(k))) for k, (i, _) in enumerate(rows)]


def check(spark, rows, **extra):
    out = near_duplicates(frame(spark, rows, **extra)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return out


def test_groups_match_brute_force(spark):
    out = check(spark, corpus(), component_id="clash", kept=3)
    assert sum(not r.kept for r in out) >= 10
    only = near_duplicates(frame(spark, corpus()), carry=["doc_id"])
    assert only.columns == ["doc_id", "n_shingles", "component_id", "kept"] and only.count() == len(corpus())


def chains(seed=2):
    """Chains of texts linked only to their neighbours, a hub whose copies are not linked to each other, and unlinked relatives."""
    rng = random.Random(seed)
    rows = []
    for c in range(3):
        words = prose(rng, 200).split(" ")
        for k in range(12):
            rows.append((1000 * c + 37 * k % 12 + 100 * k, " ".join(words)))
            words = words[3:] + prose(rng, 6).split(" ")
    base = prose(rng, 300).split(" ")
    rows.append((9000, " ".join(base)))
    for k in range(60):
        copy = list(base)
        for j in rng.sample(range(300), 5 if k % 2 else 9):
            copy[j] = f"edit{k}x{j}"
        rows.append((9100 - k, " ".join(copy)))
    return rows


@pytest.mark.parametrize("small", [32, 3])
def test_chains_and_hubs(spark, monkeypatch, small):
    # With tiny buckets compared in full the later waves, with several centres, do the work.
    monkeypatch.setattr(L, "SMALL_BUCKET", small)
    check(spark, chains())


def test_one_stays_and_empty(spark):
    rows = [(k, "a b c d e f g") for k in (5, 3, 9)] + [(1, None), (2, "")]
    assert sorted(r.doc_id for r in keep_one(frame(spark, rows)).collect()) == [1, 2, 3]
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert keep_one(frame(spark, rows)).columns == frame(spark, rows).columns


def test_components_match_union_find(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2000 + k) for k in range(1, 50)]
    g = Groups()
    for a, b in links:
        g.join(a, b)
    least = {}
    for x in g.up:
        least[g.find(x)] = min(x, least.get(g.find(x), x))
    got = {r.id: r.component for r in L.components(spark.createDataFrame(links, "a long, b long")).collect()}
    loops = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: least[g.find(x)] for x in g.up if x not in loops}

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from common import corpus, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import packing as P
from strata.llm.arrays import text_slabs


def reference_ids(texts):
    return [ids + [P.END_ID] for ids in P.load_encoder(P.tokenizer_path("byte_bpe_50k.json"))([t or "" for t in texts])]


VOCABULARY = P.ChunkIds(P.tokenizer_path())


def slab_ids(texts):
    out = []
    for _, _, slab in text_slabs(pa.array(texts, pa.string()), 400):
        ids, n = P.token_slab(slab, VOCABULARY, P.END_ID)
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_chunked_ids_equal_the_tokenizers(spark):
    odd = ["", " ", "\n", "a\n\n b  c \n", "  x", "x  ", "don't 'll  I'm\t\tok \r\n z", "\n\n\nq\n \n", "café 　x", "1234 56,7 <|endoftext|> z",
           "a \x1c b", "\t", " ", "日本 語", "é" * 50, None]
    texts = odd + [t for _, t in corpus(n=20)]
    assert slab_ids(texts) == reference_ids(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab1 .'\n\t 　éß|#", max_size=25), min_size=1, max_size=6))
def test_chunked_ids_of_any_text(texts):
    assert slab_ids(texts) == reference_ids(texts)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_fullest_is_the_best_subset(stock, room):
    items = [k for k, n in stock.items() for _ in range(n)]
    best = max((sum(c) for r in range(len(items) + 1) for c in combinations(items, r) if sum(c) <= room), default=0)
    got = P.fullest(stock, room)
    assert sum(k * n for k, n in got.items()) == best
    assert all(n <= stock[k] for k, n in got.items())


def test_plan_uses_every_piece_and_few_bins():
    rng = np.random.default_rng(5)
    stock = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 1025, 5000), return_counts=True), strict=True)}
    used = defaultdict(int)
    bins = 0
    for combination, times in P.bin_plan(dict(stock)):
        assert sum(k * n for k, n in combination.items()) <= 1024
        bins += times
        for k, n in combination.items():
            used[k] += n * times
    assert dict(used) == stock
    assert bins <= 1.01 * sum(k * n for k, n in stock.items()) / 1024 + 1


def test_packing_round_trip(spark):
    rows = [(i, t) for i, t in corpus() if i is not None and i != 5]
    out = P.packed_documents(frame(spark, rows, length="clash"), ["doc_id", "length"]).collect()
    ids = {i: x for (i, _), x in zip(rows, reference_ids([t for _, t in rows]), strict=True)}
    docs, bins = defaultdict(list), defaultdict(list)
    for r in out:
        docs[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
        assert len(r.ids) == r["length"] <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    assert set(docs) == set(ids)
    for i, pieces in docs.items():
        pieces.sort(key=lambda r: r.piece)
        assert [x for r in pieces for x in r.ids] == ids[i]
        assert [r.start for r in pieces] == [sum(p["length"] for p in pieces[:k]) for k in range(len(pieces))]
        assert all(r["length"] == 1024 for r in pieces[1:])
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r["length"]
        assert at <= 1024
    assert len(bins) <= 1.02 * sum(map(len, ids.values())) / 1024 + 1


def test_repeated_rows_and_empty_table(spark):
    out = P.packed_documents(frame(spark, [(1, "x y")] * 5 + [(None, None)]), ["doc_id"], keep_ids=False).collect()
    assert len(out) == 6 and len({(r.sequence_id, r.offset) for r in out}) == 6
    assert P.packed_documents(frame(spark, [(1, "x")]).limit(0), ["doc_id"]).count() == 0


def test_added_tokens_are_the_tokenizers_ids(spark):
    from tokenizers import Tokenizer

    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y z", "", "é\u3000 <|endoftext|>\n\n<|endoftext|>  q", "<|endoftext", "|>plain", None,
             "  <|endoftext|>  ", "no token here"]
    plain = Tokenizer.from_file(P.tokenizer_path("byte_bpe_50k.json"))
    expected = [[*plain.encode(t or "", add_special_tokens=False).ids, P.END_ID] for t in texts]
    assert expected[0] == [64, 220, 50256, 275, P.END_ID]
    assert slab_ids(texts) == expected
    out = {r.doc_id: r.ids for r in P.packed_documents(frame(spark, list(enumerate(texts))), ["doc_id"]).collect()}
    assert out == dict(enumerate(expected))

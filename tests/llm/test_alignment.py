"""Alignment against whole-text tokenising and pairs made one by one."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from common import corpus, frame

from strata.llm.alignment import RESULTS, aligned_documents, jump, op11_token_alignment


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    own = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or x >= 174]
    rest = [x for x in range(256) if x not in own]
    bytes_of = {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(rest)}

    def read(text):
        """(id, end) of the tokens of both over a space and the text, or none."""
        if not text:
            return [], []
        out = []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        out.append([(k, bytes(bytes_of[c] for c in a.id_to_token(k))) for k in ids])
        pieces = [(k, b.id_to_piece(k)) for k in b.encode(text)]
        out.append([(k, bytes([int(p[3:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode()) for k, p in pieces])
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in out):
            return [], []
        return tuple([(k, end) for (k, _), end in zip(side, np.cumsum([len(x) for _, x in side]).tolist(), strict=True)] for side in out)
    return read


def brute(texts, read):
    """The results of each text."""
    docs, counts = [], Counter()
    for t in texts:
        a, b = read(t)
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups = [([], []) for _ in cuts]
        for side, tokens in enumerate((a, b)):
            for k, e in tokens:
                groups[bisect_left(cuts, e)][side].append(k)
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts.update(set(links))
        docs.append((a, b, groups, links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for a, b, groups, links in docs:
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    return out


ODD = ["", None, " ", "  ", "\n", "\t", "\r", "a", " a", "a ", "a  b", "a\n\n  b", "a;\r\nb;\r c", "x\ty \t z", "\n\tx", "a ▁b", "<s> x</s> <unk>",
       "<|endoftext|>it's <|endoftext|>", "café naïve  x", "　 中文字  y", "a\x00b \x1c c", "ﬁne \U0001f600\U0001f600 ​",
       "1,234.50 don't  we'll", "return x;\r\n    if (y) {\r\n}", "ไทย देव", "a" * 3000, " " * 500 + "z", "=" * 257 + " end", "zq" * 700]


def random_texts(seed, n):
    rng = random.Random(seed)
    pool = ["the", "of", "Zug", "über", "x1", "--", "it's", " ", "  ", "\n", "\n\n", "\t", "\r\n", "中", "\U0001f600", "ing", "(", ");", " ", "▁", "\x0b", "#", "0x1F"]
    weights = [6] * 7 + [12, 3, 2, 1, 1, 1] + [2] * 5 + [0.1, 0.05, 0.2, 2, 2]
    return ["".join(rng.choices(pool, weights, k=rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("top", [1 << 20, 300, 0])
def test_matches_brute_force(spark, tokenizers, top):
    texts = [t for _, t in corpus(n=25)] + ODD + random_texts(5, 300)
    rows = list(enumerate(texts))
    got = {r[0]: tuple(r[1:]) for r in aligned_documents(frame(spark, rows), carry=["doc_id"], top=top).select("doc_id", *RESULTS).collect()}
    want = brute(texts, tokenizers)
    wrong = [(texts[k], got[k], w) for k, w in enumerate(want) if got[k] != w]
    assert not wrong, wrong[:3]
    assert sum(1 for w in want if w[0]) > 300


def test_groups_and_clashing_columns(spark, tokenizers):
    docs = frame(spark, [(1, "Hello there, world"), (2, None), (2, None)], n_a="mine", links=1, groups="g", score=0.5)
    out = aligned_documents(docs, keep_groups=True).orderBy("doc_id").collect()
    a, b = tokenizers("Hello there, world")
    assert out[0]["n_a"] == len(a) and out[0]["score"] == 0.5 and out[1]["groups"] == "" and out[1]["n_links"] == 0
    groups = [[side.split(",") for side in g.split("|")] for g in out[0]["groups"].split(";")]
    assert [int(k) for x, _ in groups for k in x] == [k for k, _ in a] and [int(k) for _, x in groups for k in x] == [k for k, _ in b]
    assert hashlib.sha256(out[0]["groups"].encode()).hexdigest() == out[0]["groups_sha256"]
    assert len(out) == 3
    assert aligned_documents(docs.limit(0)).count() == 0


def test_jump_labels_components():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        cut = lambda: np.append(np.sort(rng.choice(np.arange(1, n), int(rng.integers(0, n)), replace=False)), n) if n > 1 else np.array([1])
        ends_a, ends_b = cut(), cut()
        label_a, label_b = jump(ends_a, ends_b)
        common = np.intersect1d(ends_a, ends_b)
        # A token's component ends at the first common end that it reaches.
        assert (ends_b[label_a] == common[np.searchsorted(common, ends_a)]).all()
        assert (ends_b[label_b] == common[np.searchsorted(common, ends_b)]).all()


def test_query_covers_the_table(spark, sf01, tokenizers):
    out = op11_token_alignment(spark, sf01)
    texts = dict(spark.read.parquet(f"{sf01}/documents.parquet").select("doc_id", "text").collect())
    got = {r[0]: tuple(r[1:]) for r in out.collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    assert [got[i] for i in ids] == brute([texts[i] for i in ids], tokenizers)

r"""Packing token pieces into sequences by minimum bin slack.

A text becomes token ids and one end id; longer ones are cut into pieces of
the sequence length, the first of which takes the remainder.  Per bin, a
subset-sum dynamic programme over the lengths still available (a bitset of
reachable sums) finds the combination that fills the sequence best around
its longest piece; that combination is removed, as often as the stock
allows, and the next bin follows.

What to combine depends only on how many pieces of each length there are:
at most as many numbers as a sequence has tokens, whatever the corpus.  The
driver plans on that table; each piece then gets its place from its length
and its number among the pieces of that length.  Pieces of a length are
numbered in parts, so a length that a third of all pieces share is spread
over tasks.

Tokenising works on chunks (a run of other characters with the one space
before it; white space left over).  The tokenizer's pattern never joins
characters across those borders, so a chunk's ids are the same alone as in
its text, and a worker tokenises every different chunk once.  Texts with
white space beyond ASCII are tokenised whole.  The vocabulary's added tokens
(``<|endoftext|>``) are cut out first, as the tokenizer does: each is one id,
and what stands before and after it is tokenised as a text of its own.

Defined cases: a null or empty text is one piece with the end id alone;
texts of any length are cut as above; repeated rows give pieces each; an
empty table gives no pieces; columns named like a result are replaced.
"""

from __future__ import annotations

import json
import re
import zlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .arrays import LONG, Slab, byte_table, field, map_text, worker_cache
from .numbering import number_within, parts_for

CAPACITY = 1024
END_ID = 2
#: The vocabulary of byte_bpe_50k.json as ranks: the same ids (held against each other in the tests) at a third of the time.
TOKENIZER = "byte_bpe_50k.tiktoken"
#: The file that names the added tokens, which the ranks lack.
VOCABULARY = "byte_bpe_50k.json"
#: Chunks whose ids a worker remembers.
MAX_CHUNKS = 600_000

SPACES = byte_table(bytes([9, 10, 11, 12, 13, 32]))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def load_encoder(path: str):
    """A function from a list of texts to their lists of ids; the ranks take added tokens as ordinary text, a json finds them."""
    if path.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [coder.encode_ordinary(t) for t in texts]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a vocabulary and their ids."""
    with open(path if path.endswith(".json") else tokenizer_path(VOCABULARY), encoding="utf-8") as f:
        tokens = json.load(f).get("added_tokens", [])
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or SPACES[list(t["content"].encode())].any() for t in tokens):
        raise ValueError("added tokens must be plain and without white space")
    return {t["content"]: t["id"] for t in tokens}


class ChunkIds:
    """Ids of all chunks seen so far by a worker."""

    def __init__(self, path: str):
        self.encode = load_encoder(path)
        self.added = added_tokens(path)
        longest_first = sorted((t.encode() for t in self.added), key=len, reverse=True)
        self.marks = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self.clear()

    def cut(self, slab: Slab) -> Slab:
        """``slab`` with each added token, and each stretch between them, as a text of its own."""
        if self.marks is None:
            return slab
        raw, spans = slab.buf.tobytes(), []
        if not self.marks.search(raw):
            return slab
        for a, b in zip(slab.off[:-1].tolist(), slab.off[1:].tolist(), strict=True):
            spans += [x for m in self.marks.finditer(raw, a, b) for x in m.span()]
        return Slab(slab.buf, np.sort(np.concatenate([slab.off, np.array(spans, dtype=slab.off.dtype)]))) if spans else slab

    def clear(self):
        self.row: dict[int, int] = {}
        self.flat, self.off = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def lookup(self, slab: Slab, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All chunks' ids in a row, and the number of ids of each chunk."""
        if not len(starts):
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        keys, at, inv = np.unique(slab.hashes(starts, ends), return_index=True, return_inverse=True)
        if len(self.row) + len(keys) > MAX_CHUNKS and self.row:
            self.clear()
        keys = keys.tolist()
        new = [k for k, h in enumerate(keys) if h not in self.row]
        if new:
            raw = slab.buf.tobytes()
            texts = [raw[starts[at[k]]: ends[at[k]]].decode("utf-8", "replace") for k in new]
            ids = [[self.added[t]] if t in self.added else i for t, i in zip(texts, self.encode(texts), strict=True)]
            n = len(self.off) - 1
            self.row.update((keys[k], n + j) for j, k in enumerate(new))
            counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(counts.sum()))])
            self.off = np.concatenate([self.off, self.off[-1] + np.cumsum(counts)])
        rows = np.fromiter((self.row[h] for h in keys), dtype=np.int64, count=len(keys))[inv]
        first, count = self.off[rows], self.off[rows + 1] - self.off[rows]
        begin = np.cumsum(count) - count
        return self.flat[np.repeat(first - begin, count) + np.arange(int(count.sum()))], count


def chunks(slab: Slab) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunk starts and ends in order, and the number of chunks of each text."""
    buf, off, n = slab.buf, slab.off, slab.n
    space = SPACES[buf]
    ws, we = slab.runs(~space)
    begin = np.zeros(len(buf) + 1, dtype=bool)
    begin[off] = True
    joined = np.zeros(len(ws), dtype=bool)
    inner = ws > 0
    joined[inner] = (buf[ws[inner] - 1] == 32) & ~begin[ws[inner]]
    gs, ge = slab.runs(space)
    at_end = begin[ge]
    single = ge - 1
    last_space = np.zeros(len(ge), dtype=bool)
    last_space[:] = buf[single] == 32 if len(ge) else False
    body_end = np.where(at_end, ge, ge - 1)
    body = body_end > gs
    alone = ~at_end & ~last_space
    starts = np.concatenate([ws - joined, gs[body], single[alone]])
    ends = np.concatenate([we, body_end[body], ge[alone]])
    # White space beyond ASCII, and the four separators that libraries judge differently.
    odd = (buf >= 0x1C) & (buf <= 0x1F)
    b1, b2 = np.append(buf[1:], 0)[: len(buf)], np.append(buf[2:], [0, 0])[: len(buf)]
    odd |= (buf == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))
    odd |= (buf == 0xE1) & (b1 == 0x9A) & (b2 == 0x80)
    odd |= (buf == 0xE2) & (((b1 == 0x80) & ((b2 <= 0x8A) | (b2 == 0xA8) | (b2 == 0xA9) | (b2 == 0xAF))) | ((b1 == 0x81) & (b2 == 0x9F)))
    odd |= (buf == 0xE3) & (b1 == 0x80) & (b2 == 0x80)
    whole = slab.per_doc(odd) > 0
    if whole.any():
        keep = ~whole[np.searchsorted(off, starts, "right") - 1]
        starts = np.concatenate([starts[keep], off[:-1][whole]])
        ends = np.concatenate([ends[keep], off[1:][whole]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    # An empty text shares its place with the next one; every chunk has bytes, so its last byte tells its text.
    return starts, ends, np.bincount(np.searchsorted(off, ends - 1, "right") - 1, minlength=n)


def token_slab(slab: Slab, vocabulary: ChunkIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each ended by ``end_id``, and the number of ids of each text."""
    starts, ends, _ = chunks(vocabulary.cut(slab))
    ids, count = vocabulary.lookup(slab, starts, ends)
    total = np.concatenate([[0], np.cumsum(count)])
    bounds = np.searchsorted(starts, slab.off)
    per_doc = total[bounds[1:]] - total[bounds[:-1]]
    return np.insert(ids, total[bounds[1:]], end_id), per_doc + 1


def token_pieces(docs: DataFrame, text: str = "text", carry: list[str] | None = None, path: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """A row per piece: the ``carry`` columns, piece, start, length, ids_crc32 and, with ``keep_ids``, ids."""
    path = path or tokenizer_path()
    fields = [field("piece", T.IntegerType()), field("start", LONG), field("length", LONG), field("ids_crc32", LONG)]
    fields += [field("ids", T.ArrayType(T.IntegerType(), False))] if keep_ids else []

    def make():
        cache = worker_cache()
        vocabulary = cache.get(("ids", path)) or cache.setdefault(("ids", path), ChunkIds(path))

        def run(slab: Slab):
            ids, n = token_slab(slab, vocabulary, end_id)
            n_pieces = -(-n // capacity)
            doc = np.repeat(np.arange(slab.n), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            head = (n - capacity * (n_pieces - 1))[doc]
            length = np.where(piece == 0, head, capacity)
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            ends = np.cumsum(length)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(ends - length, ends, strict=True)]
            out = [doc, piece, start, length, crc]
            if keep_ids:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32())))
            return out
        return run

    return map_text(docs, text, docs.columns if carry is None else carry, fields, make, explode=True)


def fullest(stock: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths with the largest sum up to ``room`` (longest lengths first)."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in stock if 0 < x <= room), reverse=True):
        most, many = min(stock[length], room // length), 1
        while most > 0 and not reach >> room & 1:
            take = min(many, most)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            most, many = most - take, many * 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= length * take
    return out


def bin_plan(stock: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Combinations of lengths and how many sequences use each."""
    stock, plan = {k: n for k, n in stock.items() if n > 0}, []
    while stock:
        seed = max(stock)
        rest = {k: n - (k == seed) for k, n in stock.items()}
        combination = fullest(rest, capacity - seed)
        combination[seed] = combination.get(seed, 0) + 1
        times = min(stock[k] // n for k, n in combination.items())
        plan.append((combination, times))
        for k, n in combination.items():
            stock[k] -= n * times
            if not stock[k]:
                del stock[k]
    return plan


def _places(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each length, runs of piece numbers: first number, first sequence, pieces a sequence, place in it."""
    rows, used, sequence = [], {}, 0
    for combination, times in plan:
        offset = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            rows.append((length, used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "number", "sequence", "n", "offset"]).sort_values(["length", "number"])


def pack(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``order`` names the columns that tell pieces apart.

    ``pieces`` is read three times and should be materialised.
    """
    pieces = pieces.drop("sequence_id", "offset")
    stock = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if stock and not 0 < min(stock) <= max(stock) <= capacity:
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    places = _places(bin_plan(stock, capacity))
    groups = {int(k): tuple(g[c].to_numpy(dtype=np.int64) for c in ("number", "sequence", "n", "offset"))
              for k, g in places.groupby("length")}

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        length, number = length.to_numpy(), number.to_numpy()
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for k in np.unique(length):
            rows = length == k
            first, seq, n, at = groups[int(k)]
            run = np.searchsorted(first, number[rows], "right") - 1
            j = number[rows] - first[run]
            sequence[rows] = seq[run] + j // n[run]
            offset[rows] = at[run] + j % n[run] * k
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    numbered = number_within(pieces, ["length"], order, parts_for(sum(stock.values()), 32), "__number")
    placed = numbered.withColumn("__place", place("length", "__number"))
    return placed.select(*pieces.columns, "__place.sequence_id", "__place.offset")


def packed_documents(docs: DataFrame, carry: list[str], text: str = "text", path: str | None = None,
                     capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents with their places."""
    ensure_checkpoint_dir(docs.sparkSession)
    pieces = token_pieces(docs, text, carry, path, capacity, keep_ids=keep_ids).checkpoint()
    return pack(pieces, [*[c for c in carry if c in pieces.columns], "piece", "ids_crc32"], capacity)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of at most 1024 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed_documents(docs, ["doc_id"], keep_ids=False)

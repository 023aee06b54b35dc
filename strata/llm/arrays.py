"""Vectorised scans of text columns inside Arrow batches.

A :class:`Slab` is a run of whole texts taken from one Arrow batch: their
UTF-8 bytes end to end and the offset of each text.  All work on it is numpy
over bytes (about ten nanoseconds a byte), so no Python object is made per
word.  A slab holds ``SLAB_BYTES`` of text, or one text if that is longer;
memory follows the slab, not the batch or the partition.

Word and shingle identity is a 64-bit hash of the bytes; two different texts
of words meet with probability about 2**-64 per pair.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLAB_BYTES = 2 << 20
TEXT = "__llm_text"
#: What an Arrow batch may hold unless the session says otherwise; Spark's own bound is eight times as much.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    have = cache.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, SLAB_BYTES + 1)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=_U)
            p[0] = 1
            out.append(np.cumprod(p, dtype=_U))
        have = tuple(out)
        if size <= 16 * SLAB_BYTES:
            cache["powers"] = have
    return have


def byte_table(chars: bytes) -> np.ndarray:
    """256 booleans: True at the given bytes."""
    t = np.zeros(256, dtype=bool)
    t[np.frombuffer(chars, dtype=np.uint8)] = True
    return t


# Word bytes of the white-space rule [^\x20\x09-\x0D]+ and of the
# letters-and-digits rule on lower-cased text; both are byte classes, since
# every byte of a non-ASCII character belongs to a word.
SPACE_WORD = ~byte_table(bytes([9, 10, 11, 12, 13, 32]))
ALNUM_WORD = byte_table(bytes([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]))


def _byte_values(lower: bool, digits: bool) -> np.ndarray:
    b = np.arange(256, dtype=_U)
    if lower:
        b[65:91] += _U(32)
    if digits:
        b[48:58] = _U(48)
    return mix64(b + _U(0x51ED270B9F))


class Slab:
    """Texts of one batch, end to end."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1
        self._prefix: dict[tuple[bool, bool], np.ndarray] = {}

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """How many of the bytes that ``mask`` marks each text has."""
        c = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.off[1:]] - c[self.off[:-1]]

    def runs(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of marked bytes inside each text."""
        m = len(mask)
        edge = np.zeros(m + 1, dtype=bool)
        edge[self.off] = True
        before = np.zeros(m, dtype=bool)
        before[1:] = mask[:-1]
        starts = np.flatnonzero(mask & (~before | edge[:-1]))
        after = np.zeros(m, dtype=bool)
        after[:-1] = mask[1:]
        ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
        return starts, ends

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word starts, ends, and for each text the index of its first word (one more at the end)."""
        starts, ends = self.runs(table[self.buf])
        return starts, ends, np.searchsorted(starts, self.off)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        r"""Starts and ends of the \n-split lines, and each text's first line index (one more at the end)."""
        nl = np.flatnonzero(self.buf == 10)
        starts = np.concatenate([self.off[:-1], nl + 1])
        doc = np.concatenate([np.arange(self.n), np.searchsorted(self.off, nl, "right") - 1])
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        last = np.ones(len(doc), dtype=bool)
        last[:-1] = doc[1:] != doc[:-1]
        ends = np.empty(len(doc), dtype=np.int64)
        ends[:-1] = starts[1:] - 1
        ends[last] = self.off[1:]
        return starts, ends, np.searchsorted(doc, np.arange(self.n + 1))

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False, digits: bool = False) -> np.ndarray:
        """A 64-bit hash of each byte range (``lower``: A-Z as a-z; ``digits``: all digits alike)."""
        how = (lower, digits)
        if how not in self._prefix:
            self._prefix[how] = _prefix_sums(_byte_values(lower, digits)[self.buf])
        return range_hashes(self._prefix[how], starts, ends)


def _prefix_sums(values: np.ndarray) -> np.ndarray:
    pw, _ = _powers(len(values) + 1)
    c = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * pw[: len(values)], out=c[1:], dtype=_U)
    return c


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of a sequence, from its prefix sums."""
    _, ipw = _powers(len(sums))
    return mix64((sums[ends] - sums[starts]) * ipw[starts] + (ends - starts).astype(_U))


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of a sequence of hashes (words of a line)."""
    return range_hashes(_prefix_sums(values), starts, ends)


def doc_of(first: np.ndarray) -> np.ndarray:
    """The text of each item, from the texts' first item indices."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_hashes(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` items inside each text, and the index of each run's first item."""
    if len(h) < k:
        return np.zeros(0, dtype=_U), np.zeros(0, dtype=np.int64)
    g = np.zeros(len(h) - k + 1, dtype=_U)
    for j in range(k):
        g = g * _U(0xD6E8FEB86659FD93) + h[j: len(h) - k + 1 + j]
    end = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(g))
    at = at[at + k <= end[: len(g)]]
    return mix64(g[at]), at


def text_slabs(col: pa.Array, max_bytes: int = SLAB_BYTES) -> Iterator[tuple[int, int, Slab]]:
    """Slabs of a text column with the rows they hold; null counts as the empty text."""
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    col = pc.fill_null(col, "") if col.null_count else col
    n = len(col)
    if not n:
        return
    wide = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=wide)[col.offset: col.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1))
        yield lo, hi, Slab(buf[off[lo]: off[hi]], off[lo: hi + 1] - off[lo])
        lo = hi


def map_text(df: DataFrame, text: str, carry: list[str], fields: list[T.StructField],
             make: Callable[[], Callable], explode: bool = False) -> DataFrame:
    """Run a numpy function over a text column, in Arrow batches.

    ``make()`` is called once per task and gives the function; it takes a
    :class:`Slab` and returns one array per field, a value per text.  With
    ``explode`` it returns first the text index of each output row.  Columns
    in ``carry`` go along; those named like a field are replaced by it.  The
    text itself goes to Python once, carried or not, and batches are bounded
    by bytes.
    """
    names = [f.name for f in fields]
    carry = [c for c in carry if c not in names]
    schema = T.StructType([df.schema[c] for c in carry] + fields)
    conf = df.sparkSession.conf
    if not df.sparkSession.sparkContext.getConf().contains(BATCH_CONF) and int(re.sub("[bB]$", "", conf.get(BATCH_CONF))) > BATCH_BYTES:
        conf.set(BATCH_CONF, str(BATCH_BYTES))
    once = text in carry and isinstance(df.schema[text].dataType, T.StringType)
    at = carry.index(text) if once else len(carry)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = [to_arrow_type(f.dataType) for f in fields]
        fn = make()
        for batch in batches:
            for lo, hi, slab in text_slabs(batch.column(at)):
                out = fn(slab)
                rest = [batch.column(k).slice(lo, hi - lo) for k in range(len(carry))]
                if explode:
                    take = pa.array(out[0])
                    rest, out = [c.take(take) for c in rest], out[1:]
                new = [o if isinstance(o, pa.Array) else pa.array(o, type=k) for o, k in zip(out, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*rest, *new], names=[*carry, *names])

    sent = [F.col(f"`{c}`") for c in carry] + ([] if once else [F.col(f"`{text}`").cast("string").alias(TEXT)])
    return df.select(*sent).mapInArrow(run, schema)


def own_columns(docs: DataFrame, judge: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """What ``judge`` leaves of ``docs``, with exactly the columns of ``docs``.

    ``judge`` gets the table under private column names, and where each name
    went, so a column that is named like a result of its own passes untouched.
    """
    private = {c: f"__own{k}" for k, c in enumerate(docs.columns)}
    out = judge(docs.toDF(*private.values()), private)
    return out.select(*[F.col(hidden).alias(c) for c, hidden in private.items()])


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


LONG, BOOL, DOUBLE, STRING, BINARY = T.LongType(), T.BooleanType(), T.DoubleType(), T.StringType(), T.BinaryType()

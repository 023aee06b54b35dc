r"""Quality rules as a bitmask ledger.

Every rule is evaluated once over each whole text.  The ledger keeps, per
document, the measurements and one long whose bit ``k`` says that rule ``k``
failed.  A policy is a version name and a set of rules; applying one, or
asking what a corpus would keep without one of its rules, is bitwise work on
that long and never reads a text again.

Defined cases: a null text counts as the empty text (all measurements 0, so
``too_few_words`` fails); texts of any length are measured whole; repeated
rows are judged each on its own; an empty table gives an empty ledger; input
columns named like a ledger column are replaced by it.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import LONG, SPACE_WORD, Slab, byte_table, doc_of, field, gram_hashes, map_text, mix64

# The symbol characters, and the length of a repeated passage.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

# Rule name -> condition under which it fails.  A rule's place
# in this list is its bit and never changes; new rules go to the end.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 20"),
    ("repeated_passages", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("short_words", "n_words > 0 and word_chars < 2 * n_words"),
    ("long_words", "word_chars > 30 * n_words"),
]

# Policy version -> the rules it applies.
POLICIES: dict[str, list[str]] = {
    "base": ["too_few_words", "repeated_passages"],
    "v1": ["too_few_words", "repeated_passages", "symbols", "duplicate_lines"],
    "v2": [name for name, _ in RULES],
}


def measure_slab(slab: Slab) -> list[np.ndarray]:
    """The measurements of each text (see ``MEASURES``)."""
    buf, n = slab.buf, slab.n
    word = SPACE_WORD[buf]
    starts, ends, first = slab.words(SPACE_WORD)
    n_words = np.diff(first)
    chars = slab.per_doc(word & ((buf & 0xC0) != 0x80))
    symbols = slab.per_doc(byte_table(SYMBOLS)[buf])

    ls, le, lfirst = slab.lines()
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    doc = doc_of(lfirst)[has_word]
    lines = np.bincount(doc, minlength=n)
    key = slab.hashes(ls[has_word], le[has_word]) ^ mix64(doc.astype(np.uint64))
    _, at = np.unique(key, return_index=True)
    dup_lines = lines - np.bincount(doc[at], minlength=n)

    g, at = gram_hashes(slab.hashes(starts, ends), first, WINDOW)
    wdoc = doc_of(first)
    _, inv, count = np.unique(g ^ mix64(wdoc[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    again = at[count[inv] > 1]
    cover = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    repeated = np.bincount(wdoc[np.cumsum(cover)[:-1] > 0], minlength=n)
    return [n_words, chars, symbols, dup_lines, repeated, lines]


def failure_bits(rules: list[tuple[str, str]] = RULES) -> Column:
    bits = [F.when(F.expr(cond), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, (_, cond) in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def rule_ledger(docs: DataFrame, text: str = "text", carry: list[str] | None = None,
                rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """``docs`` with the measurements and ``fail_bits`` (``carry``: the columns to keep, by default all)."""
    carry = [c for c in (docs.columns if carry is None else carry) if c != "fail_bits"]
    return map_text(docs, text, carry, [field(m, LONG) for m in MEASURES], lambda: measure_slab) \
        .withColumn("fail_bits", failure_bits(rules))


def mask_of(names: list[str], rules: list[tuple[str, str]] = RULES) -> int:
    place = {name: k for k, (name, _) in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


def passes(policy: str) -> Column:
    """True where no rule of the policy failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows it rejects, rows it alone rejects, and rows kept without it.

    One aggregation over the ledger, a row per rule.
    """
    names, mask = POLICIES[policy], mask_of(POLICIES[policy])
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long"))
    one = {name: F.lit(mask_of([name])).cast("long") for name in names}
    sums = [F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum((bits == 0).cast("long")), F.lit(0)).alias("n_kept")]
    for name in names:
        sums += [F.coalesce(F.sum((bits.bitwiseAND(one[name]) != 0).cast("long")), F.lit(0)).alias(f"{name}__any"),
                 F.coalesce(F.sum((bits == one[name]).cast("long")), F.lit(0)).alias(f"{name}__alone")]
    total = ledger.agg(*sums)
    per_rule = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"{name}__any").alias("n_rejected"),
                                  F.col(f"{name}__alone").alias("n_only"),
                                  (F.col("n_kept") + F.col(f"{name}__alone")).alias("n_kept_without")) for name in names])
    return total.select(F.lit(policy).alias("policy"), "n_docs", "n_kept", F.inline(per_rule))


def op9_rule_ledger(spark, sf_dir: str) -> DataFrame:
    """The rule ledger of ``documents`` with the verdict of policy v1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = rule_ledger(docs, carry=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), "n_lines", "fail_bits")

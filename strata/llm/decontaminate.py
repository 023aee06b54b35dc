r"""Benchmark decontamination by a prefix-filtered join.

An item is cut into windows of 13 consecutive words (one window, if it has
fewer).  A document holds a window only if it holds all of its words, so it
must hold its rarest one: words are ordered by how often they occur in the
corpus, and each window joins on that one necessary word.  A word that
occurs nowhere rules its windows out at once.  The word's place in the
window fixes where the window would start in the document; starts before the
first word or ends past the last one are dropped, and the rest are verified
word by word.

Everything is DataFrame functions.  The windows are broadcast below a
counted bound, and then matched and verified while a document's words stream
by, with no shuffle of the corpus; beyond the bound the words' places are
joined by shuffle and the documents fetched again to verify.

Defined cases: a null or empty text has no words and is clean; items without
words are ignored; repeated items count once; equal document rows (id and
text) get equal results; texts of any length are searched whole; input
columns named like a result are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .arrays import own_columns

WINDOW = 13
#: A side is broadcast up to so many rows and bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 48 << 20



def listed(chars: str) -> str:
    """A regex of runs of all but ``chars`` (ASCII).

    Java looks single characters up in one table, but walks a chain of
    predicates for ranges: counting words was six times slower.
    """
    return "[^" + "".join(f"\\x{ord(c):02X}" for c in chars) + "]+"


ASCII = "".join(map(chr, range(128)))
# A word, once A-Z are lower-cased.
WORD = listed(re.sub("[0-9a-z]", "", ASCII))
# The same words before A-Z are lower-cased.
RAW_WORD = listed(re.sub("[0-9A-Za-z]", "", ASCII))


def az_lower(c: Column) -> Column:
    """A-Z as a-z, all else as it is.

    For plain ASCII texts the built-in ``lower`` does just that, and faster.
    """
    slow = F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(slow)


def words_of(text: str) -> Column:
    return F.regexp_extract_all(az_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))


def raw_words(text: str) -> Column:
    """The words as they are written, for counts: lower-cased one by one, only those beyond ASCII take the slow ``translate``."""
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RAW_WORD), F.lit(0))


def small(df: DataFrame, size: Column) -> bool:
    """Whether a materialised side stays below the broadcast bound; reads no more rows than that."""
    n, b = df.limit(MAX_BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= MAX_BROADCAST_ROWS and b <= MAX_BROADCAST_BYTES


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Windows of all items: item, wid, words."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(text).alias("w")).where(F.size("w") > 0)
    length = F.least(F.lit(window), F.size("w"))
    starts = items.withColumn("s", F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)))
    return starts.select("item", F.slice("w", F.col("s"), length).alias("words")).withColumn("wid", F.xxhash64("words")).distinct()


def word_counts(docs: DataFrame, text: str, vocabulary: DataFrame) -> DataFrame:
    """How often each word of ``vocabulary`` occurs in all of ``docs``: word, n."""
    side = F.broadcast(vocabulary) if small(vocabulary, F.octet_length("word")) else vocabulary
    said = docs.select(F.explode(raw_words(text)).alias("raw")).select(az_lower(F.col("raw")).alias("word"))
    return said.join(side, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def necessary_words(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest word and that word's place: wid, words, len, word, at."""
    places = windows.select("wid", "words", F.posexplode("words").alias("at", "word"))
    rarest = places.join(counts, "word", "left").groupBy("wid", "words").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("r"))
    return rarest.where("r.n > 0").select("wid", "words", F.size("words").alias("len"), "r.word", "r.at")


def matches(docs: DataFrame, id_col: str, text: str, prefix: DataFrame) -> DataFrame:
    """All occurrences of windows in documents: key, id, first (word, from 0), len, wid."""
    fits = (F.col("pos") >= F.col("at")) & (F.col("pos") - F.col("at") + F.col("len") <= F.col("n"))
    first = (F.col("pos") - F.col("at")).alias("first")
    verified = F.slice("w", F.col("first") + 1, F.col("len")) == F.col("words")
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text).alias("key"), words_of(text).alias("w"))
    if small(prefix, F.octet_length(F.array_join("words", "")) + 100):
        said = keyed.select("id", "key", "w", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
        found = said.join(F.broadcast(prefix), "word").where(fits).select("id", "key", "w", "words", "len", "wid", first)
        return found.where(verified).select("key", "id", "first", "len", "wid")
    said = keyed.select("id", "key", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
    maybe = said.join(prefix, "word").where(fits).select("id", "key", "words", "len", "wid", first).distinct()
    whole = keyed.dropDuplicates(["key", "id"]).withColumnRenamed("id", "id2").withColumnRenamed("key", "key2")
    found = maybe.join(whole, (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("id2")))
    return found.where(verified).select("key", "id", "first", "len", "wid")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents that hold a window: key, id, n_hit, items (sorted as strings).  Checkpointed."""
    ensure_checkpoint_dir(docs.sparkSession)
    windows = item_windows(benchmark, item_id, item_text, window).checkpoint()
    vocabulary = windows.select(F.explode("words").alias("word")).distinct().checkpoint()
    distinct = windows.select("wid", "words").distinct()
    prefix = necessary_words(distinct, word_counts(docs, text, vocabulary)).checkpoint()
    found = matches(docs, id_col, text, prefix).distinct().checkpoint()
    hit = found.select("key", "id", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("len") - 1)).alias("pos")) \
               .distinct().groupBy("key", "id").agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select("key", "id", "wid").distinct().join(windows.select("wid", "item"), "wid").select("key", "id", "item").distinct()
    items = named.groupBy("key", "id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    other = items.select(F.col("key").alias("key2"), F.col("id").alias("id2"), "items")
    return hit.join(other, (F.col("key") == F.col("key2")) & F.col("id").eqNullSafe(F.col("id2"))) \
              .select("key", "id", "n_hit", "items").checkpoint()


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items and contaminated (a hit covers a twentieth of the words or more)."""
    docs = docs.drop("n_words", "n_hit", "n_items", "items", "contaminated")
    hits = benchmark_hits(docs, benchmark, id_col, text, item_id, item_text, window)
    hits = F.broadcast(hits) if small(hits, F.octet_length(F.array_join("items", ",")) + 50) else hits
    # The item list bounds a hit row; documents without hits never leave their task.
    said = docs.withColumns({"n_words": F.size(raw_words(text)).cast("long"), "__key": F.xxhash64(id_col, text)})
    out = said.join(hits, (F.col("__key") == F.col("key")) & F.col(id_col).eqNullSafe(F.col("id")), "left")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(*docs.columns, "n_words", n_hit.alias("n_hit"),
                      F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce(F.col("items"), F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    return own_columns(docs, lambda own, at: decontaminate(own, benchmark, at["doc_id"], at["text"]).where(~F.col("contaminated")))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Contamination of all ``documents`` by ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = decontaminate(docs, benchmark)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS gram FROM bl),
sizes AS (SELECT DISTINCT n FROM bw),
dl AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
dg AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram FROM dl),
m AS (SELECT doc_id, s, dg.n, item_id FROM dg JOIN bw ON dg.n = bw.n AND dg.gram = bw.gram),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

r"""URL filtering with a blocked Bloom filter before an exact join.

Two lists judge a page's URL: rules (host and path prefix, allow or block,
the longest fitting rule wins) and a block list of canonical URLs.  A URL
that no rule fits is blocked if its canonical form is listed.

The list may be far larger than memory, so it is not joined with all pages.
It is folded into a split-block Bloom filter: a row per block, eight 32-bit
words each, one bit a word per key, about ``BITS_PER_KEY`` bits a key.  A
page looks only at the block its key hashes to; pages without all eight bits
are certainly not listed.  The few possible hits go on to an exact join on
the canonical URL, which removes the false positives.  Both the filter and
the list are broadcast only below a counted bound and joined by shuffle
beyond it.  Everything is DataFrame functions.

Defined cases: a null URL, or one without ``://``, has empty host and path
and an empty canonical form, fits no rule and is allowed; list entries that
are null or empty are ignored and repeated ones count once; an empty list or
table of rules matches nothing; a page that occurs twice is judged twice; of
rules equal in length, ``block`` wins, then the host in order.  Input columns
named like a result are replaced by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
WORDS = 8
#: Rows below which a side is broadcast; a filter row is about 100 bytes, a listed URL is bounded by MAX_BROADCAST_BYTES too.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 << 20

# Odd multipliers of the split-block scheme, one a word, below 2**31 so that products stay longs.
SALTS = [0x47B6137B, 0x44974D91, 0x0824AD5B, 0x22B7289D, 0x705495C7, 0x2DF1424B, 0x1EFC4947, 0x5C6BFB31]

# The rules of the query, as (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

# Query parameters that only track the visitor.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def az_lower(c: Column) -> Column:
    """A-Z as a-z, all else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return az_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last slash or ``.html``, and the parameters that matter."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})="))), "&")
    path = F.regexp_replace(path_of(url), r"(\.html?|/)$", "")
    return F.coalesce(F.concat(F.regexp_replace(host_of(url), r"^www\.", ""), path,
                               F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit(""))), F.lit(""))


def rule_table(spark, rules=None) -> DataFrame:
    """Rules as a DataFrame of host, path, verdict."""
    return spark.createDataFrame(RULES if rules is None else rules, "host string, path string, verdict string")


def _small(df: DataFrame, size: Column) -> bool:
    """Whether at most ``MAX_BROADCAST_ROWS`` rows of at most ``MAX_BROADCAST_BYTES`` in all (reads no more than that)."""
    n, b = df.limit(MAX_BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= MAX_BROADCAST_ROWS and b <= MAX_BROADCAST_BYTES


def _place(key: Column, n_blocks: int) -> tuple[Column, Column]:
    """Block and eight single-bit words of a key."""
    h = F.xxhash64(key)
    low = h.bitwiseAND(F.lit(0x7FFFFFFF))
    block = F.pmod(F.shiftrightunsigned(h, 20), F.lit(n_blocks))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned((low * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")) for s in SALTS]
    return block, F.array(*bits)


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The filter: a row per non-empty block (block, w0..w7)."""
    block, bits = _place(F.col(key), n_blocks)
    placed = listed.select(block.alias("block"), bits.alias("bits"))
    return placed.groupBy("block").agg(*[F.bit_or(F.col("bits")[k]).alias(f"w{k}") for k in range(WORDS)])


def in_list(urls: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows of ``urls`` with ``listed`` boolean: Bloom filter first, exact join for the possible hits."""
    keys = listed.select(F.col(listed_key).alias("__key")).where(F.col("__key") != "").distinct()
    n_blocks = max(1, math.ceil(keys.count() * BITS_PER_KEY / (32 * WORDS)))
    blocks = bloom_blocks(keys, "__key", n_blocks)
    # A filter row is fixed in size, so its number of blocks bounds it.
    blocks = F.broadcast(blocks) if n_blocks <= MAX_BROADCAST_ROWS else blocks
    block, bits = _place(F.col(key), n_blocks)
    seen = urls.withColumns({"block": block, "__bits": bits}).join(blocks, "block", "left")
    maybe = F.lit(True)
    for k in range(WORDS):
        maybe = maybe & (F.col(f"w{k}").bitwiseAND(F.col("__bits")[k]) != 0)
    seen = seen.withColumn("__maybe", F.coalesce(maybe, F.lit(False)) & (F.col(key) != ""))
    # Only possible hits carry a key into the exact join; the rest keep a null, which never joins.
    probe = seen.withColumn("__probe", F.when(F.col("__maybe"), F.col(key))) \
                .drop("block", "__bits", "__maybe", *[f"w{k}" for k in range(WORDS)])
    keys = F.broadcast(keys) if _small(keys, F.octet_length("__key")) else keys
    out = probe.join(keys, F.col("__probe") == F.col("__key"), "left")
    return out.withColumn("listed", F.col("__key").isNotNull()).drop("__probe", "__key")


def fitting_rule(urls: DataFrame, rules: DataFrame) -> Column:
    """The longest rule that fits host and path, as a struct of rule and verdict (null: none).

    The rules are folded into one bounded literal, which is checked first.
    """
    rows = rules.where(F.col("host").isNotNull()).distinct().limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 rules: list single URLs in the block list instead")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rows, key=lambda r: (len(r.host) + len(r.path or ""), r.verdict == "block", r.host)):
        fits = ((F.col("host") == r.host) | F.endswith("host", F.lit("." + r.host))) & F.startswith("path", F.lit(r.path or ""))
        out = F.when(fits, F.struct(F.lit(r.host + (r.path or "")).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, listed: DataFrame, rules: DataFrame, url: str = "url", listed_key: str = "key") -> DataFrame:
    """``pages`` with host, path, canonical_url, rule and verdict."""
    pages = pages.drop("host", "path", "canonical_url", "rule", "verdict", "listed")
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url)), "canonical_url": canonical(F.col(url))})
    out = in_list(pages, "canonical_url", listed, listed_key).withColumn("__rule", fitting_rule(pages, rules))
    return out.withColumns({"rule": F.col("__rule.rule"), "verdict": F.coalesce(
        F.col("__rule.verdict"), F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))}).drop("__rule")


def repeated_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """The list of the query: canonical URLs that two or more pages share."""
    keys = pages.select(canonical(F.col(url)).alias("key")).where(F.col("key") != "")
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdicts of all ``pages``: the rules, then the list of URLs crawled more than once."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    out = filter_urls(pages, repeated_urls(pages), rule_table(spark))
    return out.select("page_id", "host", "path", "rule", "verdict", "canonical_url")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
         regexp_extract(coalesce(url, ''), '^.*?://[^?#]*\?([^#]*)', 1, 's') AS query
  FROM pages),
c AS (
  SELECT page_id, host, path,
         array_to_string(list_sort(list_filter(string_split(query, '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))), '&') AS kept
  FROM p),
k AS (
  SELECT page_id, host, path,
         regexp_replace(host, '^www\.', '') || regexp_replace(path, '(\.html?|/)$', '')
           || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical_url
  FROM c),
l AS (SELECT canonical_url FROM k WHERE canonical_url <> '' GROUP BY 1 HAVING count(*) > 1),
r(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                     ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT k.*, (SELECT max_by({'rule': rhost || rpath, 'verdict': rverdict}, length(rhost) + length(rpath)) FROM r
               WHERE (k.host = rhost OR ends_with(k.host, '.' || rhost)) AND starts_with(k.path, rpath)) AS fit
  FROM k)
SELECT page_id, host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN canonical_url IN (SELECT canonical_url FROM l) THEN 'block' ELSE 'allow' END) AS verdict,
       canonical_url
FROM f
"""

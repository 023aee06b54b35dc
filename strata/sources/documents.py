"""Nested JSON documents as rows, with what does not fit kept instead of lost.

Documents are parsed once into VARIANT, so their shape need not be known or
agree.  An array inside them becomes rows, declared fields become typed
columns, and everything else of an item (fields nobody declared, values that
are not of the declared type) goes to ``rescued``.  Text that is no JSON is
reported, not dropped in silence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_VARIANT, _ITEM = "__variant", "__item"
_JSON, _NAMES, _LEFT = "__json", "__names", "__left"


def read_documents(spark: SparkSession, paths: str | list[str], whole_files: bool = False) -> DataFrame:
    """file and text of each document: one a line, or one a file."""
    text = spark.read.text(paths, wholetext=whole_files)
    return text.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text")).where(F.trim("text") != "")


def malformed(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are no JSON."""
    return documents.where(F.col(text).isNotNull() & F.try_parse_json(text).isNull())


def _typed(value: str, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(value), path, kind)


def flatten(documents: DataFrame, items: str, fields: dict[str, str], header: dict[str, tuple[str, str]] | None = None,
            text: str = "text") -> DataFrame:
    """A row for each item of the array at ``items``.

    ``fields`` maps the items' field names to types, ``header`` a column to
    (path, type) of a value of the document itself.  Documents without such an
    array, and malformed ones, give no rows.  ``rescued`` maps the name of each
    field that found no column to its JSON, or is null; an item that is no
    object is rescued whole, under ``$``.
    """
    parsed = documents.select("*", F.try_parse_json(text).alias(_VARIANT))
    head = [_typed(_VARIANT, path, kind).alias(name) for name, (path, kind) in (header or {}).items()]
    rows = parsed.select(*head, F.posexplode(_typed(_VARIANT, items, "array<variant>")).alias("position", _ITEM))
    # A projection a step: an expression is computed again at each use, inside a lambda for each element.
    fits = F.array(*[F.when(_typed(_ITEM, f"$['{name}']", kind).isNotNull() | F.is_variant_null(_typed(_ITEM, f"$['{name}']", "variant")), F.lit(name))
                     for name, kind in fields.items()])
    rows = rows.withColumn(_JSON, F.to_json(_ITEM)).withColumn(_NAMES, F.json_object_keys(_JSON))
    names = F.coalesce(F.col(_NAMES), F.array().cast("array<string>"))
    rows = rows.withColumn(_LEFT, F.array_except(names, F.array_compact(fits)))
    parts = F.coalesce(F.from_json(_JSON, "map<string,string>"), F.create_map().cast("map<string,string>"))
    rescued = F.when(F.col(_NAMES).isNull(), F.when(F.col(_JSON) != "null", F.create_map(F.lit("$"), F.col(_JSON)))) \
               .when(F.size(_LEFT) > 0, F.map_filter(parts, lambda k, v: F.array_contains(F.col(_LEFT), k)))
    return rows.select(*[name for name in (header or {})], "position", *[_typed(_ITEM, f"$['{n}']", kind).alias(n) for n, kind in fields.items()],
                       rescued.alias("rescued"))

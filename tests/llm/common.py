"""Fixtures and brute-force forms that the tests of the corpus operators share."""

import random
import re

from pyspark.sql import types as T

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si", "to", "vu", "xe") for b in ("b", "d", "f", "gan", "hor", "jil", "kes", "lum")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=1, n=60):
    """Prose with exact copies, near copies, shared lines, odd texts, nulls and repeated rows."""
    rng = random.Random(seed)
    common = prose(rng, 12)
    rows = []
    for k in range(n):
        lines = [prose(rng, rng.randint(6, 60)) for _ in range(rng.randint(1, 5))]
        if k % 4 == 0:
            lines.insert(0, common)
        rows.append((k, "\n".join(lines)))
    rows += [(100 + k, rows[3][1]) for k in range(5)]
    for k in range(8):
        words = (rows[7][1] + " " + prose(random.Random(9), 150)).split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((200 + k, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "One TWO"), (305, "é" * 3 + " É ß " + common),
             (306, prose(rng, 20_000)), (307, "same " * 400), (None, prose(rng, 30)), (308, "a\n\nb\n"), rows[5], rows[5]]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3, **extra):
    """A documents table; ``extra`` adds columns that clash with results."""
    df = spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows], SCHEMA).repartition(parts)
    from pyspark.sql import functions as F
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def ws_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)

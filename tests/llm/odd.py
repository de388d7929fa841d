"""Documents with everything that may go wrong in a table."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

#: names that the operators use inside
CLASHING = ["n", "h", "cls", "root", "rank", "size", "block", "place", "uid", "words", "start", "stop", "spans", "copies", "copy", "score", "y", "slot", "tie", "held_out", "chunk", "target"]


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


LONG = "\n".join(prose(50, 1000 + k) for k in range(400))
SAME = prose(60, 1)
NEAR = SAME.replace(SAME.split()[30], "changed", 1)

ROWS = [
    (1, SAME, "en", "a", 1), (2, SAME, "en", "a", 1), (2, SAME, "en", "a", 1), (3, NEAR.upper(), None, "b", 2), (4, None, "en", "a", None),
    (5, "", "de", None, 0), (6, " \n\t ", "de", "c", 4), (7, "two words", "en", "b", 9), (8, "Two  WORDS", "en", "b", 9), (9, LONG, "fr", None, 7),
    (None, prose(30, 7), "en", "a", 1), (None, None, None, None, None), (10, "MIT License\n" * 3 + "cc-by cc by", "en", "c", 2),
    (11, "é à ü ñ \x00 \x85 end " * 5, "fr", "c", 3), (12, "\n".join([prose(20, 8)] * 4), "en", "b", 5), (-3, prose(40, 9), "en", "a", 1),
    (13, "x" * 5000 + " " + "y" * 70, "en", "b", 5), (14, "<|endoftext|> it's 12 # !!", "en", "", 5), (2**62, prose(40, 10), "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=ROWS, more: bool = False):
    df = spark.createDataFrame(rows, SCHEMA)
    if more:
        for k, name in enumerate(CLASHING):
            df = df.withColumn(name, F.lit(k))
    return df


def labels(spark, rows=((1, 1, 0), (2, 0, 0), (2, 1, 0), (7, 0, None), (None, 1, 0), (12, None, 1), (10, 0, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality long, toxic long")


def items(spark, rows=((1, " ".join(SAME.split()[5:40])), (2, None), (3, ""), (4, "two words"), (1, " ".join(SAME.split()[5:40])), (None, prose(20, 99)))):
    return spark.createDataFrame(list(rows), "item_id long, text string")

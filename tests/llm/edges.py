"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""

import random

from pyspark.sql import types as T

LONG = " ".join(random.Random(3).choice(["the", "ordon", "erth", "shand.", "thing", "with"]) for _ in range(30_000))
UNSPLIT = "".join(random.Random(4).choice("abcdefghinorst") for _ in range(70_000))

# doc_id, text, lang, source, n_chars, and columns that operators might want to call their own.
ROWS = [
    (1, "The and attion to thanedble. Erinst resh over there.", "en", "a", 52, "x", 7),
    (1, "The and attion to thanedble. Erinst resh over there.", "en", "a", 52, "x", 7),  # repeated row
    (2, "THE AND attion to thanedble. Erinst resh over there.", None, None, None, None, None),
    (3, None, "en", "b", None, "y", 1),
    (4, "", "de", "b", 0, "y", 1),
    (None, "heitpf ung enlich schzuach nicht die ber der", "de", None, 45, None, 2),
    (None, None, None, None, None, None, None),
    (5, " \t\n\r\x0b\x0c ", "fr", "c", 7, "z", 3),
    (6, "12 34 !!! ###", "fr", "c", 13, "z", 3),
    (7, LONG, "en", "c", len(LONG), "z", 3),
    (8, UNSPLIT, "es", "c", len(UNSPLIT), "z", 3),
    (9, "leaux mentré de la écôle où ça \U0001f600 中文 <|endoftext|> fin", "fr", "d", 40, "z", 4),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("row", T.StringType()),
        T.StructField("row_id", T.IntegerType()),
    ]
    + [T.StructField(name, T.StringType()) for name in ("spans", "digest", "sha", "count", "key", "block", "gram", "fp", "root")]
)


def edge_docs(spark, rows=ROWS):
    return spark.createDataFrame([(*row, *["clash"] * 9) for row in rows], SCHEMA)


def stored(spark, df, folder):
    """As a stored table, which the stages are given."""
    path = str(folder / "docs.parquet")
    df.write.parquet(path)
    return spark.read.parquet(path)

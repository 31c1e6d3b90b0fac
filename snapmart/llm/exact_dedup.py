"""Exact duplicates by skew-safe combining, made of DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Equal texts are combined in three stages, and each stage
groups by the digest *and* the whole text, so that a digest never decides alone:

1. every task combines its own copies (the partial aggregate before the shuffle);
2. the rows of hot digests are dealt over salts, one salt per reading partition, and merged per salt;
3. the salt winners of each text meet in a second aggregate. Texts travel there for hot digests only; for the others
   stage 2 has already met every copy, and the stage counts how many different texts share the digest.

Should texts differ under one digest, their documents are joined with the winners by the text itself.

Defined results: a null text counts as empty. The kept row has the largest id; a null id is smaller than any other.
Of rows that repeat both id and text, exactly one is kept, the first as read. An empty table gives an empty result.
Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import ascii_lower, fresh, materialize, numbered, small_enough, without_rows

#: Documents of one digest above which it is salted.
HOT_ROWS = 1000
SALTS = 32
#: Digests broadcast at most: 64 hex digits each, so some 10 MB.
BROADCAST_DIGESTS = 100_000


def normalized(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    digest_of: Callable[[Column], Column] = lambda sha: sha,
) -> DataFrame:
    """One row per document: row_id, doc_id, keep_id, group_size, kept, text_sha256.

    digest_of shortens the digest the groups are keyed by; a weak one costs time, never correctness.
    """
    row = fresh(docs, "row")
    texts = numbered(docs, row).select(
        F.col(row).alias("row_id"),
        F.col(id_col).alias("doc_id"),
        normalized(F.col(text_col)).alias("text"),
    ).withColumn("sha", F.sha2("text", 256))
    texts = texts.withColumn("digest", digest_of(F.col("sha")))
    keys = materialize(texts.drop("text"))

    hot = materialize(keys.groupBy("digest").count().filter(F.col("count") > hot_rows).select("digest"))
    winners = materialize(combine(texts, hot, salts))
    firsts = keys.groupBy("digest", F.col("doc_id").alias("keep_id")).agg(F.min("row_id").alias("keep_row"))
    same = winners.filter("variants = 1").alias("w").join(
        firsts.alias("f"),
        (F.col("w.digest") == F.col("f.digest")) & F.col("w.keep_id").eqNullSafe(F.col("f.keep_id")),
    )
    same = same.select("w.digest", "w.keep_id", "group_size", "keep_row")
    result = keys.join(same, "digest")
    clashing = winners.filter("variants > 1").select("digest")
    if not clashing.isEmpty():
        result = result.unionByName(by_text(texts, clashing))
    return result.select(
        "row_id", "doc_id", "keep_id", "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def combine(texts: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """Per digest: largest id, number of documents, number of different texts."""
    marked = texts.join(small_enough(hot, BROADCAST_DIGESTS).withColumn("hot", F.lit(True)), "digest", "left")
    salted = marked.select(
        "digest",
        "text",
        "doc_id",
        F.coalesce("hot", F.lit(False)).alias("hot"),
        F.when(F.col("hot"), F.spark_partition_id() % salts).otherwise(0).alias("salt"),
    )
    merged = salted.groupBy("digest", "hot", "salt", "text").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")
    )
    hot_text = F.when(F.col("hot"), F.col("text"))
    met = merged.groupBy("digest", "hot", hot_text.alias("text")).agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")
    )
    return met.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.sum(F.when(F.col("hot"), 1).otherwise(F.col("rows"))).alias("variants"),
    )


def by_text(texts: DataFrame, clashing: DataFrame) -> DataFrame:
    """The rows of digests that different texts share, grouped by text."""
    rows = texts.join(clashing, "digest", "left_semi")
    kept = rows.groupBy("digest", "text").agg(
        F.max(F.struct(F.col("doc_id"), (-F.col("row_id")).alias("back"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    kept = kept.select(
        "digest", "text", F.col("best.doc_id").alias("keep_id"), (-F.col("best.back")).alias("keep_row"), "group_size"
    )
    return rows.join(kept, ["digest", "text"]).drop("text")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; docs must be a stored table."""
    dropped = exact_duplicates(docs, id_col, text_col).filter(~F.col("kept")).select("row_id")
    return without_rows(docs, dropped)

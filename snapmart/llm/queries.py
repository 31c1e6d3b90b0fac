"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import (
    bpe,
    collocations,
    de_bruijn,
    exact_dedup,
    kneser_ney,
    language_crf,
    line_cleaning,
    packing,
    pii,
    simhash,
    url_filter,
    variants,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_warc_transactions(spark, sf):
    return warc.archived_pages(table(spark, sf, "pages"))


@query
def op2_simhash_bk_trees(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op3_line_cleaning(spark, sf):
    return line_cleaning.clean_lines(table(spark, sf, "documents")).drop("cleaned")


@query
def op4_pii_bootstrap(spark, sf):
    found = pii.personal_data(table(spark, sf, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


@query
def op5_url_filter(spark, sf):
    pages = table(spark, sf, "pages")
    return url_filter.judge(pages, url_filter.train(url_filter.labelled_by_rules(pages)))


@query
def op6_exact_dedup(spark, sf):
    return exact_dedup.exact_duplicates(table(spark, sf, "documents")).drop("row_id")


@query
def op7_kneser_ney(spark, sf):
    trusted = table(spark, sf, "labels").filter("quality = 1 and coalesce(toxic, 0) = 0").select("doc_id")
    judged = kneser_ney.quality(table(spark, sf, "documents"), trusted)
    return judged.select("doc_id", "lang", "perplexity", "threshold", "kept")


@query
def op8_bpe_tree(spark, sf):
    return bpe.encode_documents(table(spark, sf, "documents")).drop("row_id")


@query
def op9_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


@query
def op10_language_crf(spark, sf):
    docs = table(spark, sf, "documents")
    found = language_crf.identify(docs, language_crf.learn(docs))
    return found.select("doc_id", language_crf.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op11_de_bruijn_compaction(spark, sf):
    return de_bruijn.remove_repeats(table(spark, sf, "documents")).drop("row_id")


@query
def op12_sorted_list_variants(spark, sf):
    return variants.spelling_variants(table(spark, sf, "documents"))


@query
def op13_setm_collocations(spark, sf):
    return collocations.collocations(table(spark, sf, "documents"))

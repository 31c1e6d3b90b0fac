from pyspark.sql import functions as F

from snapmart.llm import kneser_ney as kn
from snapmart.llm.store import BATCH_BYTES, materialize_texts, numbered, without_rows

CUT = "spark.sql.files.maxPartitionBytes"


def test_rows_keep_their_numbers_when_files_are_cut_otherwise(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    docs = spark.range(3000, numPartitions=2).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("text"), F.lit("en").alias("lang"))
    docs.write.option("parquet.block.size", 20_000).option("compression", "none").parquet(path)
    docs = spark.read.parquet(path)
    try:
        whole = docs.rdd.getNumPartitions()
        before = {r.doc_id: r.row_id for r in numbered(docs).select("doc_id", "row_id").collect()}
        less = without_rows(docs, numbered(docs).filter("doc_id % 3 = 0").select("row_id"))
        scored = kn.perplexities(docs, kn.train(docs.limit(200)))
        spark.conf.set(CUT, "32k")
        docs = spark.read.parquet(path)
        assert docs.rdd.getNumPartitions() > whole
        assert {r.doc_id: r.row_id for r in numbered(docs).select("doc_id", "row_id").collect()} == before and len(set(before.values())) == 3000
        assert less.columns == docs.columns and {r.doc_id for r in less.collect()} == {i for i in range(3000) if i % 3}
        assert {r.row_id for r in scored.collect()} == set(before.values())
    finally:
        spark.conf.unset(CUT)


def test_size_of_batches_is_set_only_while_a_table_is_made(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    wide = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 50_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield batch.select([0]).from_pydict({"n": [batch.num_rows]})

    rows = [r.n for r in materialize_texts(wide.mapInArrow(sizes, "n long")).collect()]
    assert sum(rows) == 2000 and max(rows) <= BATCH_BYTES // 50_000 + 1
    assert spark.conf.get(name, None) == before

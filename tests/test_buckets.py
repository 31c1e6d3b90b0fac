from datetime import date

import pytest
from pyspark.sql import functions as F

from snapmart.plans.gold import gold_customer
from snapmart.schemas import CUSTOMER_KEYS, SNAPSHOT
from snapmart.session import setting
from snapmart.sources.buckets import Buckets, evenly_bucketed, read_buckets, write_buckets
from snapmart.sources.snapshots import read_snapshots, write_snapshots

JAN, FEB = date(2023, 1, 1), date(2023, 2, 1)
EIGHT = Buckets("Customer_ID", 8)


def customers(spark, n, column, hot=False):
    """Every customer in both months, a hot one as a third of the rows."""
    key = F.concat(F.lit("CUS_"), F.col("id") if not hot else F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    rows = spark.range(n).select(key.alias("Customer_ID"), F.hex(F.xxhash64("id")).alias(column))
    return rows.crossJoin(spark.createDataFrame([(JAN,), (FEB,)], f"{SNAPSHOT} date"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sides(spark, tmp_path):
    found = []
    for name in ("x", "y"):
        df, path = customers(spark, 500, name), f"{tmp_path}/{name}'s"
        write_buckets(df, path, EIGHT)
        found.append((path, df.schema))
    return found


def test_bucketed_tables_join_without_an_exchange(spark, sides):
    expected = gold_customer(customers(spark, 500, "x"), customers(spark, 500, "y"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        joined = gold_customer(*[read_buckets(spark, path, schema, EIGHT, [JAN, FEB]) for path, schema in sides])
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert joined.columns == expected.columns
        assert sorted(joined.collect()) == sorted(expected.collect())
        plain = gold_customer(*[read_snapshots(spark, path, None, schema) for path, schema in sides])
        assert "Exchange" in plan_of(plain) and plain.count() == 1000


def test_a_month_is_replaced_and_others_stay(spark, sides):
    path, schema = sides[0]
    fewer = customers(spark, 40, "x").where(F.col(SNAPSHOT) == F.lit(FEB))
    rows = write_snapshots(fewer, path, [FEB], write=lambda df, to: write_buckets(df, to, EIGHT))
    assert rows == {FEB: 40}
    found = read_buckets(spark, path, schema, EIGHT)
    assert {r[SNAPSHOT]: r["count"] for r in found.groupBy(SNAPSHOT).count().collect()} == {JAN: 500, FEB: 40}
    write_snapshots(fewer.limit(0), path, [FEB], write=lambda df, to: write_buckets(df, to, EIGHT))
    assert read_buckets(spark, path, schema, EIGHT).where(F.col(SNAPSHOT) == F.lit(FEB)).isEmpty()
    assert read_buckets(spark, path, schema, EIGHT, [JAN]).count() == 500


def test_crowded_and_plain_files_are_told(spark, sides, tmp_path):
    path, schema = sides[0]
    assert evenly_bucketed(spark, path, schema, EIGHT, crowded_bytes=0)
    crowded = f"{tmp_path}/hot"
    write_buckets(customers(spark, 3000, "x", hot=True).withColumn("x", F.when(F.col("Customer_ID") == "CUS_0", F.repeat("x", F.lit(40))).otherwise("")), crowded, EIGHT)
    assert evenly_bucketed(spark, crowded, schema, EIGHT)
    plain = f"{tmp_path}/plain"
    write_snapshots(customers(spark, 100, "x"), plain)
    assert not evenly_bucketed(spark, plain, schema, EIGHT)
    # One bucket with nearly all bytes.
    one = customers(spark, 5000, "x").where(F.pmod(F.hash("Customer_ID"), F.lit(8)) == 3)
    write_buckets(one, f"{tmp_path}/one", EIGHT)
    assert not evenly_bucketed(spark, f"{tmp_path}/one", schema, EIGHT, crowded_bytes=1000)


def test_rows_are_where_their_key_belongs(spark, sides):
    path, schema = sides[0]
    plain = read_snapshots(spark, path, None, schema)
    number = F.regexp_extract(plain.metadataColumn("_metadata")["file_name"], r"_(\d+)\.", 1).cast("int")
    assert plain.where(number != F.pmod(F.hash(CUSTOMER_KEYS[0]), F.lit(8))).isEmpty() and plain.count() == 1000

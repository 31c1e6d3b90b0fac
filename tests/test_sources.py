from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapmart.plans.bronze import build_bronze
from snapmart.schemas import ATTRIBUTES, SNAPSHOT
from snapmart.sources.delimited import read_delimited, refused_lines, write_delimited
from snapmart.sources.snapshots import read_snapshots, write_snapshots
from tests import raw
from tests.conftest import rows

JAN, FEB, MAR = raw.MONTHS
HEADER = ATTRIBUTES.column_names


def table(spark, pairs):
    return spark.createDataFrame(pairs, f"v int, {SNAPSHOT} date")


def test_quotes_survive(spark, tmp_path):
    name = ' A "quoted", name '
    path = raw.write(tmp_path / "a.csv", HEADER, [["1", name, "30_", "s", "Lawyer", "01/01/2023"]])
    df = read_delimited(spark, path, HEADER)
    assert df.dtypes == [(c, "string") for c in HEADER]
    assert rows(df) == [("1", name, "30_", "s", "Lawyer", "01/01/2023")]
    write_delimited(df, str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), HEADER)) == rows(df)


def test_many_files_by_glob(spark, tmp_path):
    for i in range(3):
        raw.write(tmp_path / f"part_{i}.csv", ["a", "b"], [[str(i), "x"]])
    df = read_delimited(spark, str(tmp_path / "part_*.csv"), ["a", "b"])
    assert sorted(rows(df)) == [("0", "x"), ("1", "x"), ("2", "x")]


def test_columns_are_found_by_name(spark, tmp_path):
    path = raw.write(tmp_path / "a.csv", ["b", "c", "a"], [["2", "3", "1"]])
    assert rows(read_delimited(spark, path, ["a", "b"])) == [("1", "2")]
    with pytest.raises(ValueError, match="d"):
        read_delimited(spark, path, ["a", "d"])


def test_a_differing_header_is_an_error(spark, tmp_path):
    raw.write(tmp_path / "part_0.csv", ["a", "b"], [["1", "2"]])
    raw.write(tmp_path / "part_1.csv", ["b", "a"], [["2", "1"]])
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_delimited(spark, str(tmp_path / "part_*.csv"), ["a", "b"]).collect()


def test_csv_partitioned_by_snapshot(spark, tmp_path):
    path = str(tmp_path / "out")
    write_delimited(table(spark, [(1, JAN), (2, FEB)]), path, partition_by=[SNAPSHOT])
    assert (tmp_path / "out" / f"{SNAPSHOT}=2023-02-01").is_dir()
    assert sorted(rows(spark.read.option("header", True).csv(path).select("v"))) == [("1",), ("2",)]


def test_bronze_keeps_exact_snapshots_of_all_months_in_one_pass(spark, tmp_path):
    df = read_delimited(spark, raw.write_sources(tmp_path)["attributes"], HEADER)
    bronze = build_bronze(df, ATTRIBUTES, raw.MONTHS)
    assert bronze.schema == ATTRIBUTES.bronze_schema
    assert bronze.count() == 240 and bronze.where("Customer_ID = 'CUS_mid'").isEmpty()
    assert build_bronze(df, ATTRIBUTES, [FEB]).count() == 80
    assert build_bronze(df, ATTRIBUTES).count() == 241


def test_rerun_replaces_only_its_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshots(table(spark, [(1, JAN), (2, FEB), (3, FEB)]), path, [JAN, FEB]) == {JAN: 1, FEB: 2}
    assert write_snapshots(table(spark, [(9, JAN), (5, FEB), (7, MAR)]), path, [FEB]) == {FEB: 1}
    df = read_snapshots(spark, path)
    assert sorted(rows(df.select("v", SNAPSHOT))) == [(1, JAN), (5, FEB)]
    write_snapshots(table(spark, [(5, FEB)]), path, [FEB])
    assert read_snapshots(spark, path).count() == 2


def test_rerun_without_rows_empties_its_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshots(table(spark, [(1, JAN), (2, FEB)]), path, [JAN, FEB])
    assert write_snapshots(table(spark, []), path, [FEB]) == {FEB: 0}
    assert rows(read_snapshots(spark, path).select("v", SNAPSHOT)) == [(1, JAN)]


def test_empty_table_keeps_its_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = table(spark, [])
    write_snapshots(empty, path, [JAN])
    again = read_snapshots(spark, path, schema=empty.schema)
    assert again.dtypes == empty.dtypes and again.isEmpty()


def test_reading_one_snapshot_prunes_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshots(table(spark, [(1, JAN), (2, FEB), (3, MAR)]), path, raw.MONTHS)
    df = read_snapshots(spark, path, [FEB])
    assert rows(df) == [(2, FEB)]
    assert all(f"{SNAPSHOT}=2023-02-01" in row[0] for row in df.select(F.input_file_name()).collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_a_large_snapshot_is_split_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        hot = spark.range(200_000).select(
            F.xxhash64("id").alias("v"),
            F.when(F.col("id") % 10 == 0, F.lit(JAN)).otherwise(F.lit(FEB)).alias(SNAPSHOT),
        )
        write_snapshots(hot.repartition(8), path, [JAN, FEB])
    finally:
        spark.conf.set(size, before)
    files = len(list((Path(path) / f"{SNAPSHOT}=2023-02-01").glob("*.parquet")))
    assert files > 4
    assert read_snapshots(spark, path).count() == 200_000


def test_lines_that_do_not_fit_are_refused_and_kept(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,b,refused\n1,2,3\n4,5\n6,7,8,9\n"x\n'.replace('"x', '"x, y",,z'))
    (tmp_path / "two.csv").write_text("a,b,refused\n,,\nonly\n")
    path = str(tmp_path / "*.csv")
    kept = sorted((tuple(r) for r in read_delimited(spark, path, ["b", "a", "refused"]).collect()), key=str)
    assert kept == sorted([("2", "1", "3"), (None, "x, y", "z"), (None, None, None)], key=str)
    refused = refused_lines(spark, path, ["a"])
    assert sorted((r.file.rsplit("/", 1)[1], r.line) for r in refused.collect()) == [("one.csv", "4,5"), ("one.csv", "6,7,8,9"), ("two.csv", "only")]
    assert read_delimited(spark, path, ["a"]).count() + refused.count() == 6
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_delimited(spark, path, ["a", "b"], strict=True).collect()

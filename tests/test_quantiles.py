import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapmart.operators import quantiles
from snapmart.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame():
    rng = np.random.default_rng(5)
    n = 60_000
    # One group has a third of all rows, one has three; one column is mostly a single value.
    group = np.where(np.arange(n) % 3 == 0, "hot", rng.choice(["a", "b", "c"], n))
    pdf = pd.DataFrame(
        {
            "g": group,
            "smooth": np.round(rng.normal(100, 20, n), 2),
            "tied": np.where(rng.random(n) < 0.8, 7.0, rng.integers(0, 50, n)),
            "tailed": np.exp(rng.normal(0, 6, n)),
        }
    )
    tiny = pd.DataFrame({"g": ["tiny"] * 3, "smooth": [1.0, 2.0, 4.0], "tied": [5.0] * 3, "tailed": [9.0, 8.0, 7.0]})
    return pd.concat([pdf, tiny], ignore_index=True)


def expected(values, p, interpolate):
    values = np.sort(values)
    if interpolate:
        return np.quantile(values, p)
    return values[max(math.ceil(p * len(values)), 1) - 1]


COLUMNS = ["smooth", "tied", "tailed"]


@pytest.fixture(scope="module")
def data(spark):
    pdf = frame()
    return pdf, spark.createDataFrame(pdf).repartition(8).persist()


@pytest.mark.parametrize("interpolate", [True, False])
def test_by_group_against_numpy(data, interpolate):
    pdf, df = data
    found = exact_quantiles(df, COLUMNS, PROBABILITIES, ["g"], interpolate).collect()
    assert {row.g for row in found} == set(pdf.g)
    for row in found:
        for name in COLUMNS:
            values = pdf.loc[pdf.g == row.g, name].to_numpy()
            wanted = [expected(values, p, interpolate) for p in PROBABILITIES]
            assert row[name] == pytest.approx(wanted, rel=1e-12), (row.g, name)


def test_whole_table(data):
    pdf, df = data
    row = exact_quantiles(df, COLUMNS, [0.25, 0.5, 0.75]).first()
    for name in COLUMNS:
        assert row[name] == pytest.approx(list(pdf[name].quantile([0.25, 0.5, 0.75])), rel=1e-12)


def test_a_missed_bracket_is_widened(data, monkeypatch):
    pdf, df = data
    tries = []
    brackets = quantiles._brackets

    def useless_first(numbers, columns, probabilities, by, width):
        tries.append(width)
        found = brackets(numbers, columns, probabilities, by, width)
        if len(tries) > 1:
            return found
        nowhere = F.array(F.lit(-1e9))
        return found.withColumns({"low": nowhere, "high": nowhere})

    monkeypatch.setattr(quantiles, "_brackets", useless_first)
    row = exact_quantiles(df, ["smooth"], [0.5]).first()
    assert len(tries) == 2
    assert row["smooth"] == pytest.approx([pdf.smooth.median()])


def test_nulls_nan_infinities_and_empty_columns(spark):
    inf = float("inf")
    df = spark.createDataFrame(
        [(1.0, None, inf), (None, None, -inf), (float("nan"), None, 1.0), (3.0, None, 2.0)], "x double, none double, y double"
    )
    row = exact_quantiles(df, ["x", "none", "y"], [0.5]).first()
    assert row["x"] == [2.0] and row["none"] is None and row["y"] == [1.5]


@pytest.mark.parametrize("interpolate", [True, False])
def test_empty_input(spark, interpolate):
    df = spark.createDataFrame([], "g string, x double")
    assert exact_quantiles(df, ["x"], [0.5], ["g"], interpolate).collect() == []
    assert exact_quantiles(df, ["x"], [0.5], (), interpolate).first()["x"] is None


def test_same_with_more_groups_than_may_be_broadcast(data, monkeypatch):
    pdf, df = data
    plain = quantiles.join_statistics
    monkeypatch.setattr(quantiles, "join_statistics", lambda a, b, on: plain(a, b, on, max_broadcast_rows=0))
    found = exact_quantiles(df, ["smooth"], [0.5], ["g"])
    assert {r.g: r.smooth[0] for r in found.collect()} == pytest.approx(dict(pdf.groupby("g").smooth.median()))


def test_a_null_group_is_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0)], "g string, x double")
    found = exact_quantiles(df, ["x"], [0.5], ["g"]).collect()
    assert {r.g: r.x for r in found} == {"a": [2.0], None: [7.0]}


def test_a_heavy_tail_is_dealt_over_tasks(spark, monkeypatch):
    """A column whose values crowd in one bin of its bracket: no range of the look-up holds most of them."""
    rng = np.random.default_rng(9)
    values = np.unique(np.exp(rng.normal(0, 12, 40_000)))
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(8)
    dealt = []
    plain = quantiles._dealt

    def spy(*given):
        out = plain(*given)
        dealt.append([row["n"] for row in out.groupBy("chunk").agg(F.count("*").alias("n")).collect()])
        return out

    monkeypatch.setattr(quantiles, "_dealt", spy)
    # Brackets as wide as the table, so that the look-up gets every value.
    monkeypatch.setattr(quantiles, "BRACKET_WIDTHS", (1.0,))
    with_conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = exact_quantiles(df, ["x"], [0.5]).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_conf)
    assert row["x"] == pytest.approx([np.quantile(values, 0.5)])
    assert len(dealt[0]) > 100 and max(dealt[0]) < 0.05 * len(values) < sum(dealt[0])


def test_one_checkpoint_without_groups(data, monkeypatch):
    pdf, df = data
    stored = []
    plain = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda made: stored.append(1) or plain(made))
    row = exact_quantiles(df, COLUMNS, [0.25, 0.75]).first()
    assert len(stored) == 1 and row["smooth"] == pytest.approx(list(pdf.smooth.quantile([0.25, 0.75])), rel=1e-12)

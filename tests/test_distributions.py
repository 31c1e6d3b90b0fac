import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from snapmart.operators import distributions
from tests.conftest import rows


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"x": np.round(rng.gamma(2, 30, 3000), 2), "k": rng.integers(-3, 60, 3000)})
    pdf.loc[pdf.k == 20, "k"] = 21
    return pdf, spark.createDataFrame(pdf).repartition(4).persist()


def test_summary_matches_pandas(data):
    pdf, df = data
    for row in distributions.summary_stats(df, ["x", "k"]).collect():
        s = pdf[row["column"]].describe()
        assert list(row)[1:] == pytest.approx(list(s), rel=1e-9)


def test_columns_without_values_are_listed(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    found = {r["column"]: tuple(r)[1:] for r in distributions.summary_stats(df, ["a", "b"]).collect()}
    assert found["b"] == (0, None, None, None, None, None, None, None)
    assert found["a"][0] == 2 and found["a"][5] == 2.0
    report = {r["column"]: r for r in distributions.iqr_report(df, ["a", "b"]).collect()}
    assert report["b"].n_outliers == 0 and report["b"].pct_outliers is None and report["b"].q1 is None
    assert [r["column"] for r in distributions.boxplot_stats(df, ["a", "b"]).collect()] == ["a"]


def test_iqr_report(data):
    pdf, df = data
    row = distributions.iqr_report(df, ["x"]).first()
    q1, q3 = pdf.x.quantile(0.25), pdf.x.quantile(0.75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    outside = ((pdf.x < low) | (pdf.x > high)).sum()
    assert row.n_outliers == outside
    assert row.pct_outliers == round(100 * outside / len(pdf), 2)
    assert [row.q1, row.q3, row.lower_bound, row.upper_bound] == pytest.approx([q1, q3, low, high])


def test_boxplot(data):
    pdf, df = data
    row = distributions.boxplot_stats(df, ["x"]).first()
    q1, q3 = pdf.x.quantile(0.25), pdf.x.quantile(0.75)
    inside = pdf.x[(pdf.x >= q1 - 1.5 * (q3 - q1)) & (pdf.x <= q3 + 1.5 * (q3 - q1))]
    assert (row.whisker_low, row.whisker_high) == (inside.min(), inside.max())
    assert row.fliers == len(pdf) - len(inside)


@pytest.mark.parametrize("column,bins", [("x", 50), ("k", 60), ("k", 63), ("k", 7)])
def test_histogram_matches_numpy(data, column, bins):
    pdf, df = data
    counts, edges = np.histogram(pdf[column], bins=bins)
    found = rows(distributions.histogram(df, column, bins))
    assert [r[0] for r in found] == list(range(bins))
    assert [r[3] for r in found] == list(counts)
    assert [r[1] for r in found] == pytest.approx(list(edges[:-1]))
    assert [r[2] for r in found] == pytest.approx(list(edges[1:]))


def test_histogram_edges_decide(spark):
    # Multiples of a tenth fall on edges that floating point puts to either side.
    values = [i / 10 for i in range(11)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[3] for r in rows(distributions.histogram(df, "x", 10))] == list(np.histogram(values, bins=10)[0])


def test_histogram_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    found = rows(distributions.histogram(df, "x", 4))
    assert [r[3] for r in found] == list(np.histogram([5.0, 5.0], bins=4)[0])
    assert found[0][1] == 4.5 and found[-1][2] == 5.5
    assert rows(distributions.histogram(df.where("false"), "x", 4)) == []


def test_histogram_threshold(data):
    pdf, df = data
    found = distributions.histogram(df, "k", 60, threshold=30).collect()
    assert sum(r.n_at_or_above for r in found) == (pdf.k >= 30).sum()


def test_integer_histogram_fills_gaps(data, spark):
    pdf, df = data
    found = dict(rows(distributions.integer_histogram(df, "k", dense=True)))
    assert dict(rows(distributions.integer_histogram(df, "k"))) == {value: n for value, n in found.items() if n}
    far = spark.createDataFrame([(1,), (2_000_000_000,), (1,)], "k int")
    assert rows(distributions.integer_histogram(far, "k")) == [(1, 2), (2_000_000_000, 1)]
    assert found == {k: int((pdf.k == k).sum()) for k in range(pdf.k.min(), pdf.k.max() + 1)}
    assert found[20] == 0
    assert rows(distributions.integer_histogram(df.where("false"), "k", dense=True)) == []


def test_kernel_density(data):
    pdf, df = data
    x = pdf.x.to_numpy()
    h = x.std(ddof=1) * len(x) ** (-1 / 5)
    grid = np.linspace(x.min(), x.max(), 200)
    density = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi))
    found = distributions.kernel_density(df, "x").collect()
    assert [r.x for r in found] == pytest.approx(list(grid))
    assert [r.density for r in found] == pytest.approx(list(density))
    assert [r.curve for r in found] == pytest.approx(list(density * len(x) * (x.max() - x.min()) / 50))
    assert rows(distributions.kernel_density(df.where("false"), "x")) == []


def test_nan_is_missing(spark):
    nan = float("nan")
    with_nan = spark.createDataFrame([(1.0,), (nan,), (2.0,), (4.0,), (None,)], "x double")
    without = with_nan.where("x is not null and not isnan(x)")
    for make in (
        lambda df: distributions.summary_stats(df, ["x"]),
        lambda df: distributions.histogram(df, "x", 3),
        lambda df: distributions.kernel_density(df, "x", grid=5),
        lambda df: distributions.boxplot_stats(df, ["x"]),
        lambda df: distributions.iqr_report(df, ["x"]),
    ):
        assert make(with_nan).collect() == make(without).collect()


def test_curves_of_many_columns(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=3000), rng.lognormal(0, 2, 3000)
    table = [(float(a), float(b), 4.0, None, float(i) if i < 1 else None) for i, (a, b) in enumerate(zip(x, y))] + [(float("nan"),) * 2 + (None,) * 3]
    df = spark.createDataFrame(table, "x double, y double, flat double, empty double, one double")
    histograms, densities = distributions.curves(df, df.columns, bins=20)
    for name in df.columns:
        own = histograms.where(F.col("column") == name).drop("column").orderBy("bin")
        assert rows(own) == rows(distributions.histogram(df, name, 20))
    for name, values in (("x", x), ("y", y)):
        h = values.std(ddof=1) * len(values) ** (-1 / 5)
        grid = np.linspace(values.min(), values.max(), 200)
        exact = np.exp(-(((grid[:, None] - values) / h) ** 2) / 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
        found = densities.where(F.col("column") == name).orderBy("point").collect()
        assert [r.x for r in found] == pytest.approx(list(grid))
        assert max(abs(r.density - want) for r, want in zip(found, exact)) < 1e-9 / (h * np.sqrt(2 * np.pi))
    assert {r.column for r in densities.collect()} == {"x", "y"}


def test_reads_of_curves_do_not_grow_with_the_columns(spark):
    many = spark.range(200).select(*[(F.col("id") * k % 17).cast("double").alias(f"c{k}") for k in range(1, 7)])

    def jobs(columns):
        group = f"curves-{len(columns)}"
        spark.sparkContext.setJobGroup(group, group)
        histograms, densities = distributions.curves(many, columns)
        histograms.count(), densities.count()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(many.columns[:1]) == jobs(many.columns)


def test_profile_skips_nan(spark):
    from snapmart.plans.profiling import profile_table

    nan = float("nan")
    with_nan = spark.createDataFrame([(1.0,), (nan,), (2.0,), (4.0,)], "x double")
    found = {r.metric: r.value for r in profile_table(with_nan).collect()}
    assert (found["min"], found["max"], found["p50"]) == (1.0, 4.0, 2.0) and found["mean"] == pytest.approx(7 / 3)

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapmart.operators import outliers
from snapmart.operators.outliers import below_fences, pooled_fences, upper_fences
from snapmart.operators.sketches import quantile_state
from snapmart.plans.silver import silver_financials
from snapmart.schemas import SNAPSHOT
from tests.conftest import rows

JAN, FEB = date(2023, 1, 1), date(2023, 2, 1)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    values = [(JAN, float(v)) for v in rng.integers(0, 100, 400)] + [(FEB, float(v)) for v in rng.integers(0, 1000, 400)]
    extra = [(JAN, 1e6), (FEB, -1.0), (FEB, None)]
    return spark.createDataFrame(values + extra, f"{SNAPSHOT} date, x double").persist()


def element_quantile(values, p):
    values = sorted(values)
    return values[max(int(np.ceil(p * len(values))), 1) - 1]


def expected_fence(pairs, k=1.5):
    values = [v for _, v in pairs if v is not None]
    q1, q3 = element_quantile(values, 0.25), element_quantile(values, 0.75)
    return q3 + k * (q3 - q1)


@pytest.mark.parametrize("exact", [True, False])
def test_fences_per_snapshot(data, exact):
    pairs = rows(data)
    found = {r[SNAPSHOT]: r.upper_fence for r in upper_fences(data, ["x"], exact=exact).collect()}
    for day in (JAN, FEB):
        assert found[day] == expected_fence([p for p in pairs if p[0] == day])


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("by", [(SNAPSHOT,), ()])
def test_filter_keeps_zero_to_fence(data, exact, by):
    pairs = rows(data)
    kept = []
    for day in (JAN, FEB):
        fence = expected_fence([p for p in pairs if p[0] == day] if by else pairs)
        kept += [p for p in pairs if p[0] == day and p[1] is not None and 0 <= p[1] <= fence]
    found = below_fences(data, ["x"], by, exact=exact)
    assert found.columns == data.columns
    assert sorted(rows(found)) == sorted(kept)


def test_same_without_broadcast(data, monkeypatch):
    plain = outliers.join_statistics
    wanted = sorted(rows(below_fences(data, ["x"])))
    monkeypatch.setattr(outliers, "join_statistics", lambda a, b, on: plain(a, b, on, max_broadcast_rows=0))
    found = below_fences(data, ["x"])
    assert sorted(rows(found)) == wanted


def test_all_fences_come_from_the_unfiltered_rows(spark):
    # The row that y cuts would raise the fence of x if it were removed first.
    data = [(JAN, float(i), float(i % 3)) for i in range(8)] + [(JAN, 0.0, 1000.0)]
    df = spark.createDataFrame(data, f"{SNAPSHOT} date, x double, y double")
    together = sorted(rows(below_fences(df, ["x", "y"], exact=True)))
    fence = {r.column: r.upper_fence for r in upper_fences(df, ["x", "y"], exact=True).collect()}
    assert together == sorted(p for p in data if 0 <= p[1] <= fence["x"] and 0 <= p[2] <= fence["y"])


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("by", [(SNAPSHOT,), ()])
def test_empty_and_all_null(spark, exact, by):
    empty = spark.createDataFrame([], f"{SNAPSHOT} date, x double")
    assert rows(below_fences(empty, ["x"], by, exact=exact)) == []
    nulls = spark.createDataFrame([(JAN, None)], f"{SNAPSHOT} date, x double")
    assert rows(below_fences(nulls, ["x"], by, exact=exact)) == []
    assert rows(upper_fences(nulls, ["x"], by, exact=exact)) == []


def test_unknown_scope(spark):
    with pytest.raises(ValueError, match="fence scope"):
        silver_financials(spark.createDataFrame([], "a string"), fence_scope="weekly")


@pytest.mark.parametrize("exact", [True, False])
def test_nan_is_skipped(spark, exact):
    nan = float("nan")
    df = spark.createDataFrame([(JAN, float(v)) for v in range(1, 7)] + [(JAN, nan)] * 4, f"{SNAPSHOT} date, x double")
    found = upper_fences(df, ["x"], exact=exact).first()
    assert [found.q1, found.q3] == df.approxQuantile("x", [0.25, 0.75], 0.0) == [2.0, 5.0]
    assert found.upper_fence == 9.5
    assert sorted(r.x for r in below_fences(df, ["x"], exact=exact).collect()) == [1, 2, 3, 4, 5, 6]


def test_financials_with_nan_texts_get_the_fences_of_their_numbers(spark):
    from snapmart.plans.silver import clean_financials, financial_fences
    from snapmart.schemas import FENCED_COLUMNS, FINANCIALS
    from tests.raw import financial_row

    named = [financial_row(i, JAN) | {FENCED_COLUMNS[0]: "NaN" if i % 4 == 0 else str(i)} for i in range(1, 41)]
    schema = FINANCIALS.bronze_schema
    bronze = spark.createDataFrame([tuple(row[field.name] for field in schema) for row in named], schema)
    q1, q3 = clean_financials(bronze).approxQuantile(FENCED_COLUMNS[0], [0.25, 0.75], 0.0)
    assert financial_fences(bronze).first()[f"{FENCED_COLUMNS[0]}_fence"] == q3 + 1.5 * (q3 - q1)


def test_fences_pooled_from_states(spark):
    rng = np.random.default_rng(2)
    by_month = {JAN: rng.lognormal(3, 1, 30_000), FEB: rng.lognormal(4, 1, 5_000), date(2023, 3, 1): [7.0] * 3}
    values = [(day, float(v)) for day, own in by_month.items() for v in own]
    values += [(JAN, float("nan"))] * 10_000 + [(FEB, None)] * 100
    df = spark.createDataFrame(values, f"{SNAPSHOT} date, x double").repartition(4)
    state = quantile_state(df, ["x"], [SNAPSHOT])
    assert state.count() == 3 and state.agg(F.max(F.size("points"))).first()[0] == 1001
    found = pooled_fences(state).first()
    pool = np.sort(np.concatenate([np.asarray(own) for own in by_month.values()]))
    for share, value in ((0.25, found.q1), (0.75, found.q3)):
        assert abs(np.searchsorted(pool, value, "right") / len(pool) - share) < 0.0015
    per_month = {r[SNAPSHOT]: r for r in pooled_fences(state, [SNAPSHOT]).collect()}
    assert per_month[date(2023, 3, 1)].upper_fence == 7.0
    assert pooled_fences(state.where("false")).count() == 0

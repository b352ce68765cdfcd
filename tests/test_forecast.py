"""Series building, band rules and the smoothing fit against a brute-force
numpy fit (hand-made series only)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.plans import forecast as fc


def _mart(spark, rows):
    from decimal import Decimal
    return spark.createDataFrame(
        [(dt.date.fromisoformat(d), Decimal(str(v))) for d, v in rows], "order_date date, net_sales decimal(38,9)")


def test_zero_filled_series(spark):
    m = _mart(spark, [("2026-01-01", 5), ("2026-01-02", 7), ("2026-01-04", 1)])
    got = [(str(r.date), r.daily_net_sales) for r in fc.daily_series(m).orderBy("date").collect()]
    assert got == [("2026-01-01", 5.0), ("2026-01-02", 7.0), ("2026-01-03", 0.0), ("2026-01-04", 1.0)]
    assert fc.daily_actuals(m).count() == 3
    assert [str(r.date) for r in fc.days_without_orders(m).collect()] == ["2026-01-03"]


def test_horizons_and_actual_rows(spark):
    days = [(str(dt.date(2026, 1, 1) + dt.timedelta(days=i)), 10 + (i % 7)) for i in range(60)]
    m = _mart(spark, days)
    counts = {(r.series_type, r.horizon): r.row_count for r in fc.row_counts(fc.sales_forecast_all(m)).collect()}
    assert counts == {("Actual", None): 60, ("Forecast", 7): 7, ("Forecast", 14): 14, ("Forecast", 30): 30}
    f30 = fc.sales_forecast(m).where("series_type = 'Forecast'")
    assert f30.count() == 30
    assert f30.agg(F.min("date")).first()[0] == dt.date(2026, 3, 2)


def test_floor_at_zero_keeps_null(spark):
    from basketry.functions.numeric import floor_at_zero
    df = spark.createDataFrame([(-5.0,), (None,), (3.0,)], "x double")
    assert [r[0] for r in df.select(floor_at_zero("x")).collect()] == [0.0, None, 3.0]


def np_fit(y, alphas):
    best = None
    for a in alphas:
        level, sse = y[0], 0.0
        for v in y[1:]:
            sse += (v - level) ** 2
            level = a * v + (1 - a) * level
        cand = (sse, a, level)
        best = cand if best is None or cand < best else best
    return best


def test_fit_matches_numpy(spark):
    rng = np.random.default_rng(7)
    n = 120
    start = dt.date(2025, 1, 1)
    week = np.array([5.0, -3.0, 0.0, 2.0, -1.0, 4.0, -7.0])
    level = 100 + np.cumsum(rng.normal(0, 1.0, n))
    vals = [level[i] + week[(start + dt.timedelta(days=i)).isoweekday() % 7] + rng.normal(0, 0.5)
            for i in range(n)]
    rows = [(str(start + dt.timedelta(days=i)), round(float(v), 2)) for i, v in enumerate(vals)]
    m = _mart(spark, rows)
    series = fc.daily_series(m).withColumn("k", F.lit("a"))
    model = fc.fit(series, ["k"]).first()
    # brute force: same weekday index and grid in numpy
    ys = np.array([v for _, v in rows])
    dows = np.array([(start + dt.timedelta(days=i)).isoweekday() % 7 for i in range(n)])
    idx = {d: ys[dows == d].mean() - ys.mean() for d in range(7)}
    des = ys - np.array([idx[d] for d in dows])
    sse, a, lvl = np_fit(des, fc.DEFAULT_ALPHAS)
    assert model.alpha == pytest.approx(a)
    assert model.level == pytest.approx(lvl, rel=1e-9)
    assert model.sse == pytest.approx(sse, rel=1e-9)
    assert model.n == n


def test_recovers_level_and_weekday_pattern(spark):
    start = dt.date(2025, 1, 6)
    week = [10.0, 0.0, -2.0, -2.0, -2.0, -2.0, -2.0]
    rows = [(str(start + dt.timedelta(days=i)), 50 + week[i % 7]) for i in range(70)]
    out = fc.sales_forecast(_mart(spark, rows), horizon=7).where("series_type = 'Forecast'").orderBy("date")
    got = [round(r.forecast_value, 6) for r in out.collect()]
    assert got == [50 + week[(70 + i) % 7] for i in range(7)]


def test_backtest_shape(spark):
    days = [(str(dt.date(2026, 1, 1) + dt.timedelta(days=i)), 10 + (i % 5)) for i in range(90)]
    bt = {r.holdout_days: r for r in fc.backtest(_mart(spark, days)).collect()}
    assert set(bt) == {7, 14, 30}
    assert bt[30].n == 30 and bt[7].n == 7
    assert bt[7].mae >= 0 and bt[7].rmse >= bt[7].mae


def test_keyed_forecast(spark):
    rows = [(dt.date(2026, 1, 1) + dt.timedelta(days=i), "A" if i % 2 else "B", 10.0 + i % 3)
            for i in range(40)]
    m = spark.createDataFrame(rows, "order_date date, seg string, net_sales double")
    out = fc.sales_forecast(m, ["seg"], horizon=5)
    assert out.where("series_type = 'Forecast'").groupBy("seg").count().count() == 2
    assert out.where("series_type = 'Forecast'").count() == 10


def test_null_key_is_a_series(spark):
    """Ten sales of 10.00 under a NULL key: their days, a model, a forecast."""
    rows = [(dt.date(2026, 1, 1) + dt.timedelta(days=2 * i), None, 10.0) for i in range(10)]
    m = spark.createDataFrame(rows, "order_date date, seg string, net_sales double")
    series = fc.daily_series(m, ["seg"])
    assert series.count() == 19 and series.agg(F.sum(fc.VALUE)).first()[0] == 100
    assert fc.fitted_models(m, ["seg"]).first().n == 19
    assert fc.sales_forecast(m, ["seg"], 5).where("series_type = 'Forecast' AND forecast_value IS NOT NULL").count() == 5
    assert fc.days_without_orders(m, ["seg"]).count() == 9


def test_short_series_keep_their_backtest_row(spark):
    rows = [(dt.date(2026, 1, 1) + dt.timedelta(days=i), "short", 10.0) for i in range(5)]
    rows += [(dt.date(2026, 1, 1) + dt.timedelta(days=i), "long", 10.0) for i in range(60)]
    m = spark.createDataFrame(rows, "order_date date, seg string, net_sales double")
    got = {(r.seg, r.holdout_days): (r.n, r.mae) for r in fc.backtest(m, ["seg"]).collect()}
    assert got == {("short", h): (0, None) for h in (7, 14, 30)} | {("long", h): (h, 0.0) for h in (7, 14, 30)}


def test_two_exchanges_and_no_join(spark):
    """For the total and for keyed series, forecasts and backtests."""
    m = _mart(spark, [(f"2026-01-{d:02d}", float(d)) for d in range(1, 21)])
    for df in (fc.sales_forecast_all(m), fc.sales_forecast(m, ["order_date"]), fc.backtest(m), fc.fitted_models(m, ["order_date"])):
        plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and df._jdf.queryExecution().executedPlan().toString().count("Exchange ") <= 2


def test_edges_of_series(spark):
    """No rows, only rows without a date, one day, a long gap."""
    none = _mart(spark, [("2026-01-01", 5.0)])
    assert fc.sales_forecast_all(none.limit(0)).count() == 0 and fc.backtest(none.limit(0)).count() == 0
    undated = none.withColumn("order_date", F.lit(None).cast("date"))
    assert [r.series_type for r in fc.sales_forecast(undated).collect()] == ["Actual"] and fc.backtest(undated).count() == 0
    one = fc.sales_forecast(none, horizon=7).where("series_type = 'Forecast'").collect()
    assert len(one) == 7 and {r.forecast_value for r in one} == {5.0} and {r.confidence_lower for r in one} == {None}
    assert [(r.n, r.mae, r.actual_sum) for r in fc.backtest(none).collect()] == [(0, None, None)] * 3
    gap = _mart(spark, [("2020-01-01", 5.0), ("2026-01-01", 7.0)])
    assert fc.fitted_models(gap).first().n == 2193 and fc.daily_series(gap).count() == 2193

"""Daily sales series and forecasts for many series at once.

Model (re-aimed from an in-warehouse seasonal ARIMA): additive day-of-week
index plus simple exponential smoothing of the de-seasonalised series, which
is the forecast function of ARIMA(0,1,1). The smoothing weight is chosen per
series from a grid by the least sum of squared one-step errors.

Scale: raw rows are reduced to one value per (series key, day) by a partial
aggregate first. A series is then one row with one sorted array whose length
is the number of calendar days in it (bounded by the calendar, not by the order
volume). Missing days, weekday index, smoothing, forecast and backtest are all
computed inside that array by JVM-side ``transform`` and ``aggregate``: two
exchanges, no join, all series in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.numeric import CENTS, floor_at_zero
from basketry.operators.spine import date_spine, join_on_keys, missing_days

# 95 % two-sided normal quantile and the forecast horizons.
Z95 = 1.959964
HORIZONS = (7, 14, 30)
# Smoothing-weight grid 0.01 .. 0.99 in steps of 0.01.
DEFAULT_ALPHAS = tuple(round(i / 100, 2) for i in range(1, 100))

VALUE = "daily_net_sales"
UNKNOWN = "Unknown"  # attribute of facts without a dimension row


def _cents(c):
    return F.round(c, 2).cast(CENTS)


def _day_sums(mart: DataFrame, keys, date_col: str, value_col: str) -> DataFrame:
    """The one aggregation over the order rows: exact sums per (key, day)."""
    return mart.groupBy(*keys, F.col(date_col).alias("date")).agg(F.sum(value_col).alias("__sum"))


def _series_from_sums(sums: DataFrame, keys) -> DataFrame:
    dated = sums.where(F.col("date").isNotNull())
    spine = date_spine(dated, "date", keys)
    filled = join_on_keys(spine, dated, keys, ["date"])
    return filled.select(*keys, "date", _cents(F.coalesce(F.col("__sum"), F.lit(0))).alias(VALUE))


def daily_series(mart: DataFrame, keys=(), date_col: str = "order_date", value_col: str = "net_sales") -> DataFrame:
    """Dense daily series per key, days without orders filled with 0. Values
    are exact cents (DECIMAL), so every later sum is order-independent."""
    keys = list(keys)
    return _series_from_sums(_day_sums(mart, keys, date_col, value_col), keys)


def daily_actuals(mart: DataFrame, keys=(), date_col: str = "order_date", value_col: str = "net_sales") -> DataFrame:
    """Only the days that have orders (no zero fill)."""
    keys = list(keys)
    return _day_sums(mart, keys, date_col, value_col).select(*keys, "date", _cents(F.col("__sum")).alias(VALUE))


def days_without_orders(mart: DataFrame, keys=(), date_col: str = "order_date") -> DataFrame:
    return missing_days(mart, date_col, keys).select(*keys, F.col(date_col).alias("date"))


def _let(value: str, name: str, body: str) -> str:
    """SQL of ``body`` in which ``name`` stands for ``value``, computed once
    however often a lambda inside ``body`` runs (a column that a lambda uses
    may be put in its place by the optimizer and be computed again each time)."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _arrays(mart: DataFrame, keys, date_col: str = "order_date", value_col: str = "net_sales") -> DataFrame:
    """One row per key: ``points`` (date, sum) of the days with orders, and
    ``days``, the dense series from the first to the last date in cents."""
    sums = _day_sums(mart, keys, date_col, value_col)
    if keys:  # the aggregate's own exchange, kept wide: series are small in bytes and dear to fit
        sums = sums.repartition(int(mart.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    rows = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("date", F.col("__sum").alias("sum")))).alias("points"))
    return _dense(rows.withColumn("__dated", F.expr("filter(points, p -> p.date IS NOT NULL)")), "round(p.sum, 2)")


def _dense(rows: DataFrame, value: str) -> DataFrame:
    """``days`` and ``first_date`` from ``__dated``, sorted (date, ...): the
    zeros between two of its dates are put before the second."""
    zero = "CAST(0 AS DECIMAL(38,2))"
    filled = _let("__dated", "d", (
        f"flatten(transform(d, (p, i) -> concat(array_repeat({zero}, CASE WHEN i = 0 THEN 0 ELSE "
        f"datediff(p.date, get(d, i - 1).date) - 1 END), array(coalesce(CAST({value} AS DECIMAL(38,2)), {zero})))))"))
    return rows.withColumns({"days": F.expr(filled), "first_date": F.expr("get(__dated, 0).date")}).drop("__dated")


def _alphas_sql(alphas) -> str:
    return "array(" + ", ".join(f"CAST({a!r} AS DOUBLE)" for a in alphas) + ")"


def _fitted(rows: DataFrame, alphas=DEFAULT_ALPHAS) -> DataFrame:
    """``rows`` (days, first_date) with n, dow (weekday of the first day, 0 is
    Sunday), dow_index (mean of each weekday minus the overall mean; NULL
    for a weekday that does not occur), last_date, alpha, level, sse, sigma.

    Weekday means come from exact decimal sums, converted to DOUBLE once.
    Levels: l_1 = y_1, l_t = a*y_t + (1-a)*l_{t-1}; one-step error
    e_t = y_t - l_{t-1}; sigma^2 = sse / (n - 1)."""
    rows = rows.withColumns({"n": F.size("days").cast("bigint"), "dow": F.dayofweek("first_date") - 1})
    total = lambda days: (f"CAST(aggregate({days}, CAST(0 AS DECIMAL(38,2)), "  # noqa: E731
                          "(acc, v) -> CAST(acc + v AS DECIMAL(38,2))) AS DOUBLE)")
    index = _let(f"CASE WHEN n > 0 THEN {total('days')} / n END", "mean", (
        "transform(transform(sequence(0, 6), w -> filter(days, (v, i) -> (dow + i) % 7 = w)), "
        f"own -> CASE WHEN size(own) > 0 THEN {total('own')} / size(own) - mean END)"))
    rows = rows.withColumn("dow_index", F.expr(index))
    ys = _let("dow_index", "x", "transform(days, (v, i) -> CAST(v AS DOUBLE) - get(x, (dow + i) % 7))")
    # One smoothing pass per weight; the finish function emits the (sse,
    # alpha, level) struct, so the pass is not repeated per field.
    one = (
        "aggregate(slice(ys, 2, size(ys)), "
        "named_struct('level', get(ys, 0), 'sse', CAST(0 AS DOUBLE)), "
        "(acc, y) -> named_struct('level', a * y + (1 - a) * acc.level, "
        "'sse', acc.sse + (y - acc.level) * (y - acc.level)), "
        "acc -> named_struct('sse', acc.sse, 'alpha', a, 'level', acc.level))"
    )
    best = _let(ys, "ys", f"CASE WHEN n > 0 THEN array_min(transform({_alphas_sql(alphas)}, a -> {one})) END")
    rows = rows.withColumn("__b", F.expr(best))
    return rows.withColumns({
        "last_date": F.expr("date_add(first_date, CAST(n AS INT) - 1)"),
        "alpha": F.col("__b.alpha"), "level": F.col("__b.level"), "sse": F.col("__b.sse"),
        "sigma": F.sqrt(F.col("__b.sse") / F.when(F.col("n") > 1, F.col("n") - 1))}).drop("__b")


MODEL = ["last_date", "n", "alpha", "level", "sse", "sigma"]


def fit(series: DataFrame, keys=(), alphas=DEFAULT_ALPHAS) -> DataFrame:
    """One row per key of a dense daily series: alpha, level, sse, sigma, n,
    last date."""
    keys = list(keys)
    rows = series.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("date", VALUE))).alias("__dated"))
    return _fitted(_dense(rows, f"p.{VALUE}"), alphas).where("n > 0").select(*keys, *MODEL)


def _with_forecast(rows: DataFrame, keys, horizons, alphas, with_horizon: bool) -> DataFrame:
    """The actual rows of every series and its forecast rows for each horizon:
    steps 1..horizon after the last day with a 95 % band whose half width grows
    as sigma * sqrt(1 + (h-1) alpha^2); the lower bound is floored at 0 (a NULL
    bound stays NULL). All rows of a series come out of its one row."""
    fitted = _fitted(rows, alphas)
    actual = "transform(points, p -> struct(p.date AS date, CAST(NULL AS INT) AS step, p.sum AS sum, CAST(NULL AS BIGINT) AS horizon))"
    ahead = ("flatten(transform(array({}), h -> transform(sequence(1, CAST(h AS INT)), s -> struct(date_add(last_date, s) AS date, s AS step, "
             "CAST(NULL AS {}) AS sum, h AS horizon))))").format(
        ", ".join(f"CAST({h} AS BIGINT)" for h in horizons), rows.schema["points"].dataType.elementType["sum"].dataType.simpleString())
    out = fitted.select(*keys, "n", "dow", "dow_index", "alpha", "level", "sigma", F.inline(F.expr(
        f"concat({actual}, CASE WHEN n > 0 THEN {ahead} ELSE array() END)")))
    value = F.col("level") + F.coalesce(F.expr("get(dow_index, CAST((dow + n - 1 + step) % 7 AS INT))"), F.lit(0.0))
    half = F.lit(Z95) * F.col("sigma") * F.sqrt(F.lit(1.0) + (F.col("step") - 1) * F.col("alpha") * F.col("alpha"))
    is_step = F.col("step").isNotNull()
    columns = [*keys, "date", F.when(~is_step, _cents(F.col("sum")).cast("double")).alias(VALUE),
               F.when(is_step, value).alias("forecast_value"), F.when(is_step, floor_at_zero(value - half)).alias("confidence_lower"),
               F.when(is_step, value + half).alias("confidence_upper"),
               F.when(is_step, "Forecast").otherwise("Actual").alias("series_type")]
    return out.select(*columns, *(["horizon"] if with_horizon else []))


def sales_forecast(mart: DataFrame, keys=(), horizon: int = 30, alphas=DEFAULT_ALPHAS) -> DataFrame:
    """Actual daily sales followed by ``horizon`` forecast days."""
    keys = list(keys)
    return _with_forecast(_arrays(mart, keys), keys, [horizon], alphas, False)


def sales_forecast_all(mart: DataFrame, keys=(), horizons=HORIZONS, alphas=DEFAULT_ALPHAS) -> DataFrame:
    """Actuals plus one block of forecast rows per horizon, from one fit."""
    keys = list(keys)
    return _with_forecast(_arrays(mart, keys), keys, horizons, alphas, True)


def horizon_view(forecast_all: DataFrame, horizon: int) -> DataFrame:
    """Actual rows plus the forecast rows of one chosen horizon."""
    t = F.col("series_type")
    return forecast_all.where((t == "Actual") | ((t == "Forecast") & (F.col("horizon") == horizon)))


def row_counts(forecast_all: DataFrame) -> DataFrame:
    return (forecast_all.groupBy("series_type", "horizon").agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy("series_type", "horizon"))


def latest_days(forecast: DataFrame, n: int = 5) -> DataFrame:
    return forecast.orderBy(F.col("date").desc()).limit(n)


def backtest(mart: DataFrame, keys=(), holdouts=HORIZONS, alphas=DEFAULT_ALPHAS) -> DataFrame:
    """Hold out the last h days of every series, fit on the rest, forecast h
    days and score against the zero-filled actual days of the hold-out. A
    series is one array, of which each hold-out fits a beginning and scores the
    end. ME is actual minus forecast (negative = over-forecast). A series
    without a day left to train on has its row as well, with n = 0 and NULL
    scores."""
    keys = list(keys)
    rows = _arrays(mart, keys).where(F.size("days") > 0).select(*keys, "first_date", F.col("days").alias("__all"), F.explode(
        F.array(*[F.lit(h).cast("bigint") for h in holdouts])).alias("holdout_days"))
    rows = rows.withColumn("days", F.expr("slice(__all, 1, greatest(size(__all) - CAST(holdout_days AS INT), 0))"))
    fitted = _fitted(rows, alphas)
    scored = fitted.withColumn("__test", F.expr("CASE WHEN n > 0 THEN " + _let(
        "struct(level, dow_index)", "m", "transform(slice(__all, CAST(n AS INT) + 1, CAST(holdout_days AS INT)), (v, j) -> struct("
        "CAST(v AS DOUBLE) AS a, m.level + coalesce(get(m.dow_index, CAST((dow + n + j) % 7 AS INT)), CAST(0 AS DOUBLE)) AS f))")
        + " ELSE array() END"))
    total = lambda x, keep="true": (f"aggregate(filter(__test, t -> {keep}), CAST(0 AS DOUBLE), (acc, t) -> acc + {x})")
    mean = lambda x, keep="true": F.expr(
        f"{total(x, keep)} / nullif(size(filter(__test, t -> {keep})), 0)")
    return scored.select(
        *keys, "holdout_days", F.size("__test").cast("bigint").alias("n"),
        mean("abs(t.a - t.f)").alias("mae"),
        F.sqrt(mean("(t.a - t.f) * (t.a - t.f)")).alias("rmse"),
        (mean("abs(t.a - t.f) / abs(t.a)", "t.a <> 0") * 100).alias("mape"),
        mean("(t.a - t.f)").alias("me"),
        F.when(F.size("__test") > 0, F.expr(total("t.a"))).alias("actual_sum"),
        F.when(F.size("__test") > 0, F.expr(total("t.f"))).alias("forecast_sum"))


def fitted_models(mart: DataFrame, keys=(), alphas=DEFAULT_ALPHAS) -> DataFrame:
    """The chosen parameters per series (one row per key)."""
    keys = list(keys)
    return _fitted(_arrays(mart, keys), alphas).where("n > 0").select(*keys, *MODEL)


def model_rows(mart: DataFrame, alphas=DEFAULT_ALPHAS) -> DataFrame:
    """The model of the total series in one row, with its weekday index: what
    forecasts of any horizon are made of."""
    return _fitted(_arrays(mart, []), alphas).where("n > 0").select(
        "last_date", "n", "dow", "dow_index", "alpha", "level", "sigma")


def register_table_function(spark, mart: DataFrame, name: str = "v_sales_forecast_h", alphas=DEFAULT_ALPHAS) -> None:
    """``SELECT * FROM v_sales_forecast_h(14)``: the actual days and as many
    forecast days as the argument says, as a SQL table function over two views
    (the days and the fitted model), which Catalyst inlines."""
    actual, model = f"{name}_actuals", f"{name}_model"
    daily_actuals(mart).createOrReplaceTempView(actual)
    model_rows(mart, alphas).createOrReplaceTempView(model)
    value = "level + coalesce(get(dow_index, CAST((dow + n - 1 + step) % 7 AS INT)), CAST(0 AS DOUBLE))"
    half = f"CAST({Z95!r} AS DOUBLE) * sigma * sqrt(CAST(1 AS DOUBLE) + (step - 1) * alpha * alpha)"
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(days INT) RETURNS TABLE (date DATE, {VALUE} DOUBLE, forecast_value DOUBLE,
            confidence_lower DOUBLE, confidence_upper DOUBLE, series_type STRING)
        RETURN SELECT date, CAST({VALUE} AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), 'Actual' FROM {actual}
        UNION ALL SELECT date_add(last_date, step), CAST(NULL AS DOUBLE), value,
            CASE WHEN value - half < 0 THEN CAST(0 AS DOUBLE) ELSE value - half END, value + half, 'Forecast'
        FROM (SELECT last_date, step, {value} AS value, {half} AS half
              FROM (SELECT *, explode(sequence(1, {name}.days)) AS step FROM {model} WHERE {name}.days > 0))""")


def with_dimension(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, attr: str,
                   name: str) -> DataFrame:
    """Attach one attribute of a dimension table (e.g. a customer's market
    segment, a product's brand) as a series key. Facts whose key is NULL or
    not in the dimension stay, as ``UNKNOWN``. A left equi-join on the
    dimension's primary key: the dimension side is shuffled or, when AQE
    measures it small, broadcast; a hot key on the fact side is split by the
    skew-join handling."""
    d = dim.select(F.col(dim_key).alias("__dk"), F.col(attr).alias(name))
    return (facts.join(d, F.col(fact_key) == F.col("__dk"), "left").drop("__dk")
            .withColumn(name, F.coalesce(name, F.lit(UNKNOWN))))

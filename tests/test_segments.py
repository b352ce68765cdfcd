import pytest
from pyspark.sql import functions as F

from basketry.config import REFERENCE_CONFIG, Config
from basketry.functions.segments import order_segment, register_sql_functions


def _seg(spark, values, cfg):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    return [r[0] for r in df.select(order_segment("n", cfg)).collect()]


def test_segment_bands(spark):
    assert _seg(spark, [0, 1, 3, 4, 10, None], REFERENCE_CONFIG) == [
        "New", "Returning", "Returning", "VIP", "VIP", "Unknown"]


def test_gap_between_bands_is_unknown(spark):
    cfg = REFERENCE_CONFIG.with_(vip_min_prior_orders=6)
    assert _seg(spark, [4, 5, 6], cfg) == ["Unknown", "Unknown", "VIP"]


def test_sql_function_matches_column_rule(spark):
    register_sql_functions(spark, REFERENCE_CONFIG)
    df = spark.createDataFrame([(v,) for v in [None, 0, 1, 2, 3, 4, 7]], "n bigint")
    out = df.select(F.expr("order_segment(n)").alias("a"), order_segment("n", REFERENCE_CONFIG).alias("b"))
    assert all(r.a == r.b for r in out.collect())


def test_config_validation():
    with pytest.raises(ValueError):
        Config(returning_min_prior_orders=5).validate()


def test_complete_history_start():
    import datetime as dt
    assert REFERENCE_CONFIG.complete_history_from == dt.date(2026, 7, 9)
    assert Config(dataset_start_date=dt.date(2024, 2, 29), segmentation_lookback_months=12).complete_history_from \
        == dt.date(2025, 2, 28)

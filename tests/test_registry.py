"""Caching, skew and errors on the registered path."""

import shutil

import pytest
from pyspark.sql import functions as F

from basketry import registry
from conftest import SF_SMALL


@pytest.fixture
def folder(spark, tmp_path):
    for t in ("orders", "lineitem", "customer", "part"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    return str(tmp_path)


def _rewrite(df, path):
    df.write.parquet(path + ".new")
    shutil.rmtree(path)
    shutil.move(path + ".new", path)


def test_a_rewritten_folder_gives_new_numbers(spark, folder):
    assert registry.QUERIES["kpi_tiles"](spark, folder).first().orders == 1500
    assert registry.QUERIES["mart_orders"](spark, folder).count() == 1500
    _rewrite(spark.read.parquet(f"{folder}/orders.parquet").orderBy("o_orderkey").limit(100), f"{folder}/orders.parquet")
    assert registry.QUERIES["kpi_tiles"](spark, folder).first().orders == 100
    assert registry.QUERIES["mart_orders"](spark, folder).count() == 100


def test_a_failing_build_is_an_error(spark, folder, monkeypatch):
    from basketry.plans.marts import Marts

    def broken(self, *args, **kw):
        raise OSError("disk full")
    monkeypatch.setattr(Marts, "materialize", broken)
    with pytest.raises(OSError, match="disk full"):
        registry.QUERIES["kpi_tiles"](spark, folder)


def test_facts_without_a_dimension_row_stay(spark, folder):
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    _rewrite(customers.orderBy("c_custkey").limit(1), f"{folder}/customer.parquet")
    out = registry.QUERIES["sales_forecast_by_market_segment"](spark, folder).where("series_type = 'Actual'")
    total = spark.read.parquet(f"{folder}/orders.parquet").agg(F.sum("o_totalprice")).first()[0]
    assert abs(out.agg(F.sum("daily_net_sales")).first()[0] - total) < 1
    assert out.where("market_segment = 'Unknown'").count() > 100


def test_a_hot_order_is_split_in_the_registered_query(spark, folder):
    """An order with a third of all lines, the caller's session settings."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    hot = lines.agg(F.min("l_orderkey")).first()[0]
    lines = lines.withColumn("l_orderkey", F.when(F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0, hot)
                             .otherwise(F.col("l_orderkey")))
    count = lines.count()
    _rewrite(lines.repartition(8), f"{folder}/lineitem.parquet")
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2048", "spark.sql.files.maxPartitionBytes": "32k",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = registry.QUERIES["stg_sales"](spark, folder)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == count and sum(r.order_id == hot for r in rows) > len(rows) // 4
    assert "skewed" in plan

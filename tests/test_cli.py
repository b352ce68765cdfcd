"""End-to-end through the command line: load raw files, build, check,
forecast (smallest test tables)."""

import os
import tempfile

from basketry import cli
from basketry.config import DRIVER_CONFIG as CFG
from basketry.session import shared_table_root
from basketry.sources.tpch import raw_orders_from_tables, raw_sales_from_tables
from conftest import SF_SMALL


def _folders(root):
    path = root.removeprefix("file:")
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_load_build_check_forecast(spark, capsys):
    d = tempfile.mkdtemp(prefix="basketry-cli-")
    raw_orders_from_tables(spark, SF_SMALL).write.option("header", "true").csv(f"{d}/in_orders")
    raw_sales_from_tables(spark, SF_SMALL).write.option("header", "true").csv(f"{d}/in_sales")
    assert cli.main(["load", "--orders", f"{d}/in_orders", "--sales", f"{d}/in_sales",
                     "--dest", f"{d}/raw", "--format", "csv"]) == 0
    out = capsys.readouterr().out
    assert '"rows": 1500' in out
    assert cli.main(["build", "--raw", f"{d}/raw", "--config", "driver", "--dest", f"{d}/marts", "--no-size"]) == 0
    assert os.path.isdir(f"{d}/marts/mart_orders")
    assert '"mart_orders": 1500' in capsys.readouterr().out
    assert spark.read.parquet(f"{d}/marts/mart_orders").count() == 1500
    # the generated data has orders without lines and repeated lines -> errors
    # from here on the published tables are read, and nothing is built
    source = ["--marts", f"{d}/marts", "--no-size"]
    root = shared_table_root(spark)
    before = _folders(root)
    assert cli.main(["check", "--raw", f"{d}/raw", "--config", "driver", *source]) == 1
    assert "64 checks" in capsys.readouterr().out
    assert cli.main(["forecast", "--tables", SF_SMALL, "--dest", f"{d}/fc", *source]) == 0
    assert '"holdout_days": 30' in capsys.readouterr().out
    assert cli.main(["insights", "--tables", SF_SMALL, *source]) == 0
    out = capsys.readouterr().out
    assert "--- segments" in out and '"nb_orders"' in out
    assert cli.main(["explore", "--tables", SF_SMALL, "--dims", "order_id", "--measures", "total_net_sales",
                     "--dest", f"{d}/by_order", "--show", "3", *source]) == 0
    assert capsys.readouterr().out.count("total_net_sales") == 4   # the title and three rows
    assert spark.read.parquet(f"{d}/by_order").count() == 1500
    assert cli.main(["explore", "--tables", SF_SMALL, "--dims", "order_date_year", "--measures", "order_count",
                     "--profile", "VIP", "--date-from", str(CFG.year_start), "--date-to", str(CFG.year_end),
                     "--complete-only", *source]) == 0
    assert f'"order_date_year": {CFG.report_year}' in capsys.readouterr().out
    assert _folders(root) == before
    assert spark.read.parquet(f"{d}/fc/v_sales_forecast_all").where("series_type = 'Forecast'").count() == 51


def test_register_views(spark):
    from basketry.config import DRIVER_CONFIG
    from basketry.plans.marts import Marts
    from basketry.views import register_views
    names = register_views(spark, Marts.from_tables(spark, SF_SMALL, DRIVER_CONFIG))
    assert "v_sales_forecast_all" in names
    n = spark.sql("SELECT count(*) FROM mart_orders WHERE order_segment(prior_orders_last_12_months) "
                  "<> order_segmentation").first()[0]
    assert n == 0
    assert spark.sql("SELECT count(*) FROM v_sales_forecast WHERE series_type = 'Forecast'").first()[0] == 30


def test_vars_override():
    from basketry.cli import _parse_vars
    import datetime as dt
    v = _parse_vars('{"vip_min_prior_orders": 5, "dataset_start_date": "2024-01-01"}')
    assert v == {"vip_min_prior_orders": 5, "dataset_start_date": dt.date(2024, 1, 1)}


def test_explore_builds_without_marts(capsys):
    assert cli.main(["explore", "--tables", SF_SMALL, "--dims", "order_date_at_selected_grain", "--no-size",
                     "--measures", "order_count,total_net_sales", "--grain", "quarter", "--segment", "VIP"]) == 0
    out = capsys.readouterr().out
    assert '"order_count"' in out and "-01-01" in out


def test_publish_drill_and_namespaces(spark, capsys, tmp_path):
    import json
    d, source = str(tmp_path), ["--tables", SF_SMALL, "--no-size"]
    raw_orders_from_tables(spark, SF_SMALL).write.parquet(f"{d}/in_orders")
    raw_sales_from_tables(spark, SF_SMALL).write.parquet(f"{d}/in_sales")
    assert cli.main(["load", "--orders", f"{d}/in_orders", "--sales", f"{d}/in_sales", "--dest", f"{d}/raw", "--namespace", "cli_raw"]) == 0
    assert spark.table("cli_raw.raw_orders").count() == 1500 and spark.table("cli_raw.raw_sales").count() == 6000
    spark.sql("DROP SCHEMA cli_raw CASCADE")
    # orders without lines fail a check of severity error: held back with the gate, published without
    assert cli.main(["build", *source, "--publish", f"{d}/shop", "--gate", "error"]) == 1
    assert "positive_product_qty" in capsys.readouterr().out
    assert cli.main(["build", *source, "--publish", f"{d}/shop"]) == 0
    capsys.readouterr()
    assert cli.main(["builds", "--publish", f"{d}/shop"]) == 0
    found = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert [(b["manifest"] is not None, b["current"]) for b in found].count((True, True)) == 1 and len(found) == 2
    assert cli.main(["builds", "--publish", f"{d}/shop", "--drop", "--unpublished"]) == 0
    assert len(capsys.readouterr().out.splitlines()) == 2
    marts = ["--marts", f"{d}/shop", *source]
    assert cli.main(["check", *marts]) == 1 and "64 checks" in capsys.readouterr().out
    assert cli.main(["explore", *marts, "--metric", "aov", "--segment", "VIP", "--dims", "order_date_year"]) == 0
    assert '"average_order_value"' in capsys.readouterr().out
    product = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy("l_partkey").count().orderBy("l_partkey").first()
    assert cli.main(["drill", *marts, "--view", "order_lines", "--product-id", str(product[0]), "--dest", f"{d}/rows"]) == 0
    assert spark.read.parquet(f"{d}/rows").count() == product[1]
    assert f'"product_id": {product[0]}' in capsys.readouterr().out
    best = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy("l_orderkey").count().orderBy("l_orderkey").take(2)
    ids = [x for r in best for x in ("--order-id", str(r[0]))]
    assert cli.main(["drill", *marts, "--view", "order_lines", *ids, "--dest", f"{d}/orders"]) == 0
    assert spark.read.parquet(f"{d}/orders").count() == sum(r[1] for r in best)
    capsys.readouterr()
    assert cli.main(["drill", *marts, "--segment", "New", "--date-from", str(CFG.year_start), "--date-to", str(CFG.year_end), "--show", "2"]) == 0
    assert capsys.readouterr().out.count('"order_segmentation": "New"') == 2

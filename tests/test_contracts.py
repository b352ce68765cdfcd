"""Contracts: what is accepted, what is quarantined and why."""

import json

import pytest

from basketry import cli
from basketry.sources import contracts as ct
from basketry.sources.readers import MissingColumnsError, load_orders

ORDERS = ct.CONTRACTS["raw_orders"]
ROWS = [("1998-01-02 00:00:00", "7", "1", "5.5"), ("1998-01-02 00:00:00", "7", "2", None), ("1998-01-02 00:00:00", None, "3", "1"),
        ("no date", "7", "4", "x"), ("1998-01-02 00:00:00", "8", "5", "1"), ("1998-01-03 00:00:00", "9", "5", "2"),
        ("1998-01-02 00:00:00", "7", None, "1"), ("1998-01-02 00:00:00", "7", None, "1"), (None, None, None, None)]


def test_rows_land_with_their_reasons(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "date_date string, customers_id string, orders_id string, net_sales string")
    assert ct.write(df, ORDERS, str(tmp_path)) == {"rows": 9, "accepted": 2, "quarantined": 7}
    good = ct.read(spark, ORDERS, str(tmp_path))
    assert good.schema == ORDERS.schema and sorted(r.orders_id for r in good.collect()) == [1, 2]
    bad = ct.quarantine(spark, ORDERS, str(tmp_path)).collect()
    why = sorted((json.loads(r.original)["orders_id"] or "", r.reasons) for r in bad)
    assert why == sorted([("3", ["customers_id: missing"]), ("4", ["date_date: not timestamp_ntz", "net_sales: not double"]),
                          ("5", ["orders_id: not unique"]), ("5", ["orders_id: not unique"]), ("", ["orders_id: missing"]),
                          ("", ["orders_id: missing"]), ("", ["customers_id: missing", "date_date: missing", "orders_id: missing"])])
    assert load_orders(spark, f"{tmp_path}/raw_orders").count() == 2       # the next step reads accepted rows only
    again = ct.write(df.limit(2), ORDERS, str(tmp_path))                   # truncate and write
    assert again["quarantined"] == 0 and ct.quarantine(spark, ORDERS, str(tmp_path)).count() == 0


def test_empty_and_missing_columns(spark, tmp_path):
    empty = spark.createDataFrame([], "date_date string, customers_id string, orders_id string, net_sales string")
    assert ct.write(empty, ORDERS, str(tmp_path)) == {"rows": 0, "accepted": 0, "quarantined": 0}
    assert ct.read(spark, ORDERS, str(tmp_path)).count() == 0
    with pytest.raises(MissingColumnsError):
        ct.write(empty.drop("net_sales"), ORDERS, str(tmp_path))


def test_load_enforces(spark, tmp_path, capsys):
    df = spark.createDataFrame(ROWS, "date_date string, customers_id string, orders_id string, net_sales string")
    df.write.option("header", "true").csv(f"{tmp_path}/o")
    spark.createDataFrame([("1998-01-02 00:00:00", "7", "1", "3", "5.5", "1"), ("1998-01-02 00:00:00", "7", "1", "3", "5.5", "many")],
                          "date_date string, customer_id string, order_id string, products_id string, net_sales string, qty string"
                          ).write.option("header", "true").csv(f"{tmp_path}/s")
    assert cli.main(["load", "--orders", f"{tmp_path}/o", "--sales", f"{tmp_path}/s", "--dest", f"{tmp_path}/raw", "--format", "csv", "--enforce"]) == 0
    said = json.loads(capsys.readouterr().out)
    assert said["raw_orders"]["accepted"] == 2 and said["raw_sales"] == {"rows": 2, "accepted": 1, "quarantined": 1}

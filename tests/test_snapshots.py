"""Publishing builds: one write, whole or not at all."""

import os

import pytest

from basketry.config import DRIVER_CONFIG as CFG
from basketry.operators.checks import BuildHeld
from basketry.plans import quality as dq
from basketry.plans.marts import Marts
from basketry.sources import sinks, snapshots
from conftest import SF_SMALL
from helpers import raw_orders, raw_sales


def small(spark, n=3):
    orders = [(i, i % 2, "2025-08-01", 10.0) for i in range(n)]
    return Marts(raw_orders(spark, orders), raw_sales(spark, [(i, i % 2, 5, "2025-08-01", 10.0, 1) for i in range(n)]), CFG)


def test_readers_stay_on_one_build(spark, tmp_path):
    dest = f"{tmp_path}/shop"
    assert snapshots.current(spark, dest) is None
    small(spark, 3).publish(spark, dest)
    reader = small(spark).published(spark, dest)
    assert reader.mart_orders.count() == 3 and reader.row_counts["mart_orders"] == 3
    small(spark, 5).publish(spark, dest)            # while the first reader goes on
    assert reader.mart_orders.count() == 3 and reader.mart_order_lines.count() == 3
    late = small(spark).published(spark, dest)
    assert late.mart_orders.count() == 5 and late.mart_product_summary.first()["orders_containing_product"] == 5
    assert [b["current"] for b in snapshots.builds(spark, dest)] == [False, True]
    assert len(snapshots.drop_builds(spark, dest, keep=1)) == 1
    assert late.mart_orders.count() == 5 and small(spark).published(spark, dest).mart_orders.count() == 5
    with pytest.raises(ValueError):
        snapshots.drop_builds(spark, dest, keep=0)


def test_a_build_that_fails_halfway_is_not_seen(spark, tmp_path, monkeypatch):
    dest = f"{tmp_path}/shop"
    small(spark, 3).publish(spark, dest)
    whole = sinks.materialize

    def breaks(spark, df, name, *args, **kw):
        if name == "mart_order_lines":
            raise OSError("disk full")
        return whole(spark, df, name, *args, **kw)
    monkeypatch.setattr(sinks, "materialize", breaks)
    with pytest.raises(OSError):
        small(spark, 9).publish(spark, dest)
    monkeypatch.setattr(sinks, "materialize", whole)
    seen = small(spark).published(spark, dest)
    assert seen.mart_orders.count() == 3 and seen.mart_product_summary.count() == 1
    left = [b for b in snapshots.builds(spark, dest) if not b["manifest"]]
    assert len(left) == 1 and snapshots.drop_builds(spark, dest, unpublished=True) == [left[0]["build"]]
    assert len(os.listdir(f"{dest}/builds")) == 1


def test_a_manifest_appears_whole_and_is_never_replaced(spark, tmp_path):
    folder = snapshots.Folder(spark, str(tmp_path))
    folder.write("a.json", "first")
    with pytest.raises(FileExistsError):
        folder.write("a.json", "second")
    assert folder.read("a.json") == "first" and [n for n in folder.names() if not n.startswith(".")] == ["a.json"]


def test_severity_decides_whether_a_build_is_published(spark, tmp_path):
    dest = f"{tmp_path}/shop"
    good = small(spark, 4).publish(spark, dest, gate="error")
    assert not dq.failing_row_checks(good.checks)
    bad = Marts(raw_orders(spark, [(1, 1, "2025-08-01", 10.0), (2, None, "2025-08-01", 3.0)]),
                raw_sales(spark, [(1, 1, 5, "2025-08-01", 10.0, 1)]), CFG)
    with pytest.raises(BuildHeld) as held:
        bad.publish(spark, dest, gate="error")
    assert held.value.failing["null:raw_orders/customers_id"] == 1 and held.value.failing["positive_product_qty"] == 1
    assert small(spark).published(spark, dest).mart_orders.count() == 4
    assert spark.read.parquet(f"{held.value.root}/mart_orders").count() == 2     # there for inspection
    assert bad.publish(spark, dest).mart_orders.count() == 2                     # no gate: published with its results
    assert small(spark).published(spark, dest).checks["null:mart_orders/customer_id"] == 1


@pytest.mark.parametrize("faulty", [False, True])
def test_stored_results_equal_checks_over_the_models(spark, tmp_path, faulty):
    """The 64 rows from the results of a build and from scans of the lazy
    models, on sound data and on data with every kind of fault."""
    m = Marts.from_tables(spark, SF_SMALL, CFG)
    if faulty:
        orders = [(1, 1, "1998-08-01", 10.0), (1, 1, "1998-08-01", 10.0), (2, None, "1998-02-01", 3.0), (None, 3, "1998-03-01", 1.0),
                  (None, 3, "1998-03-01", 1.0), (4, 4, None, None), (5, 5, "1997-01-01", 0.0), (6, 6, "1998-05-05", -1.0)]
        sales = [(1, 1, 5, "1998-08-01", 10.0, 1), (1, 1, 5, "1998-08-01", 2.0, None), (9, 1, None, "1998-08-01", 2.0, 0),
                 (None, 1, 7, "1998-08-01", 2.0, 3), (2, 2, 8, "1998-02-01", 3.0, -4)]
        m = Marts(raw_orders(spark, orders), raw_sales(spark, sales), CFG)
    stored = m.materialize(spark, f"{tmp_path}/b")
    assert stored.checks
    rows = sorted(map(tuple, dq.check_summary(stored).collect()))
    assert len(rows) == 64 and rows == sorted(map(tuple, dq.check_summary(m).collect()))
    assert any(n for _, s, n in rows if s == "error")


def test_stored_checks_need_five_scans(spark, tmp_path):
    m = Marts.from_tables(spark, SF_SMALL, CFG).materialize(spark, f"{tmp_path}/b")
    plan = dq.check_summary(m)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 5

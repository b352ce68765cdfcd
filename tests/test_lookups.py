"""Point look-ups by Bloom filters, and repeated ids by words of ids."""

import pytest
from pyspark.sql import functions as F

from basketry.config import DRIVER_CONFIG as CFG
from basketry.operators.checks import unique, unique_ids
from basketry.plans.faults import doubled_headers
from basketry.plans.marts import MAX_LOOKUP, Marts
from basketry.sources.sinks import read_table, write_table
from conftest import SF_SMALL


def executed(df):
    rows = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    nodes, todo = [], [plan]
    while todo:
        node = todo.pop()
        nodes.append(node)
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows, nodes


def rows_scanned(df):
    """(result rows, rows that the scan gave after skipping row groups)"""
    rows, nodes = executed(df)
    return len(rows), sum(n.metrics().apply("numOutputRows").value() for n in nodes if n.metrics().contains("numFiles"))


def test_a_row_group_without_the_id_is_not_read(spark, tmp_path):
    """Random ids: every row group spans the whole range, so statistics skip
    none of the 16 files; their Bloom filters skip all but the id's own."""
    ids = spark.range(200_000, numPartitions=16).select(F.abs(F.xxhash64("id")).alias("order_id"), F.rand(3).alias("x"))
    write_table(ids, f"{tmp_path}/with", lookup=["order_id"])
    write_table(ids, f"{tmp_path}/without")
    wanted = spark.read.parquet(f"{tmp_path}/with").orderBy("x").first()["order_id"]
    scanned = {}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for name in ("with", "without"):
        table = read_table(spark, f"{tmp_path}/{name}")
        found, scanned[name] = rows_scanned(Marts.among(table, [wanted]))
        assert found == 1
        absent, none = rows_scanned(Marts.among(table, [-5, -6]))
        assert absent == 0 and none == 0  # below every minimum
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == old
    assert scanned["with"] <= 3 * 200_000 / 16 < scanned["without"]


def test_marts_are_looked_up_by_order(spark):
    m = Marts.from_tables(spark, SF_SMALL, CFG).materialize(spark, rows_per_zone=20)
    ids = [r[0] for r in m.mart_orders.orderBy("order_id").select("order_id").take(3)]
    for table in ("mart_orders", "mart_order_lines"):
        want = getattr(m, table).where(F.col("order_id").isin(ids))
        found, scanned = rows_scanned(m.lookup(table, ids))
        assert found == want.count() > 0
        assert scanned < getattr(m, table).count() / 4
    assert m.lookup("mart_orders", ids[0]).count() == 1 and m.lookup("mart_orders", []).count() == 0
    with pytest.raises(ValueError, match="at most"):
        m.lookup("mart_orders", range(MAX_LOOKUP + 1))


@pytest.fixture(scope="module")
def headers(spark):
    return Marts.from_tables(spark, SF_SMALL, CFG).stg_orders


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_repeated_ids_equal_the_plain_check(spark, headers):
    cases = {"sound": headers, "some": doubled_headers(headers), "all": headers.unionByName(headers), "none": headers.limit(0),
             "odd": spark.createDataFrame([(i,) for i in (-1, -1, -64, -64, -65, 0, 63, 64, 64, 64, None, None, 2**63 - 1, -2**63)],
                                          "order_id long")}
    for name, df in cases.items():
        want = _rows(unique(df, "order_id"))
        assert _rows(unique_ids(df, "order_id")) == want, name
        assert _rows(unique_ids(df, "order_id", limit=0)) == want, name  # every word is counted
    assert _rows(unique_ids(cases["some"], "order_id")) and not _rows(unique_ids(headers, "order_id"))
    small = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "a int, b int")
    assert _rows(unique_ids(small, "b")) == [(5, 2)]


def test_a_hot_id_is_one_row_a_task(spark):
    ids = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("order_id"))
    assert _rows(unique_ids(ids, "order_id")) == [(7, 10_001)]


def test_only_candidates_are_shuffled_by_id(spark):
    """One repeated id among 100,000: the 64 ids of its word and the copy
    travel, no others."""
    ids = spark.range(100_000, numPartitions=4).select(F.col("id").alias("order_id"))
    ids = ids.unionByName(spark.createDataFrame([(70_000,)], "order_id long"))
    rows, nodes = executed(unique_ids(ids, "order_id"))
    assert list(map(tuple, rows)) == [(70_000, 2)]
    sent = [n.metrics().apply("shuffleRecordsWritten").value() for n in nodes
            if n.nodeName() == "Exchange" and n.metrics().contains("shuffleRecordsWritten")]
    assert sent and sum(sent) <= 65

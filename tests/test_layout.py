"""Year folders and curve zones: what a slice reads, what a build runs."""

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from basketry.config import DRIVER_CONFIG as CFG
from basketry.plans import reports as rp
from basketry.plans.marts import Marts
from basketry.sources.layout import Layout
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def built(spark):
    """Zones of few rows, so that small tables have many."""
    return Marts.from_tables(spark, SF_SMALL, CFG).materialize(spark, rows_per_zone=20)


def files_read(df) -> int:
    """Files that the scans of the executed plan listed."""
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()  # noqa: F841 - runs the plan whose metrics are read
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def on_disk(built, table, pattern="**"):
    return len(glob.glob(f"{built.root.removeprefix('file:')}/{table}/{pattern}/*.parquet", recursive=True))


def test_a_year_report_lists_the_files_of_its_year(built):
    year = on_disk(built, "mart_orders", f"order_year={CFG.report_year}/*")
    assert 0 < year < on_disk(built, "mart_orders") / 4
    for report in (rp.orders_per_month(built.mart_orders, CFG), rp.monthly_pattern(built.mart_orders, CFG), built.exercise_6):
        assert files_read(report) == year


@pytest.mark.parametrize("table, key", [
    ("mart_order_lines", "product_id"), ("mart_order_lines", "customer_id"), ("mart_orders", "customer_id"),
    ("mart_orders", "order_segmentation")])
def test_a_slice_on_any_key_skips_files(spark, built, table, key):
    whole = getattr(built, table)
    values = [r[0] for r in whole.select(key).distinct().orderBy(key).collect()]
    low, high = values[len(values) // 3], values[len(values) // 3 + len(values) // 50]
    sliced = built.slice(spark, table, **{key: (low, high)})
    assert sliced.columns == whole.columns
    assert sorted(map(str, sliced.collect())) == sorted(map(str, whole.where(F.col(key).between(low, high)).collect()))
    assert files_read(sliced) < 0.7 * on_disk(built, table)
    one = built.slice(spark, table, **{key: values[0]})
    assert one.count() == whole.where(F.col(key) == values[0]).count() > 0


def test_zones_against_every_row(spark):
    layout = Layout((("a", tuple(range(10, 200, 3))), ("b", ("k", "p", "t"))), 5)
    rows = [(i, c, 2000) for i in range(0, 220, 7) for c in "akmptz"] + [(None, "m", 2000), (5, None, None)]
    placed = layout.placed(spark.createDataFrame(rows, "a int, b string, order_year long")).collect()
    assert len({r["zone"] for r in placed}) > 8
    for r in placed:
        for wanted in ({"a": r["a"]}, {"b": r["b"]}, {"a": r["a"], "b": r["b"]}):
            if None not in wanted.values():
                assert r["zone"] in layout.zones(**wanted)
        if r["a"] is not None:
            assert r["zone"] in layout.zones(a=(r["a"] - 9, r["a"] + 2))
    assert len(layout.zones(a=15)) < 32 and len(layout.zones(b="m")) < 32
    assert Layout.from_json(json.dumps(layout.to_json())) == layout
    with pytest.raises(KeyError):
        layout.slice(c=1)


def test_null_years_and_keys_are_written_and_read(spark, tmp_path):
    from basketry.sources.sinks import read_table, write_table
    df = spark.createDataFrame([(1, None, 2000), (None, "x", None), (3, "y", 1999)], "a int, b string, order_year long")
    write_table(df, f"{tmp_path}/t", layout=Layout((("a", (2,)), ("b", ("x",))), 2))
    assert sorted(map(str, read_table(spark, f"{tmp_path}/t", schema=df.schema).collect())) == sorted(map(str, df.collect()))
    assert read_table(spark, f"{tmp_path}/t").columns == ["a", "b", "order_year"]


def test_a_hot_key_is_split_over_files(spark, tmp_path):
    from basketry.sources.sinks import write_table
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"),
                                    F.xxhash64("id").alias("b"), F.lit(2000).cast("long").alias("order_year"))
    layout = Layout.of({"a": list(range(0, 60_000, 1000)), "b": []}, 0, 1)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        write_table(df, f"{tmp_path}/t", layout=layout)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    per_file = spark.read.parquet(f"{tmp_path}/t").groupBy(F.input_file_name().alias("f")).agg(
        F.count_if(F.col("a") == 7).alias("hot")).collect()
    assert sum(r["hot"] for r in per_file) == 20_001 and max(r["hot"] for r in per_file) < 10_000


BUILD = """
import sys
sys.path.insert(0, {repo!r})
from basketry.session import get_session
from basketry.config import DRIVER_CONFIG
from basketry.plans.marts import Marts
spark = get_session("local[4]", 4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}})
spark.sparkContext.setLogLevel("OFF")
m = Marts.from_tables(spark, {data!r}, DRIVER_CONFIG).materialize(spark)
print("ROWS", m.row_counts["mart_orders"], m.row_counts["mart_order_lines"])
spark.stop()
"""


def test_the_last_joins_run_once(tmp_path):
    """From the event log: rows that come out of the joins on the order id."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = BUILD.format(repo=repo, log=tmp_path, data=SF_SMALL)
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300).stdout
    orders, lines = map(int, said.split("ROWS")[1].split()[:2])
    names, made = {}, {}

    def walk(node):
        for m in node["metrics"]:
            if "Join" in node["nodeName"] and m["name"] == "number of output rows":
                names[m["accumulatorId"]] = node["simpleString"]
        for child in node["children"]:
            walk(child)

    for path in glob.glob(f"{tmp_path}/*"):
        for line in open(path):
            event = json.loads(line)
            if "sparkPlanInfo" in event:
                walk(event["sparkPlanInfo"])
            for a in event.get("Task Info", {}).get("Accumulables", []) if event["Event"].endswith("TaskEnd") else []:
                if a["ID"] in names:
                    made[a["ID"]] = made.get(a["ID"], 0) + int(a["Update"])
    by = lambda word: sum(n for k, n in made.items() if word in names[k])
    # the order mart: history with the per-order sums; the line mart: lines with attributes
    assert by("LeftOuter") + by("Inner") > 0
    inner = [n for k, n in made.items() if "__oid" in names[k]]
    assert sum(inner) == lines
    outer = [n for k, n in made.items() if "LeftOuter" in names[k] and "order_id" in names[k] and n == orders]
    assert len(outer) == 1

"""Headers and lines bucketed by order id: what is done per order needs no
exchange.

Both tables are written with one number of buckets, hashed and sorted on the
order id, one file a bucket, so a join or a grouping on the id (alone or with
further keys) takes the buckets as they are. The rows are dealt once, when the
tables are written; every join, check and per-order sum afterwards is local.

A bucket cannot be split at runtime, as nothing is shuffled. Rows of hot order
ids, and those without an id, are kept apart therefore: in plain folders, whose
joins are ordinary ones that Spark splits by size. Both parts hold whole orders,
so anything that works order by order is the union of its results on the parts
(:meth:`OrderBuckets.apply`).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows of a bucket, about; an id with more of them is hot.
ROWS_PER_BUCKET = 4_000_000
#: Ids that the search for hot ones keeps count of: one with over 4 / TRACKED
#: of all rows is always found.
TRACKED = 100_000


@dataclass(frozen=True)
class OrderBuckets:
    """``orders`` and ``lines``: the bucketed parts; ``hot_orders`` and
    ``hot_lines``: the rows of hot ids and those without one."""

    orders: DataFrame
    lines: DataFrame
    hot_orders: DataFrame
    hot_lines: DataFrame
    buckets: int
    hot_ids: int
    root: str

    def apply(self, per_order: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``per_order(orders, lines)``, a function whose result rows each
        come from the rows of one order id, over all rows."""
        return per_order(self.orders, self.lines).unionByName(per_order(self.hot_orders, self.hot_lines))


def hot_keys(df: DataFrame, key: str, rows: int, tracked: int = TRACKED) -> list[int]:
    """The key values with about ``rows`` rows or more: one pass with a
    frequent-items sketch in every task. They decide where rows are kept,
    never what a result is, so an estimate will do."""
    found = df.agg(F.expr(f"approx_top_k({key}, {min(tracked, 10_000)}, {tracked})").alias("top")).first()["top"]
    return sorted(int(r["item"]) for r in found or [] if r["item"] is not None and r["count"] >= rows)


def _new_name(table: str) -> str:
    return f"{table}_by_id_{uuid.uuid4().hex[:12]}"


def store(spark: SparkSession, orders: DataFrame, lines: DataFrame, key: str = "order_id", root: str | None = None,
          buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET, hot_rows: int | None = None) -> OrderBuckets:
    """Write both frames by order id under ``root`` (default: the shared table
    folder). ``buckets``: default, so many that one holds about
    ``rows_per_bucket`` lines, and at least the shuffle partitions."""
    from basketry.session import shared_table_root
    root = root or f"{shared_table_root(spark).rstrip('/')}/buckets-{uuid.uuid4().hex[:12]}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or max(partitions, -(-lines.count() // rows_per_bucket))
    hot_rows = hot_rows or rows_per_bucket
    ids = sorted(set(hot_keys(lines, key, hot_rows)) | set(hot_keys(orders, key, hot_rows)))
    hot = spark.createDataFrame([(i,) for i in ids], "__hot long")
    for name, df in (("orders", orders), ("lines", lines)):
        known = df.where(F.col(key).isNotNull())
        # at most 10,000 ids: far below any broadcast threshold
        cold = known.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_anti") if ids else known
        apart = df.where(F.col(key).isNull())
        if ids:
            apart = apart.unionByName(known.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left_semi"))
        table = _new_name(name)
        (cold.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{root}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE `{table}`")  # the files stay; ``attach`` names them
        apart.write.mode("overwrite").parquet(f"{root}/hot_{name}")
    spark.createDataFrame([(key, buckets, len(ids), orders.schema.json(), lines.schema.json())],
                          "key string, buckets int, hot_ids int, orders string, lines string").write.mode(
        "overwrite").parquet(f"{root}/buckets")
    return attach(spark, root)


def attach(spark: SparkSession, root: str, namespace: str = "default") -> OrderBuckets:
    """The tables that :func:`store` wrote, in this or another session. Their
    buckets are made known to the session's catalog."""
    said = spark.read.parquet(f"{root}/buckets").first()
    frames = {}
    for name in ("orders", "lines"):
        table = _new_name(name)
        schema = StructType.fromJson(json.loads(said[name]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE `{namespace}`.`{table}` ({columns}) USING PARQUET CLUSTERED BY (`{said['key']}`) "
                  f"SORTED BY (`{said['key']}`) INTO {said['buckets']} BUCKETS LOCATION '{root}/{name}'")
        frames[name] = spark.table(f"`{namespace}`.`{table}`")
        frames[f"hot_{name}"] = spark.read.schema(schema).parquet(f"{root}/hot_{name}")
    return OrderBuckets(frames["orders"], frames["lines"], frames["hot_orders"], frames["hot_lines"],
                        said["buckets"], said["hot_ids"], root)

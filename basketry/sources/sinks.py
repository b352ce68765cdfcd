"""Sinks: truncate-and-write, namespaces, materialisation, clustered layout.

Materialised tables are written under the shared folder named by
``spark.checkpoint.dir`` (see :func:`basketry.session.shared_table_root`),
never under a machine-local temporary folder, so a lost executor only costs
a task retry and a re-read, not a lineage recomputation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def cluster(df: DataFrame, keys, num_partitions: int | None = None, tiebreak=None) -> DataFrame:
    """Co-locate rows by ``keys``: range partitioning keeps file min/max
    statistics tight, so later filters on the keys skip files and row groups.

    Range bounds cannot split a single key value, so a key holding a large
    share of the rows would land in one write task. ``tiebreak`` (a unique
    column, e.g. the row's id) is appended as the last range key: files stay
    ordered by ``keys`` first, and a hot key spans as many partitions as its
    size needs."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    extra = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    range_keys = keys + [k for k in extra if k not in keys]
    parts = (df.repartitionByRange(num_partitions, *range_keys) if num_partitions
             else df.repartitionByRange(*range_keys))
    return parts.sortWithinPartitions(*range_keys)


def lookup_options(columns) -> dict:
    """Parquet options for Bloom filters of ``columns``: the smallest of several
    candidate sizes that holds a row group's values is kept, 1 MB at most."""
    if not columns:
        return {}
    return {"parquet.bloom.filter.adaptive.enabled": "true", "parquet.bloom.filter.max.bytes": str(1 << 20),
            **{f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}}


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                cluster_by=None, partition_by=None, num_partitions: int | None = None,
                tiebreak=None, observation=None, layout=None, metrics=(), hidden=(), lookup=()) -> None:
    """Truncate-and-write (``overwrite``) or append. ``observation``: an
    ``Observation`` filled with the written row count and the aggregates in
    ``metrics``; it is attached above the last exchange, in the stage that
    writes, where each task counts once however often it is tried. ``layout``:
    a :class:`basketry.sources.layout.Layout` (year and zone folders).
    ``hidden``: columns for the metrics only, which are not written.
    ``lookup``: columns for point look-ups; every row group gets a Bloom filter
    of each, as small as its values allow."""
    from basketry.sources.layout import YEAR, ZONE
    if layout is not None:
        out, partition_by = layout.arranged(df), [YEAR, ZONE]
    else:
        out = cluster(df, cluster_by, num_partitions, tiebreak) if cluster_by else df
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    out = out.drop(*hidden)
    w = out.write.mode(mode).format(fmt).options(**lookup_options(lookup))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`{loc}")


def register_table(spark: SparkSession, namespace: str, name: str, path: str) -> None:
    """Make a written folder known as ``namespace.name`` (the files stay where
    they are)."""
    spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
    spark.sql(f"CREATE TABLE `{namespace}`.`{name}` USING PARQUET LOCATION '{path}'")


def materialize(spark: SparkSession, df: DataFrame, name: str, kind: str = "view",
                root: str | None = None, cluster_by=None, register_view: bool = False,
                tiebreak=None, counts: dict | None = None, layout=None, metrics=(), hidden=(),
                checks: dict | None = None, lookup=()) -> DataFrame:
    """``view``: register a lazy temp view. ``table``: write parquet under
    ``root`` (default: the shared table folder) and return the re-read table,
    which cuts the lineage (a view of it is registered only on request).
    ``counts`` gets the rows written, by table name; ``checks`` the values of
    ``metrics`` (aggregates over the written rows), by their names."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table":
        raise ValueError("kind must be 'view' or 'table'")
    if root is None:
        from basketry.session import shared_table_root
        root = shared_table_root(spark)
    path = f"{root.rstrip('/')}/{name}"
    from pyspark.sql import Observation
    obs = Observation(f"rows_{name}")
    write_table(df, path, cluster_by=cluster_by, tiebreak=tiebreak, observation=obs, layout=layout,
                metrics=metrics, hidden=hidden, lookup=lookup)
    if counts is not None:
        counts[name] = obs.get.get("rows")
    if checks is not None:
        checks.update({k: int(v) for k, v in obs.get.items() if k != "rows"})
    schema = StructType([f for f in df.schema.fields if f.name not in hidden])
    out = read_table(spark, path, schema=schema)
    if register_view:
        out.createOrReplaceTempView(name)
    return out


def read_table(spark: SparkSession, path: str, columns=None, schema: StructType | None = None) -> DataFrame:
    """Read a mart by path; ask only for the needed columns so the parquet
    scan prunes the rest. ``schema``: the declared columns, in their order
    and with their types (folder columns among them; no file is opened to
    find them)."""
    if schema is None:
        df = spark.read.parquet(path)
        columns = columns or [c for c in df.columns if c != "zone"]
        return df.select(*columns)
    return spark.read.schema(schema).parquet(path).select(*(columns or schema.names))


def with_load_observation(df: DataFrame, name: str = "load", date_col: str | None = None, null_columns=()):
    """Attach row count, date range and NULL count metrics that are filled in
    while the write runs, so the load profile needs no second scan."""
    from pyspark.sql import Observation
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if date_col:
        metrics += [F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in null_columns]
    return df.observe(obs, *metrics), obs

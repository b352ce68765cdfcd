"""Loading raw headers and lines, with the column checks and the load
profile. All checks are computed by Spark in one pass; only a single summary
row reaches the driver, never the data."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.sources.schemas import (
    RAW_ORDERS_REQUIRED, RAW_ORDERS_SCHEMA, RAW_SALES_REQUIRED, RAW_SALES_SCHEMA,
)

log = logging.getLogger(__name__)


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required, name: str = "source") -> DataFrame:
    """Raise before any job runs if a required column is absent (the check
    uses the analysed schema only)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{name}: missing required columns {missing}")
    return df


def _read(spark: SparkSession, path: str, fmt: str, schema: StructType | None, options: dict | None) -> DataFrame:
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt == "csv":
        reader = reader.option("header", "true")
    if fmt in ("csv", "json") and schema is not None:
        # text formats: declared schema, no inference pass over the files
        reader = reader.schema(schema)
    return reader.load(path)


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project the declared columns in declared order and types; extra
    columns are pruned at the scan."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns])


def load_orders(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    df = require_columns(_read(spark, path, fmt, RAW_ORDERS_SCHEMA, options), RAW_ORDERS_REQUIRED, "orders")
    return _conform(df, RAW_ORDERS_SCHEMA)


def load_sales(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    df = require_columns(_read(spark, path, fmt, RAW_SALES_SCHEMA, options), RAW_SALES_REQUIRED, "sales")
    return _conform(df, RAW_SALES_SCHEMA)


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """One row: number of NULLs per column, one scan."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def load_profile(df: DataFrame, date_col: str = "date_date") -> DataFrame:
    """One row: rows, columns, first and last date."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.min(F.col(date_col)).alias("min_date"),
        F.max(F.col(date_col)).alias("max_date"),
    )


def warn_on_nulls(df: DataFrame, columns=None) -> dict:
    """Log a warning for required columns that hold NULLs (one job, one row
    returned)."""
    return warn_on_null_counts(null_counts(df, columns).first().asDict())


def warn_on_null_counts(counts: dict) -> dict:
    """The same for counts that are known already (from the load's write)."""
    for c, n in counts.items():
        if n:
            log.warning("column %s has %d NULL values", c, n)
    return counts

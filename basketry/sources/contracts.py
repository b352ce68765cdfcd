"""Contracts that are enforced when a raw table is written.

A contract declares the columns with their types, those that must be there,
and the key. Every row is judged: a value that is not of its type, a missing
required value, or a key that several rows have puts it in the quarantine, with
all its reasons and the row as it came. Both tables come from one write, and
their row counts together are the input's.

Keys are counted with map-side combine and looked up by an equi-join that
Spark can split, so a key that a third of the rows share is no task's burden.
Which of several rows with one key is right is not known: all of them go.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from basketry.sources.readers import require_columns
from basketry.sources.schemas import SOURCES


@dataclass(frozen=True)
class Contract:
    name: str
    schema: StructType
    required: tuple
    key: tuple = ()


#: Required values and keys as the checks declare them.
CONTRACTS = {
    "raw_orders": Contract("raw_orders", SOURCES["orders"]["schema"], ("orders_id", "customers_id", "date_date"), ("orders_id",)),
    "raw_sales": Contract("raw_sales", SOURCES["sales"]["schema"], ("order_id", "products_id", "qty")),
}


def judged(df: DataFrame, contract: Contract) -> DataFrame:
    """The declared columns in their types, ``accepted``, ``reasons`` (sorted
    by column) and, of rejected rows, ``original`` (JSON)."""
    require_columns(df, contract.schema.names, contract.name)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in contract.schema.fields}
    missing = lambda c: F.when(F.col(c).isNull(), F.lit(f"{c}: missing"))
    reasons = [F.when(F.col(c).isNotNull() & t.isNull(), F.lit(f"{c}: not {contract.schema[c].dataType.simpleString()}"))
               for c, t in typed.items()] + [missing(c) for c in contract.required]
    rows = df.select(*[t.alias(c) for c, t in typed.items()], F.array_compact(F.array(*reasons)).alias("reasons"),
                     F.to_json(F.struct(*[F.col(c) for c in contract.schema.names]), {"ignoreNullFields": "false"}).alias("original"))
    if contract.key:
        known = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in contract.key))
        twice = rows.where(known).groupBy(*[F.col(c).alias(f"__{c}") for c in contract.key]).count().where("count > 1")
        rows = rows.join(twice, [F.col(c) == F.col(f"__{c}") for c in contract.key], "left")
        again = F.when(F.col("count").isNotNull(), F.array(F.lit(f"{', '.join(contract.key)}: not unique"))).otherwise(F.array())
        rows = rows.withColumn("reasons", F.concat("reasons", again.cast("array<string>")))
    accepted = F.size("reasons") == 0
    return rows.select(*contract.schema.names, accepted.alias("accepted"), F.array_sort("reasons").alias("reasons"),
                       F.when(~accepted, F.col("original")).alias("original"))


def write(df: DataFrame, contract: Contract, dest: str) -> dict:
    """Write the accepted rows to ``dest/<name>`` and the others to
    ``dest/<name>_quarantine``; returns the rows of each. One pass over the
    rows writes both into folders aside, which are then renamed."""
    from basketry.sources.snapshots import Folder
    spark, counts = df.sparkSession, Observation(f"contract_{contract.name}")
    aside = f"{contract.name}_judged"
    out = judged(df, contract).observe(counts, F.count(F.lit(1)).alias("rows"), F.count_if("accepted").alias("accepted"))
    out.write.mode("overwrite").partitionBy("accepted").parquet(f"{dest}/{aside}")
    folder = Folder(spark, dest)
    for value, name in (("true", contract.name), ("false", f"{contract.name}_quarantine")):
        folder.drop(name)
        if value in {n.split("=")[-1] for n in folder.names(aside)}:
            folder.move(f"{aside}/accepted={value}", name)
        else:  # a table without rows
            out.sparkSession.createDataFrame([], _written(contract)).write.parquet(f"{dest}/{name}")
    folder.drop(aside)
    got = counts.get
    return {"rows": got["rows"], "accepted": got["accepted"], "quarantined": got["rows"] - got["accepted"]}


def _written(contract: Contract) -> StructType:
    return StructType([*contract.schema.fields, StructField("reasons", ArrayType(StringType())), StructField("original", StringType())])


def read(spark: SparkSession, contract: Contract, dest: str) -> DataFrame:
    return spark.read.schema(contract.schema).parquet(f"{dest}/{contract.name}")


def quarantine(spark: SparkSession, contract: Contract, dest: str) -> DataFrame:
    return spark.read.schema(_written(contract)).parquet(f"{dest}/{contract.name}_quarantine")

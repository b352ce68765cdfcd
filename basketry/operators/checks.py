"""Generic data checks. Each check is a query returning the violating rows;
a check passes when it returns none. Severity ``error`` makes
:func:`run_checks` raise, ``warn`` only reports."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    build: Callable[[], DataFrame]
    severity: str = "error"

    def violations(self) -> DataFrame:
        return self.build()


class BuildHeld(RuntimeError):
    """A build whose row checks of severity error found something, and which
    was not published therefore."""

    def __init__(self, root: str, failing: dict):
        super().__init__(f"not published: {failing}; tables in {root}")
        self.root, self.failing = root, failing


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column) -> DataFrame:
    """Non-NULL key values that occur more than once, with their count."""
    cols = [column] if isinstance(column, str) else list(column)
    present = df.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in cols)))
    return present.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


#: Words that are sent to every task: 16 MB at most.
WORDS = 1_000_000


def unique_ids(df: DataFrame, column: str, limit: int = WORDS) -> DataFrame:
    """What :func:`unique` returns for an integer column, but only candidates
    are shuffled by value.

    Ids travel as words of 64 neighbours, with a mask of those seen and their
    number: one row for each word a task has, where tables that keep nearby
    ids together have dozens of ids a word. A word with more rows than bits has
    a repeated id; the ids of such words are counted exactly. The repeated
    words are written to the shared folder and counted; more than ``limit`` of
    them are not worth a filter, and all ids are counted then."""
    import uuid
    from basketry.session import shared_table_root
    present = df.where(F.col(column).isNotNull())
    word = F.shiftright(F.col(column).cast("long"), 6)
    bit = F.expr(f"shiftleft(1L, CAST(`{column}` & 63 AS INT))")
    found = (present.groupBy(word.alias("__word")).agg(F.count(F.lit(1)).alias("__rows"), F.bit_or(bit).alias("__seen"))
             .where("__rows > bit_count(__seen)").select("__word"))
    path = f"{shared_table_root(df.sparkSession).rstrip('/')}/words-{uuid.uuid4().hex[:12]}"
    found.write.parquet(path)
    words = df.sparkSession.read.schema("__word long").parquet(path)
    if words.count() > limit:
        return unique(df, column)
    return unique(present.join(F.broadcast(words), word == F.col("__word"), "left_semi"), column)


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose value is outside ``values``; NULL is not judged here (use
    :func:`not_null` for that)."""
    return df.where(~F.col(column).isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL child keys without a parent row (anti join)."""
    keys = parent.select(F.col(parent_column).alias("__parent_key"))
    return (child.where(F.col(column).isNotNull())
            .join(keys, F.col(column) == F.col("__parent_key"), "left_anti"))


def null_count_summary(df: DataFrame, columns, table: str) -> DataFrame:
    """NULL counts of many columns of one table in a single scan, returned as
    one row per column: (table_name, column_name, null_count)."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(columns))
    return counts.select(
        F.lit(table).alias("table_name"),
        F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)"),
    )


def run_checks(checks, raise_on_error: bool = True) -> list[tuple[str, str, int]]:
    """Count the violations of every check (one small job each) and raise
    when an ``error`` check fails. Only counts reach the driver."""
    results = []
    for chk in checks:
        n = chk.violations().count()
        results.append((chk.name, chk.severity, n))
    failed = [r for r in results if r[1] == "error" and r[2] > 0]
    if failed and raise_on_error:
        raise AssertionError(f"failing checks: {failed}")
    return results

"""Stored aggregates of a mart and the choice among them.

A :class:`Rollup` keeps one mart at a date grain (day, month) and a few plain
dimensions: additive sums, under the mart's own column names, and sets of ids
as exact bitmaps (one row of 64 bits, a long, for each word of ids that occurs),
which merge by OR in hash aggregates and take no more rows than there are ids. So distinct counts roll up as sums do: any dimension that
the stored ones determine - a week, a quarter, a segment, the total - needs no
scan of the mart.

A coarser rollup is built from a finer one (``parent``). :func:`choose` takes
the smallest that covers a request's dimensions, measures and filter, or none,
and then the mart answers.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "order_date"
#: Grains that a stored grain determines.
COARSER = {"day": ("day", "week", "month", "quarter", "year"), "month": ("month", "quarter", "year")}


@dataclass(frozen=True)
class Slice:
    """A filter on what rollups keep: a half-open date range, one segment, one
    profile, orders with a complete history only (None: not set)."""

    date_from: dt.date | None = None
    date_to: dt.date | None = None
    segment: str | None = None
    profile: str | None = None
    complete_only: bool | None = None

    @property
    def dims(self) -> set[str]:
        wanted = {"order_segmentation": self.segment, "customer_profile": self.profile,
                  "has_complete_12_month_history": self.complete_only or None}
        return {k for k, v in wanted.items() if v is not None}

    def fits(self, grain: str) -> bool:
        """Whether whole grains make up the date range."""
        return grain == "day" or all(d is None or d.day == 1 for d in (self.date_from, self.date_to))

    def over(self, df: DataFrame) -> DataFrame:
        """The rows of a mart that pass; of its year folders only those that
        can have any are read."""
        keep = self.column(years="order_year" in df.columns)
        return df.where(keep) if keep is not None else df

    def column(self, years: bool = False) -> Column | None:
        """The predicate; ``years``: with one on the year folders."""
        from basketry.functions.dates import in_year_folders
        preds = [in_year_folders(self.date_from, self.date_to)] if years else []
        if self.date_from is not None:
            preds.append(F.col(DATE) >= F.lit(self.date_from))
        if self.date_to is not None:
            preds.append(F.col(DATE) < F.lit(self.date_to))
        if self.segment is not None:
            preds.append(F.col("order_segmentation") == self.segment)
        if self.profile is not None:
            preds.append(F.col("customer_profile") == self.profile)
        if self.complete_only:
            preds.append(F.col("has_complete_12_month_history"))
        out = None
        for p in preds:
            if p is not None:
                out = p if out is None else out & p
        return out


@dataclass(frozen=True)
class Rollup:
    """``sums``: stored column -> aggregate over the mart. ``sets``: id
    columns whose values are kept as bitmaps. ``parent``: the finer rollup it
    is built from, with the same sums; its sets are built from the parent's
    where it has them."""

    name: str
    mart: str
    grain: str | None                      # None: no date
    dims: tuple
    sums: dict = field(default_factory=dict)
    sets: tuple = ()
    parent: str | None = None

    @property
    def keys(self) -> list[str]:
        return [*([DATE] if self.grain else []), *self.dims]

    def at_grain(self, df: DataFrame) -> DataFrame:
        return df.withColumn(DATE, F.trunc(DATE, self.grain)) if self.grain not in (None, "day") else df

    def sums_of(self, df: DataFrame, stored: bool = False) -> DataFrame:
        aggs = [(F.sum(c) if stored else a()).alias(c) for c, a in self.sums.items()]
        return self.at_grain(df).groupBy(*self.keys).agg(*aggs)

    def sets_of(self, df: DataFrame, stored: bool = False) -> DataFrame:
        """keys, kind (the id column), word (the id without its last six bits),
        bits (a bit for each id of the word)."""
        df = self.at_grain(df)
        if stored:
            return df.groupBy(*self.keys, "kind", "word").agg(F.bit_or("bits").alias("bits"))
        ids = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("long").alias("id")) for c in self.sets]))
        rows = df.select(*self.keys, ids.alias("x")).where("x.id IS NOT NULL").select(
            *self.keys, "x.kind", F.shiftright("x.id", 6).alias("word"), F.expr("shiftleft(1L, cast(x.id & 63 as int))").alias("bit"))
        return rows.groupBy(*self.keys, "kind", "word").agg(F.bit_or("bit").alias("bits"))


@dataclass(frozen=True)
class Stored:
    rollup: Rollup
    sums: DataFrame
    sets: DataFrame | None
    rows: int = 0
    set_rows: int = 0

    def cost(self, measures: list) -> int:
        """Rows that an answer reads."""
        return self.rows + (self.set_rows if any(m.ids is not None for m in measures) else 0)

    def covers(self, dims: list, measures: list, wanted: Slice | None, params: dict) -> bool:
        """dims: Dimension objects; measures: Measure objects."""
        r = self.rollup
        here = {*r.dims, *([DATE] if r.grain else [])}
        for d in dims:
            if not d.columns or not set(d.columns) <= here:
                return False
            if DATE in d.columns and d.grain(params) not in COARSER[r.grain]:
                return False
        for m in measures:
            if m.ids is not None:
                if m.ids not in r.sets:
                    return False
            elif m.rolled is None or not set(m.stored) <= {*r.sums, *here}:
                return False
        if wanted is None:
            return True
        dated = wanted.date_from is not None or wanted.date_to is not None
        return wanted.dims <= here and (not dated or (r.grain is not None and wanted.fits(r.grain)))

    def answer(self, dims: list, measures: list, wanted: Slice | None, params: dict) -> DataFrame:
        """The measures by the dimensions, from the stored rows."""
        names = [d.name for d in dims]
        by = [d.expr(params).alias(d.name) for d in dims]
        over = lambda df: wanted.over(df) if wanted is not None else df
        own = [m for m in measures if m.ids is None]
        ids = [m for m in measures if m.ids is not None]
        sums = over(self.sums).groupBy(*by).agg(*[m.rolled().alias(m.name) for m in own] or [F.count(F.lit(1)).alias("__n")])
        if not ids:
            return sums.select(*names, *[m.name for m in own])
        bits = over(self.sets).where(F.col("kind").isin([m.ids for m in ids])).groupBy(*by, "kind", "word").agg(
            F.bit_or("bits").alias("bits"))
        counts = bits.groupBy(*names).agg(*[
            F.sum(F.when(F.col("kind") == m.ids, F.bit_count("bits"))).alias(m.name) for m in ids])
        # both have a row a group: put side by side by one more aggregate
        both = sums.unionByName(counts, allowMissingColumns=True).groupBy(*names).agg(
            *[F.max(m.name).alias(m.name) for m in own],
            *[F.coalesce(F.max(m.name), F.lit(0)).cast("bigint").alias(m.name) for m in ids])
        return both.select(*names, *[m.name for m in measures])


def choose(stored, dims: list, measures: list, wanted, params: dict) -> Stored | None:
    """The smallest rollup that covers the request, if any does."""
    if wanted is not None and not isinstance(wanted, Slice):
        return None
    fits = [s for s in stored if s.covers(dims, measures, wanted, params)]
    return min(fits, key=lambda s: (s.cost(measures), len(s.rollup.keys)), default=None)


def store(spark: SparkSession, rollups: list[Rollup], marts, root: str) -> list[Stored]:
    """Write the rollups below ``root``, parents first, and read them back.
    ``marts``: an object with the marts as attributes."""
    from basketry.sources.sinks import materialize
    out: dict[str, Stored] = {}
    counts: dict = {}
    for r in rollups:
        parent = out.get(r.parent)
        base = getattr(marts, r.mart)
        write = lambda df, name: materialize(spark, df, name, "table", root, counts=counts)
        sums = write(r.sums_of(parent.sums, True) if parent else r.sums_of(base), r.name)
        sets = None
        if r.sets:
            known = parent is not None and set(r.sets) <= set(parent.rollup.sets)
            sets = write(r.sets_of(parent.sets, True) if known else r.sets_of(base), f"{r.name}_ids")
        out[r.name] = Stored(r, sums, sets, counts[r.name], counts.get(f"{r.name}_ids", 0))
    return list(out.values())

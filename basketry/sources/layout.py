"""Clustered layout: year folders, and in each year zones of a curve through
the clustering keys.

A row's place on a key is the rank of its value among bounds (quantiles of the
key, or a fixed list of values), a few bits. The bits of all keys, interleaved,
are its place on a space-filling curve; the curve's leading bits are the zone.
A zone therefore covers a box of ranks of *every* key, and a slice on any one
of them needs the zones of some ranks only. Year and zone are folders, so both
prune at planning time.

The bounds come from columns that are there before the last join of a table
(:func:`quantile_columns` are aggregates to be added to a pass over them).
Rows are dealt out by a rebalancing exchange on (year, zone): no sampling, so
the plan below it runs once, and a zone that is too large for a task - a
customer with a third of all orders - is split by Spark at runtime.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

YEAR, ZONE = "order_year", "zone"
#: Ranks of a key with quantile bounds are numbers of so many bits.
RANK_BITS = 6
#: Zones a year: at least and at most, as powers of two.
ZONE_BITS = (2, 6)
ROWS_PER_ZONE = 4_000_000


def rank_of(bounds, value: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``value`` (NULL: 0): a
    binary search inside the expression."""
    if not bounds:
        return F.lit(0)
    table, steps = F.array(*[F.lit(b) for b in bounds]), []
    step = 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                       lambda low, s: F.when(F.get(table, low + s - 1) <= value, low + s).otherwise(low))


def quantile_columns(key: str, column: Column | None = None) -> list[Column]:
    """Aggregates for the bounds of ``key``: one array of 2**RANK_BITS - 1
    quantiles, whatever the data."""
    n = 1 << RANK_BITS
    return [F.percentile_approx(column if column is not None else F.col(key), [k / n for k in range(1, n)], 1000)
            .alias(f"quantiles:{key}")]


@dataclass(frozen=True)
class Layout:
    """``keys``: (column, sorted bounds) in order of precedence."""

    keys: tuple
    zone_bits: int

    @classmethod
    def of(cls, keys: dict, rows: int, years: int, rows_per_zone: int = ROWS_PER_ZONE) -> "Layout":
        wanted = rows // max(1, years * rows_per_zone)
        bits = min(ZONE_BITS[1], max(ZONE_BITS[0], wanted.bit_length()))
        return cls(tuple((k, tuple(sorted(set(b or [])))) for k, b in keys.items()), bits)

    @property
    def curve(self) -> list[tuple[int, int]]:
        """(key, bit) from the curve's leading bit on: the keys take turns."""
        left = [len(b).bit_length() for _, b in self.keys]
        out = []
        while any(left):
            for k, n in enumerate(left):
                if n:
                    left[k] -= 1
                    out.append((k, left[k]))
        return out

    def placed(self, df: DataFrame) -> DataFrame:
        """``df`` with each row's place on the curve and its zone."""
        curve, names = self.curve, df.columns
        df = df.select("*", *[rank_of(b, F.col(k)).alias(f"__rank{i}") for i, (k, b) in enumerate(self.keys)])
        place = F.lit(0)
        for at, (k, bit) in enumerate(reversed(curve)):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(f"__rank{k}", bit).bitwiseAND(F.lit(1)), at))
        rest = max(0, len(curve) - self.zone_bits)
        return df.select(*names, place.cast("int").alias("__place")).withColumn(ZONE, F.shiftright("__place", rest))

    def arranged(self, df: DataFrame) -> DataFrame:
        """``df`` with its zone, dealt out by (year, zone) and sorted along
        the curve, ready to be written into folders of both."""
        dealt = self.placed(df).hint("rebalance", F.col(YEAR), F.col(ZONE))
        return dealt.sortWithinPartitions(YEAR, ZONE, "__place", *[k for k, _ in self.keys]).select(*df.columns, ZONE)

    def zones(self, **wanted) -> list[int]:
        """The zones that hold rows with each key in its (low, high) interval
        (ends included), or equal to its value."""
        leading = self.curve[:self.zone_bits]
        out = []
        for zone in range(1 << len(leading)):
            fits = True
            for k, (name, bounds) in enumerate(self.keys):
                if name not in wanted:
                    continue
                low, high = wanted[name] if isinstance(wanted[name], tuple) else (wanted[name],) * 2
                low, high = sum(b <= low for b in bounds), sum(b <= high for b in bounds)
                known = [(b, zone >> (len(leading) - 1 - at) & 1) for at, (i, b) in enumerate(leading) if i == k]
                least = sum(v << b for b, v in known)
                free = min((b for b, _ in known), default=len(bounds).bit_length())
                fits &= least <= high and low <= least + (1 << free) - 1
            if fits:
                out.append(zone)
        return out

    def slice(self, **wanted) -> Column:
        """The predicate of a slice: its zones (folders) and the keys."""
        unknown = set(wanted) - {k for k, _ in self.keys}
        if unknown:
            raise KeyError(f"not clustered by {sorted(unknown)}")
        out = F.col(ZONE).isin(self.zones(**wanted))
        for name, value in wanted.items():
            out &= F.col(name).between(*value) if isinstance(value, tuple) else F.col(name) == value
        return out

    def to_json(self) -> dict:
        return {"keys": [[k, list(b)] for k, b in self.keys], "zone_bits": self.zone_bits}

    @classmethod
    def from_json(cls, value: dict | str) -> "Layout":
        value = json.loads(value) if isinstance(value, str) else value
        return cls(tuple((k, tuple(b)) for k, b in value["keys"]), value["zone_bits"])

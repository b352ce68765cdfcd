"""A small metric layer: named dimensions and measures over one table.

``explore(view, df, dimensions, measures, filters)`` is
``df.where(filters).groupBy(dimensions).agg(measures)``; everything stays a
lazy Catalyst plan. Distinct-count measures are flagged as non-additive: they
are never summed from finer rows, but recomputed from the mart or counted from
merged bitmaps. Given stored rollups, a request reads the smallest of them that
covers it (:mod:`basketry.operators.rollups`).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame

from basketry.operators.rollups import Slice, choose


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: Callable[..., Column]          # (params) -> Column
    description: str = ""
    columns: tuple = ()                  # of the mart that it is made of; () if only the mart has them
    grain: Callable | None = None        # (params) -> date grain, of a date dimension


@dataclass(frozen=True)
class Measure:
    name: str
    expr: Callable[[], Column]           # aggregate Column
    additive: bool = True
    description: str = ""
    stored: tuple = ()                   # columns of a rollup that it is made of
    rolled: Callable[[], Column] | None = None   # aggregate over a rollup's rows
    ids: str | None = None               # of a distinct count: the id column


@dataclass(frozen=True)
class View:
    name: str
    dimensions: dict = field(default_factory=dict)
    measures: dict = field(default_factory=dict)
    # Derived measures computed from other measures after aggregation.
    derived: dict = field(default_factory=dict)
    parameters: dict = field(default_factory=dict)   # name -> (allowed values, default)

    def param(self, params: dict, name: str):
        allowed, default = self.parameters[name]
        value = params.get(name, default)
        if value not in allowed:
            raise ValueError(f"{self.name}.{name}: {value!r} not in {allowed}")
        return value


def explore(view: View, df: DataFrame, dimensions=(), measures=(), filters=None,
            params: dict | None = None, rollups=()) -> DataFrame:
    """``filters``: a Column over the mart, or a ``Slice``, which rollups
    understand as well."""
    params = dict(params or {})
    for p in view.parameters:
        view.param(params, p)  # validate
    dims = []
    for d in dimensions:
        if d not in view.dimensions:
            raise KeyError(f"{view.name}: unknown dimension {d!r}")
        dims.append(view.dimensions[d].expr(params).alias(d))
    base, post = [], []
    for m in measures:
        if m in view.measures:
            base.append(m)
        elif m in view.derived:
            post.append(m)
        else:
            raise KeyError(f"{view.name}: unknown measure {m!r}")
    needed = list(dict.fromkeys(base + [b for m in post for b in view.derived[m][0]]))
    asked = [view.dimensions[d] for d in dimensions], [view.measures[m] for m in needed]
    small = choose(rollups, *asked, filters, params)
    if small is not None:
        out = small.answer(*asked, filters, params)
    else:
        if isinstance(filters, Slice):
            src = filters.over(df)
        else:
            src = df.where(filters) if filters is not None else df
        aggs = [view.measures[m].expr().alias(m) for m in needed]
        out = src.groupBy(*dims).agg(*aggs) if dims else src.agg(*aggs)
    for m in post:
        _, fn = view.derived[m]
        out = out.withColumn(m, fn())
    return out.select(*dimensions, *measures)

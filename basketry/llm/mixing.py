"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: the sources in code-point order weigh 5, 2, 1, 5, 2, 1, ... and share
the sizes of all; a target stops at ``most`` times its source's size and the
excess goes to the others by weight, until none is above.

Each source is a stream of its documents in hashed order, cut into blocks of
near equal numbers of words. Slot k of the schedule is the point
frac((k + 1/2) / golden ratio), mapped through the cumulative shares of the
sources; the r-th slot of a source takes its block r modulo its number of
blocks. Every start of the schedule is thus close to the shares, a source's
blocks are taken equally often but for one turn, and none over ``most`` times.

A prefix sum over a source is done in hash ranges, so that no task holds a
source, and slots are ranked in stretches of the schedule likewise.

Edge cases: a null text has size 0; a null source is a source of its own, the
last; sources without words have target 0; rows with one id are rows like
others; an empty table gives an empty one; further columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import WORD, plain_text, search, written

WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
#: Words in a block, whatever the corpus: what a source gives differs from its
#: target by about a block.
BLOCK_WORDS = 64
STRETCHES = 4096


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    target: float
    block: int  #: words in a block, the last may have fewer
    blocks: int


def targets(sizes: list[tuple[str | None, int]], most: float = 3.0, weights=WEIGHTS) -> list[tuple[str | None, int, float]]:
    """(source, size, target), sources by code point and null last."""
    sizes = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    cap = [float(most * n) for _, n in sizes]
    target, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(n for _, n in sizes))
    while free:
        unit = left / sum(weight[i] for i in free)
        over = [i for i in sorted(free) if weight[i] * unit > cap[i]]
        for i in over or free:
            target[i] = cap[i] if over else weight[i] * unit
        left -= sum(target[i] for i in over)
        free = free - set(over) if over else set()
    return [(s, n, t) for (s, n), t in zip(sizes, target)]


def plan(sizes: list[tuple[str | None, int]], most: float = 3.0, block_words: int = BLOCK_WORDS) -> list[Source]:
    """Targets and blocks of every source, of about ``block_words`` words."""
    out = []
    for name, n, target in targets(sizes, most):
        block = -(-n // max(1, round(n / block_words))) if n else 1
        out.append(Source(name, n, target, block, -(-n // block)))
    return out


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, h (place in the hashed order), without texts."""
    return docs.select("doc_id", "source", F.regexp_count(plain_text(), F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64("doc_id", F.crc32(F.encode(plain_text(), "UTF-8"))).alias("h"))


def schedule(spark, sources: list[Source], most: int = 3) -> DataFrame:
    """slot, source_at (index of the source), rank, block: the schedule."""
    share = [s.target / s.block for s in sources]
    slots, whole, cumulative, so_far = round(sum(share)), sum(share) or 1.0, [], 0.0
    for x in share[:-1]:
        so_far += x / whole
        cumulative.append(so_far)
    stretch = max(1, -(-slots // STRETCHES))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), (F.col("id") / stretch).cast("long").alias("stretch"),
        search(cumulative, F.expr(f"((id + 0.5D) * {GOLDEN!r}D) % 1D")).alias("source_at"))
    before = Window.partitionBy("source_at").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (points.groupBy("source_at", "stretch").count()
               .withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    inside = Window.partitionBy("source_at", "stretch").orderBy("slot")
    blocks = F.get(F.array(*[F.lit(max(1, s.blocks)).cast("long") for s in sources]), F.col("source_at"))
    return (points.withColumn("nth", F.row_number().over(inside) - 1)
            .join(offsets, ["source_at", "stretch"])
            .select("slot", "source_at", (F.col("nth") + F.col("offset")).alias("rank"))
            .where(F.col("rank") < most * blocks)
            .withColumn("block", F.col("rank") % blocks))


def mix(rows: DataFrame, sources: list[Source], most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, h of every row of
    ``rows`` (as :func:`sized` makes them)."""
    spark = rows.sparkSession
    table = spark.createDataFrame([(s.name, i, s.size, s.target, s.block) for i, s in enumerate(sources)],
                                  "name string, source_at int, source_size long, target double, block_words long")
    rows = rows.join(table, rows["source"].eqNullSafe(table["name"]))
    rows = rows.drop("name").withColumn("part", F.shiftrightunsigned("h", 52))
    before = Window.partitionBy("source_at").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("source_at", "part").agg(F.sum("size").alias("words"))
               .withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words"))
    inside = (Window.partitionBy("source_at", "part").orderBy("h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, ["source_at", "part"])
              .withColumn("start", F.col("offset") + F.col("before")).drop("offset", "before", "part"))
    times = schedule(spark, sources, most).groupBy("source_at", "block").agg(F.count("*").alias("times"))
    step = F.col("block_words")
    pieces = (placed.where("size > 0")
              .withColumn("block", F.explode(F.sequence(F.expr("start div block_words"),
                                                        F.expr("(start + size - 1) div block_words"))))
              .withColumn("words", F.least((F.col("block") + 1) * step, F.col("start") + F.col("size"))
                          - F.greatest(F.col("block") * step, F.col("start"))))
    columns = ["doc_id", "source", "size", "source_size", "target", "h"]
    taken = (pieces.join(times, ["source_at", "block"], "left")
             .groupBy("source_at", "start", *columns)
             .agg(F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")))
    empty = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return taken.select(*columns, "taken").unionByName(empty.select(*columns, "taken"))


def mixed(docs: DataFrame, most: int = 3, block_words: int = BLOCK_WORDS) -> DataFrame:
    """:func:`mix` over documents: sizes are written once, summed by source
    (one row a source goes to the driver) and mixed."""
    rows = written(sized(docs), "sizes")
    sums = [(r["source"], int(r["size"])) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    return mix(rows, plan(sums, most, block_words), most)


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "source")

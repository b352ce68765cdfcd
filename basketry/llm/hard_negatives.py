"""Hard negatives by slots of scores.

For every anchor the other rows of its label give positives (the best ``k`` by
integer inner product), and each positive asks for the best ``k`` rows of
other labels whose score lies between ``low`` percent of its own score and
its own score. The windows of one anchor overlap. Their upper limits split
the scores into disjoint slots: slot j holds the scores from the next lower
limit (exclusive) to limit j. A task keeps the best ``k`` rows of each slot
(its combiner), so does the merge over tasks. Going down to the lowest limit
and back, the best ``k`` of slot j and of the merge of all lower slots are the
best ``k`` rows up to limit j; cutting off what lies under the positive's
lower limit answers its window. No row is scored for a window twice.

Every anchor meets every row in a grid of anchor groups (of at most
``GROUP_BYTES``) and slices of rows: a partition gets the anchors of its cells
first and streams the rows past them in blocks. Rows travel once for each
anchor group. Scores are computed twice, once for the positives and once
within their limits, and never leave the task.

Values: a component x becomes floor(256*x). Scores are exact (float32 or
float64 products where their bound allows it, integers otherwise).

Edge cases: rows with a null label, a null vector or a null, NaN or infinite
component take no part. Vectors of different length are compared as if the
shorter ended in zeros; an empty one scores 0. Rows with a null id are no
anchors, keep their label, and rank after all others in ties. Repeated rows
are rows of their own: a copy of an anchor is one of its positives, and an
anchor that occurs m times gives its rows m times. Anchors without positives
or negatives give no rows. Very long vectors only make blocks of fewer rows.
An empty table gives an empty one; further columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import ship, shuffle_partitions, written

ship(__name__)

GROUP_BYTES = 16 << 20
#: Scores that a block of anchors and rows has at most.
BLOCK_SCORES = 1 << 21
SCALE = 256
NO_ID, NONE = np.iinfo(np.int64).max, np.iinfo(np.int64).min

FOUND = "anchor_id long, uid long, slot int, score long, unnamed boolean, id long"


def usable(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", flip: int = 7, labels: int = 10) -> DataFrame:
    """id, label, vec (array of long) of the rows that take part; where the id
    is divisible by ``flip`` the label becomes the next of ``labels``."""
    label = F.col("label").cast("long")
    x = F.col(vector).cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(F.col("label").isNotNull() & F.col(vector).isNotNull()).where(fine).select(
        F.col(id_col).cast("long").alias("id"),
        F.when(F.col(id_col) % flip == 0, (label + 1) % labels).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("vec"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """A list array as rows of ``width`` integers, padded with zeros."""
    ends = vectors.offsets.to_numpy()
    flat, ends = vectors.values.to_numpy()[ends[0]:ends[-1]], ends - ends[0]
    out = np.zeros((len(ends) - 1, width), np.int64)
    sizes = np.diff(ends)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(ends[:-1], sizes)
    keep = at < width
    out[row[keep], at[keep]] = flat[keep]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and of ``b``, as int64."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1]
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)  # raises beyond the range of a long


def best(anchor, slot, score, ids, k: int) -> np.ndarray:
    """Places of the first ``k`` of each (anchor, slot): higher scores, then
    smaller ids."""
    order = np.lexsort((ids, -score, slot, anchor))
    first = np.r_[True, (np.diff(anchor[order]) != 0) | (np.diff(slot[order]) != 0)][:len(order)]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - begin < k]


class Cell:
    """The anchors of one cell of the grid and the best rows so far of each
    (anchor, slot)."""

    def __init__(self, k: int, low: int):
        self.k, self.low, self.parts, self.held = k, low, [], None

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def close(self) -> None:
        table = pa.Table.from_batches(self.parts)
        self.parts, self.ids = [], table["id"].to_numpy()
        self.uid, self.label = table["uid"].to_numpy(), table["label"].to_numpy()
        vectors = table["vec"].combine_chunks()
        self.width = max(1, int(np.diff(vectors.offsets.to_numpy()).max(initial=0)))
        self.vec = matrix(vectors, self.width)
        limits = table["limits"].combine_chunks()
        self.windows = bool(len(limits) and limits.null_count == 0)
        if self.windows:  # distinct upper limits, highest first, filled up with one that no score reaches
            most = max(1, int(np.diff(limits.offsets.to_numpy()).max(initial=0)))
            self.limits = np.full((len(self.ids), most), NONE, np.int64)
            for i, values in enumerate(limits.to_pylist()):
                self.limits[i, :len(values)] = values
            lowest = np.array([min(v) for v in limits.to_pylist()], np.int64)
            self.floor = -(-lowest * self.low // 100)
        self.held = [np.empty(0, np.int64) for _ in range(4)]  # anchor, slot, score, id (the largest for none)

    def rows(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
        label, uid = batch.column("label").to_numpy(), batch.column("uid").to_numpy()
        vec = matrix(batch.column("vec"), self.width)
        step = max(1, BLOCK_SCORES // max(1, len(ids)))
        for at in range(0, len(self.ids), step):
            self.block(slice(at, at + step), ids, label, uid, vec)

    def block(self, part: slice, ids, label, uid, vec) -> None:
        if self.windows:
            scores, limits = products(self.vec[part], vec), self.limits[part]
            anchor, row = np.nonzero((scores >= self.floor[part, None]) & (scores <= limits[:, :1])
                                     & (self.label[part, None] != label[None, :]))
            score = scores[anchor, row]
            slot = (limits[anchor] >= score[:, None]).sum(1) - 1  # the lowest limit that is not under the score
            self.keep(anchor + part.start, slot, score, ids[row])
            return
        for one in np.unique(self.label[part]):
            mine, theirs = np.nonzero(self.label[part] == one)[0], np.nonzero(label == one)[0]
            if not len(theirs):
                continue
            scores = products(self.vec[part][mine], vec[theirs])
            same = (self.uid[part][mine][:, None] == uid[theirs][None, :]) & (self.ids[part][mine][:, None] == ids[theirs][None, :])
            scores[same] = NONE
            least = np.partition(scores, -self.k, axis=1)[:, -self.k, None] if len(theirs) > self.k else NONE
            anchor, row = np.nonzero((scores >= least) & ~same)
            self.keep(mine[anchor] + part.start, np.zeros(len(anchor), np.int64), scores[anchor, row], ids[theirs][row])

    def keep(self, *found) -> None:
        if len(found[0]):
            both = [np.concatenate(x) for x in zip(self.held, found)]
            top = best(*both, self.k)
            self.held = [x[top] for x in both]

    def found(self):
        anchor, slot, score, ids = self.held
        for at in range(0, len(anchor), 20_000):
            a, i = anchor[at:at + 20_000], ids[at:at + 20_000]
            none = i == NO_ID
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[a]), pa.array(self.uid[a]), pa.array(slot[at:at + 20_000].astype(np.int32)),
                 pa.array(score[at:at + 20_000]), pa.array(none), pa.array(i, mask=none)],
                ["anchor_id", "uid", "slot", "score", "unnamed", "id"])


def scored(anchors: DataFrame, rows: DataFrame, k: int, low: int) -> DataFrame:
    """The best ``k`` of each (anchor, slot) in each cell of the grid. Anchors:
    id, uid, label, vec, limits (null: one slot, of the anchor's own label);
    rows: id, uid, label, vec, place."""
    width = int(anchors.agg(F.sum(F.size("vec").cast("long") * 8 + 200)).first()[0] or 0)
    groups = max(1, -(-width // GROUP_BYTES))
    slices = max(1, -(-shuffle_partitions(rows.sparkSession) // groups))
    cell = (F.col("g") * slices + F.col("s")).alias("cell")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select(F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("g"), numbers(slices).alias("s"), F.lit(0).alias("kind"),
                          "id", "uid", "label", "vec", "limits", F.lit(0).cast("long").alias("place"))
    right = rows.select(numbers(groups).alias("g"), F.pmod("place", F.lit(slices)).cast("int").alias("s"),
                        F.lit(1).alias("kind"), "id", "uid", "label", "vec", F.lit(None).cast("array<long>").alias("limits"), "place")
    dealt = left.unionByName(right).select(cell, "kind", "id", "uid", "label", "vec", "limits", "place")

    def run(batches):
        at, now, closed = None, None, True
        for batch in batches:
            cells, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (np.diff(cells) != 0) | (np.diff(kinds) != 0), True])
            for begin, end in zip(cuts[:-1], cuts[1:]):
                if cells[begin] != at:
                    if now is not None and closed:
                        yield from now.found()
                    at, now, closed = cells[begin], Cell(k, low), False
                if kinds[begin] == 0:
                    now.add(batch.slice(begin, end - begin))
                elif now.parts or closed:
                    if not closed:
                        now.close()
                        closed = True
                    now.rows(batch.slice(begin, end - begin))
        if now is not None and closed:
            yield from now.found()

    return dealt.repartitionById(groups * slices, "cell").sortWithinPartitions("cell", "kind", "place").mapInArrow(run, FOUND)


def _first(k: int, *by):
    """The first ``k`` of a group's found rows."""
    return F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "unnamed", "id"))), 1, k)


def windows(positives: list, slots: dict, k: int, low: int) -> list[tuple]:
    """(positive, rank, negative) of one anchor. ``positives``: (-score,
    unnamed, id) in order; ``slots``: slot -> its best rows, alike. The suffix
    merges go from the lowest limit up; each answers the windows that end
    there."""
    limits = sorted({-p[0] for p in positives}, reverse=True)
    merged, upto = [], {}
    order = lambda x: (x[0], x[1], x[2] or 0)
    for j in reversed(range(len(limits))):
        merged = sorted([*slots.get(j, []), *merged], key=order)[:k]
        upto[limits[j]] = merged
    return [(p, rank, n) for p in positives
            for rank, n in enumerate((n for n in upto[-p[0]] if -n[0] * 100 >= -p[0] * low), 1)]


def mined(rows: DataFrame, every: int = 100, k: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for the anchors (id divisible by ``every``) among ``rows``
    (id, label, vec). Negative scores lie within ``low`` to 100 percent of the
    positive's."""
    uid = F.xxhash64("id", "label", "vec")
    rows = written(rows.withColumns({"uid": uid, "place": F.monotonically_increasing_id()}), "rows")
    anchors = written(rows.where(F.col("id") % every == 0).groupBy("id", "uid").agg(
        F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")), "anchors")
    key = ["anchor_id", "uid"]
    named = anchors.withColumnRenamed("id", "anchor_id")

    near = scored(anchors.withColumn("limits", F.lit(None).cast("array<long>")), rows, k, low).select(
        *key, F.struct((-F.col("score")).alias("down"), "unnamed", "id").alias("x"))
    own = named.where("copies > 1").select(  # the anchor's copies are other rows
        *key, F.explode(F.array_repeat(F.struct((-F.aggregate(
            "vec", F.lit(0).cast("long"), lambda s, v: s + v * v)).alias("down"), F.lit(False).alias("unnamed"),
            F.col("anchor_id").alias("id")), F.least(F.col("copies") - 1, F.lit(k)).cast("int"))).alias("x"))
    positives = written(near.unionByName(own).groupBy(*key).agg(
        F.slice(F.array_sort(F.collect_list("x")), 1, k).alias("positives")), "positives")

    limited = anchors.join(positives.withColumnRenamed("anchor_id", "id"), ["id", "uid"]).withColumn(
        "limits", F.sort_array(F.array_distinct(F.transform("positives", lambda p: -p["down"])), asc=False))
    slots = scored(limited, rows, k, low).repartition(*key).groupBy(*key, "slot").agg(_first(k).alias("top"))
    slots = slots.groupBy(*key).agg(F.collect_list(F.struct("slot", "top")).alias("slots"))
    joined = slots.join(positives, key).join(named.select(*key, "copies"), key)

    def answers(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                tuples = lambda xs: [(x["down"], x["unnamed"], x["id"]) for x in xs]
                found = windows(tuples(r["positives"]), {s["slot"]: tuples(s["top"]) for s in r["slots"]}, k, low)
                out += [(r["anchor_id"], p[2], rank, n[2], -p[0], -n[0]) for p, rank, n in found for _ in range(r["copies"])]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, kinds)],
                                             ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return joined.mapInArrow(answers, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def query(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``."""
    return mined(usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND NOT list_contains(list_transform(embedding, lambda x: isfinite(x)), FALSE)
), scores AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same,
         CAST(list_sum(list_transform(list_zip(a.vec, r.vec), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM rows a JOIN rows r ON r.id <> a.id
  WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor_id, id, score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

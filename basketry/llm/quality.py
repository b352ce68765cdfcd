"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: single tokens, pairs of tokens, and
triples of token shapes (case, digits, the symbols themselves, and whether a
token repeats the one before it), hashed into 2**18 columns. Each indicator is
scaled by the log ratio of its shares in the two classes, and a linear
hinge-loss model is fitted to the scaled, length-normalised rows by dual
coordinate descent. A logistic curve fitted to rows held back from the descent
turns margins into scores.

The model is fitted on at most ``sample_rows`` labelled rows, those with the
smallest hashes of their ids, and at most ``sample_bytes`` of their features
(4 bytes each; rows that would go beyond are passed over). It has one weight a
column and goes to all tasks. Every document is scored by its whole text,
however long.

Edge cases: labels are joined by doc_id, null labels and ids are left out, a
document with several labels counts with the lowest; null texts are empty and
get the score of the intercept; without labels of both classes the score is
the share of label 1 (0.5 without labels); repeated rows are scored alike;
further columns are left out.
"""

from __future__ import annotations

import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import plain_text, ship, worker_state

ship(__name__)

COLUMNS = 1 << 18
SAMPLE_ROWS, SAMPLE_BYTES = 16_000, 512 << 20
CUT = 0.3
FOLDS = 5
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Tokens that a worker keeps (about 50 MB): its process outlives the stage.
MOST_CACHED = 250_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def _coded(token: str) -> int:
    """crc32 of the token, above 16 bits that stand for its shape."""
    if token[0].isalpha():
        shape = 1 if token.islower() else 2 if token.isupper() and len(token) > 1 else 3 if token[1:].islower() or len(token) == 1 else 4
    elif token[0].isdigit():
        shape = 5
    else:
        shape = 16 + zlib.crc32(token.encode()) % 8000
    return zlib.crc32(token.encode()) << 16 | shape


def features(text: str, cache: dict) -> np.ndarray:
    """The columns of a text's indicators, sorted and distinct."""
    tokens = TOKEN.findall(text)
    if not tokens:
        return np.zeros(0, np.int32)
    if len(cache) > MOST_CACHED:
        cache.clear()
    codes = []
    for t in tokens:
        code = cache.get(t)
        if code is None:
            code = cache[t] = _coded(t)
        codes.append(code)
    codes = np.array(codes, np.uint64)
    word, shape = codes >> np.uint64(16), codes & np.uint64(0xFFFF)
    shape[1:] |= (word[1:] == word[:-1]).astype(np.uint64) << np.uint64(15)
    pair = (word[:-1] * MIX) ^ (word[1:] + np.uint64(1) << np.uint64(32))
    triple = (shape[:-2] << np.uint64(32) | shape[1:-1] << np.uint64(16) | shape[2:]) ^ np.uint64(0xABCDEF << 40)
    grams = np.unique(np.concatenate([word, pair, triple]))
    return np.unique(((grams * MIX) >> np.uint64(46)).astype(np.int32))


def fitted(rows: list[np.ndarray], labels: np.ndarray, columns: int = COLUMNS, cost: float = 1.0,
           passes: int = 12, seed: int = 7) -> tuple[np.ndarray, float, float, float]:
    """(weight of each scaled indicator, intercept, slope, shift): the score is
    1 / (1 + exp(-(slope * margin + shift)))."""
    share = float(labels.mean()) if len(labels) else 0.5
    weight = np.zeros(columns, np.float32)
    if not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return weight, 0.0, 0.0, float(np.log(share / (1 - share)))
    counts = np.ones((2, columns))
    for r, y in zip(rows, labels):
        counts[int(y), r] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())

    def row(r):
        x = ratio[r]
        return x / max(1e-9, np.sqrt(x @ x))

    sign = np.where(labels > 0, 1.0, -1.0)
    caps = cost * np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    order = np.random.default_rng(seed).permutation(len(rows))
    held, used = order[::5], np.delete(order, np.arange(0, len(order), 5))
    if len(set(labels[used])) < 2 or len(set(labels[held])) < 2:
        held = used = order
    w, bias, alpha = np.zeros(columns), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed + 1)
    for _ in range(passes):
        for i in rng.permutation(used):
            r = rows[i]
            x = row(r)  # again in each pass, so that only the columns' numbers are kept
            slack = sign[i] * (w[r] @ x + bias) - 1
            new = min(max(alpha[i] - slack / 2, 0.0), caps[i])  # rows have length 1, and 1 for the intercept
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[r] += step * x
                bias += step
                alpha[i] = new
    margin = np.array([w[rows[i]] @ row(rows[i]) + bias for i in held])
    y, slope, shift = labels[held].astype(float), 1.0, 0.0
    for _ in range(200):  # the logistic curve, by damped Newton steps
        p = 1 / (1 + np.exp(-(slope * margin + shift)))
        q = p * (1 - p)
        gradient = np.array([((p - y) * margin).sum() + 1e-2 * slope, (p - y).sum()])
        hessian = np.array([[(q * margin * margin).sum() + 1e-2, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-6]])
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        slope, shift = slope - move[0], shift - move[1]
    return np.stack([w * ratio, ratio * ratio]).astype(np.float32), float(bias), float(slope), float(shift)


def score(row: np.ndarray, model: tuple) -> float:
    weight, bias, slope, shift = model
    if weight.ndim == 1:
        margin = 0.0
    else:
        margin = bias + (float(weight[0, row].sum()) / max(1e-9, float(weight[1, row].sum()) ** 0.5) if len(row) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30))))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(FOLDS)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> tuple:
    """The model, from labelled rows that are not held out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("y"))
             .where(F.col("label_id").isNotNull() & F.col("y").isNotNull() & ~held_out("label_id"))
             .groupBy("label_id").agg(F.min("y").alias("y")))
    known = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)  # at most 16 bytes a row
    texts = (docs.select("doc_id", plain_text().alias("text"))
             .join(F.broadcast(known), F.col("doc_id") == F.col("label_id")).select("doc_id", "y", "text"))

    def run(batches):
        cache = worker_state("quality")
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([features(t, cache).tobytes() for t in batch.column(3).to_pylist()], pa.binary())],
                ["place", "doc_id", "y", "row"])

    def fit(batches):
        found, size = [], 0
        for batch in batches:
            for doc_id, y, row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if len(found) < sample_rows and size + len(row) <= sample_bytes:
                    found.append((doc_id, row, y))
                    size += len(row)
        found.sort()
        model = fitted([np.frombuffer(r, np.int32) for _, r, _ in found], np.array([int(y > 0) for *_, y in found]))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # the sample is fitted in one task, in the order of its hashes; only the weights go to the driver
    rows = texts.select(F.xxhash64(F.col("doc_id").cast("long")).alias("place"), F.col("doc_id").cast("long"), "y", "text").mapInArrow(
        run, "place long, doc_id long, y int, row binary")
    model = rows.repartition(1).sortWithinPartitions("place", "doc_id").mapInArrow(fit, "model binary").first()
    return pickle.loads(model[0]) if model else fitted([], np.zeros(0, int))


def scored(docs: DataFrame, model: tuple) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two floats a column

    def run(batches):
        cache, own = worker_state("quality"), shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([score(features(t, cache), own) for t in batch.column(2).to_pylist()], pa.float64())],
                ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(), plain_text())
    return (rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0)))


def accepted(docs: DataFrame, model: tuple) -> DataFrame:
    """The rows of ``docs`` with predicted 1, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        cache, own = worker_state("quality"), shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([score(features(t or "", cache), own) >= CUT for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

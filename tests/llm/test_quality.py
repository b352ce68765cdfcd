import zlib

import numpy as np

from basketry.llm import quality as q
from conftest import SF_MID
from llm_cases import clashing, frame, rows, table


def test_held_out_accuracy(spark):
    label = {r[0]: r[1] for r in table(SF_MID, "labels")}
    got = {r["doc_id"]: r for r in q.query(spark, SF_MID).collect()}
    assert len(got) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    held = [(got[i]["predicted"], y) for i, y in label.items() if got[i]["held_out"]]
    assert len(held) > 50 and sum(p == y for p, y in held) / len(held) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    from pyspark.sql import functions as F
    other = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = q.train(docs, labels), q.train(docs, other)
    assert (a[0] == b[0]).all() and a[1:] == b[1:]


def test_edges(spark):
    docs = clashing(frame(spark), score=1, quality=0, label_id=5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(17)] + [(None, 1), (3, None), (3, 1)], "doc_id long, quality int")
    got = q.scored(docs, q.train(docs, labels)).collect()
    assert len(got) == len(rows()) and all(0 < r["score"] < 1 for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    none = q.scored(docs, q.train(docs, labels.limit(0))).collect()
    assert {round(r["score"], 6) for r in none} == {0.5}
    ones = q.scored(docs, q.train(docs, labels.where("quality = 1"))).collect()
    assert {r["predicted"] for r in ones} == {1}
    assert q.scored(docs.limit(0), q.train(docs, labels)).count() == 0
    assert q.accepted(docs, q.train(docs, labels.limit(0))).count() == len(rows())


def test_solver_against_the_primal(spark):
    """Weak duality: the dual's value never exceeds the primal's, and at the
    optimum they meet; the weights against a dense subgradient descent."""
    rng = np.random.default_rng(5)
    labels = np.array([i % 2 for i in range(60)])
    rows = [np.unique(np.r_[rng.integers(0, 12, 5), 20 + 3 * y + rng.integers(0, 2, 1)]).astype(np.int32) for y in labels]
    model = q.fitted(rows, labels, columns=32, passes=400)
    order = np.random.default_rng(7).permutation(len(rows))
    used = np.delete(order, np.arange(0, len(order), 5))
    counts = np.ones((2, 32))
    for r, y in zip(rows, labels):
        counts[y, r] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    x = np.zeros((60, 33))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r] / np.sqrt((ratio[r] ** 2).sum())
        x[i, 32] = 1
    sign, caps = np.where(labels > 0, 1.0, -1.0), np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    loss = lambda w: 0.5 * w @ w + (caps[used] * np.maximum(0, 1 - sign[used] * (x[used] @ w))).sum()
    w, best, mean = np.zeros(33), np.inf, np.zeros(33)
    for t in range(1, 20_001):
        out = sign[used] * (x[used] @ w) < 1
        w -= (w - (caps[used] * sign[used] * out) @ x[used]) / t
        mean += (w - mean) * 2 / (t + 1)
        best = min(best, loss(mean))
    ours = np.r_[np.divide(model[0][0].astype(float), ratio, out=np.zeros(32), where=ratio != 0), model[1]]
    assert loss(ours) <= best * 1.001 + 1e-6


def test_the_sample_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, "good words here " * (2000 if i < 3 else 1) if i % 2 else f"bad {i} stuff", "en", "s", 1)
                                  for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    whole, part = q.train(docs, labels), q.train(docs, labels, sample_bytes=200)
    assert not np.array_equal(whole[0], part[0])
    assert q.train(docs, labels, sample_bytes=0)[3] == 0.0  # no rows: the share is one half

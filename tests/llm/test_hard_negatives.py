import math
from collections import Counter

import duckdb
import pytest

from basketry.llm import hard_negatives as hn
from conftest import SF_MID
from llm_cases import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5, low=80, flip=7):
    """Definition, row against row. rows: (id, vector, label)."""
    fine = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, (label + 1) % 10 if i is not None and i % flip == 0 else label, [math.floor(256 * x) for x in v]))
    rank = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for n, (a, label, v) in enumerate(fine):
        if a is None or a % every:
            continue
        others = [(sum(x * y for x, y in zip(v, w)), i, m) for j, (i, m, w) in enumerate(fine) if j != n]
        for p in sorted((x for x in others if x[2] == label), key=rank)[:k]:
            fits = sorted((x for x in others if x[2] != label and low * p[0] <= 100 * x[0] <= 100 * p[0]), key=rank)[:k]
            out += [(a, p[1], r, x[1], p[0], x[0]) for r, x in enumerate(fits, 1)]
    return Counter(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(map(tuple, df.collect()))


def test_table_against_definition_and_sql(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF_MID}/embeddings.parquet'").fetchall()
    found = got(hn.query(spark, SF_MID))
    assert found and found == brute(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{SF_MID}/embeddings.parquet'")
    assert found == Counter(duckdb.sql(hn.SQL).fetchall())


def hard_rows():
    """Ties, equal vectors, copies of an anchor, nulls, odd lengths, one label
    with most rows, negative and zero scores, large components."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, (i % 5) / 4, -(i % 3) / 8], 1 if i % 3 else 2) for i in range(0, 240)]
    rows += [(100, [1.0, 0.0, -0.125], 1)] * 3 + [(0, [0.0, 0.0, 0.0], 5), (300, [], 3), (301, [], 3), (302, [], 4)]
    rows += [(None, [1.0, 0.5, 0.25], 1), (None, [1.0, 0.5, 0.25], 2), (400, None, 1), (500, [1.0, None, 2.0], 1), (600, [nan, 1.0, 1.0], 1),
             (700, [1.0, inf, 1.0], 1), (800, [1.0, 1.0, 1.0], None), (900, [-1.0, -1.0, -1.0], 7), (901, [1.0], 8), (902, [1.0, 1.0, 1.0, 9.0], 8)]
    rows += [(1000, [3000.0, 1.0, 2.0], 9), (1001, [2900.0, 1.0, 2.0], 9), (1002, [2800.0, 1.0, 2.0], 8), (1003, [1e7, 0.0, 0.0], 4)]
    return rows


@pytest.mark.parametrize("group", [16 << 20, 700])
def test_hard_rows(spark, group, monkeypatch):
    monkeypatch.setattr(hn, "GROUP_BYTES", group)
    monkeypatch.setattr(hn, "BLOCK_SCORES", 50 if group == 700 else 1 << 21)
    rows = hard_rows()
    df = clashing(spark.createDataFrame(rows, SCHEMA), uid=1, slot="x", score=2.0, id=3, vec="v", place=0)
    assert got(hn.mined(hn.usable(df))) == brute(rows)


def test_empty(spark):
    assert hn.mined(hn.usable(spark.createDataFrame([], SCHEMA))).count() == 0
    assert hn.mined(hn.usable(spark.createDataFrame([(100, [1.0], 1), (101, [1.0], 2)], SCHEMA))).count() == 0


def test_hot_vector(spark):
    """Two thirds of the rows share vector and label: results by definition,
    and a task passes on at most k rows of an anchor's slot."""
    rows = [(i, [0.5, 0.5] if i % 3 else [0.1 * (i % 7), 0.3], 1 if i % 3 else i % 4 + 2) for i in range(1800)]
    df = hn.usable(spark.createDataFrame(rows, SCHEMA)).cache()
    assert got(hn.mined(df)) == brute(rows)
    rows = df.selectExpr("*", "xxhash64(id, label, vec) uid", "monotonically_increasing_id() place")
    anchors = rows.where("id % 100 = 0").selectExpr("id", "uid", "label", "vec", "cast(null as array<long>) limits")
    passed = hn.scored(anchors, rows, 5, 80).groupBy("anchor_id", hn.F.spark_partition_id()).count()
    assert passed.agg({"count": "max"}).first()[0] <= 5

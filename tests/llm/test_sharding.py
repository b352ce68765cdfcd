import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from basketry.llm import sharding as sh
from conftest import SF_MID
from llm_cases import clashing, frame, rows, texts


def _check(data, got, shards):
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (repr(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in data)
    places = defaultdict(list)
    for r in got:
        assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        places[r["shard"]].append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_table(spark):
    got = sh.query(spark, SF_MID).collect()
    _check(texts(SF_MID), got, 40)
    total = defaultdict(int)
    for r in got:
        total[r["shard"]] += r["size"]
    assert len(total) == 40 and max(total.values()) < 1.05 * min(total.values())


def test_edges(spark):
    docs = clashing(frame(spark), slot=1, shard="x", nth=2)
    sizes = sh.slot_sizes(docs)
    _check([(i, t) for i, t, *_ in rows()], sh.assign(docs, sh.dealt(sizes, 3), sizes).collect(), 3)
    none = sh.slot_sizes(frame(spark, []))
    assert sh.assign(frame(spark, []), sh.dealt(none, 3), none).count() == 0


def test_versions_move_few_slots_and_are_stored(spark, tmp_path):
    sizes = [(100 + s % 17, 1) for s in range(4096)]
    first = sh.dealt(sizes, 40)
    second = sh.rebalanced(first, sizes, 41)
    moved = [s for s in range(4096) if first[s] != second[s]]
    assert {second[s] for s in moved} == {40} and len(moved) < 4096 / 41 * 1.2
    total = defaultdict(int)
    for s, k in enumerate(second):
        total[k] += sizes[s][0]
    assert max(total.values()) < 1.05 * min(total.values())
    sh.store_map(spark, str(tmp_path / "map"), [first, second])
    assert sh.stored_map(spark, str(tmp_path / "map")) == second and sh.stored_map(spark, str(tmp_path / "map"), 1) == first


def test_no_python_in_the_plan(spark, capsys):
    sh.query(spark, SF_MID).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_a_hot_id_keeps_the_law(spark):
    """A third of the rows without an id: shards stay near equal, and no
    virtual slot (which one task numbers) holds much more than its share."""
    data = [(None if i % 3 == 0 else i, f"text {i} " + "x" * (i % 50)) for i in range(30_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sizes = sh.slot_sizes(docs)
    got = sh.assign(docs, sh.dealt(sizes, 40), sizes).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(got) == 40 and max(r["n"] for r in got) < 1.05 * min(r["n"] for r in got)
    assert max(rows for _, rows in sizes) < 40

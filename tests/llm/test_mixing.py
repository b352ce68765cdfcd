from collections import Counter, defaultdict

from basketry.llm import mixing as mx
from conftest import SF_MID
from llm_cases import clashing, frame, rows, split, table


def _check(data, got, tolerance):
    """data: (doc_id, text, source)."""
    size = Counter()
    for _, t, s in data:
        size[s] += len(split(t))
    want = {s: (n, t) for s, n, t in mx.targets(list(size.items()))}
    taken = defaultdict(int)
    assert sorted(((r["doc_id"], r["size"], r["source"]) for r in got), key=repr) == sorted(
        ((i, len(split(t)), s) for i, t, s in data), key=repr)
    for r in got:
        assert (r["source_size"], r["target"]) == want[r["source"]] and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, (_, target) in want.items():
        assert abs(taken[s] - target) <= max(tolerance * target, 40), (s, taken[s], target)


def test_targets():
    got = mx.targets([("b", 10), (None, 10), ("a", 1000), ("c", 0)])
    assert [s for s, *_ in got] == ["a", "b", "c", None]
    assert [t for *_, t in got] == [1020.0 - 30 - 30, 30.0, 0.0, 30.0]
    assert mx.targets([]) == [] and mx.targets([("x", 0)]) == [("x", 0, 0.0)]
    even = mx.targets([("a", 80), ("b", 80), ("c", 80)])
    assert [round(t, 6) for *_, t in even] == [150.0, 60.0, 30.0]


def test_table(spark):
    data = [(r[0], r[1], r[3]) for r in table(SF_MID)]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    first = mx.mixed(docs).collect()
    _check(data, first, 0.01)
    again = mx.mixed(docs.repartition(5)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in first) == sorted((r["doc_id"], r["taken"]) for r in again)


def test_schedule_starts_are_near_the_shares(spark):
    sources = mx.plan([("a", 5000), ("b", 3000), ("c", 9000)], block_words=10)
    slots = [r["source_at"] for r in mx.schedule(spark, sources).orderBy("slot").collect()]
    share = [s.target / s.block for s in sources]
    for n in (10, 100, 1000, len(slots)):
        for k in range(3):
            assert abs(slots[:n].count(k) - n * share[k] / sum(share)) < 5


def test_edges(spark):
    docs = clashing(frame(spark), size=1, target="x", part=2, name="n", block=3)
    _check([(i, t, s) for i, t, _, s, _ in rows()], mx.mixed(docs).collect(), 0.02)
    assert mx.mixed(frame(spark, [])).count() == 0
    assert {r["taken"] for r in mx.mixed(frame(spark, [(1, None, "en", None, 0), (2, " ", "en", "s", 1)])).collect()} == {0}


def test_blocks_do_not_depend_on_other_corpora():
    small, large = mx.plan([("a", 5000), ("b", 900)]), mx.plan([("a", 5000), ("b", 900), ("c", 900_000_000)])
    assert [(s.block, s.blocks) for s in small] == [(s.block, s.blocks) for s in large[:2]]

import corpus_pipeline as cp
from basketry.llm import mixing, quality, simhash
from basketry.llm.shared import written
from conftest import SF_SMALL
from llm_cases import LONG, SCHEMA, clashing, frame, rows, split

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _all(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = written(cp.good(spark, docs, SF_SMALL), "q")
    scores = {r["doc_id"]: r["predicted"] for r in quality.query(spark, SF_SMALL).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, p in scores.items() if p) and kept.columns == COLUMNS

    owners = {}
    for r in kept.collect():
        key = bytes((r["text"] or "").encode()).translate(None, b" \t\n\x0b\f\r")
        owners.setdefault(key, []).append((-len(r["text"] or ""), r["doc_id"]))
    distinct = written(cp.distinct(spark, kept, SF_SMALL), "d")
    assert sorted(r["doc_id"] for r in distinct.collect()) == sorted(min(v)[1] for v in owners.values())

    different = written(cp.different(spark, distinct, SF_SMALL), "s")
    groups = {r["component_id"] for r in simhash.near_duplicates(distinct).collect()}
    assert sorted(r["doc_id"] for r in different.collect()) == sorted(groups) and different.columns == COLUMNS

    mixed = written(cp.mixed(spark, different, SF_SMALL), "m")
    words = {}
    for r in mixed.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(split(r["text"]))
        assert r["n_chars"] == len(r["text"])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(different).collect()}
    assert words == {i: n for i, n in taken.items() if n} and mixed.columns == COLUMNS

    assert sum(r["length"] for r in cp.sequences(spark, mixed, SF_SMALL).collect()) > 1000


def test_mixed_texts_are_beginnings_of_their_originals(spark):
    texts = {i: "".join(f"w{i}_{k}" + " \t\n\r\x0b\x0c"[(i + k) % 6] * (1 + k % 3) for k in range(30 + i)) for i in range(40)}
    docs = frame(spark, [(i, " " * (i % 3) + t, "en", f"s{i % 3}", len(t) + i % 3) for i, t in texts.items()])
    original = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = cp.mixed(spark, docs, SF_SMALL).collect()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs).collect()}
    words, parts = {}, 0
    for r in got:
        assert original[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(split(r["text"]))
        parts += r["text"] != original[r["doc_id"]]
    assert words == {i: n for i, n in taken.items() if n} and parts


def test_run_and_rerun(spark):
    a, b = (cp.run(spark, SF_SMALL) for _ in range(2))
    assert a.select("doc_id").distinct().count() > 50
    assert a.groupBy("doc_id").sum("length").exceptAll(b.groupBy("doc_id").sum("length")).count() == 0


def test_awkward_rows(spark):
    docs = clashing(frame(spark), kept="x", size=3, root=1, copies=2)
    columns = docs.columns
    out = cp.distinct(spark, docs, SF_SMALL)
    assert out.columns == columns
    got = _all(out.select("doc_id", "text"))
    # of the three equal texts the longest stays; one of the repeated row; one empty text, the longest
    assert [r for r in got if r[0] in (0, 1, 2)] == [(1, rows()[1][1])] and len([r for r in got if r[0] == 9]) == 1
    assert [r[0] for r in got if not (r[1] or "").strip()] == [5] and [r[0] for r in got if r[0] in (13, 14, 15)] == [14]
    assert len([r for r in got if r[0] is None]) == 2 and len([r for r in got if r[0] == 10]) == 2
    out = cp.different(spark, docs, SF_SMALL)
    got = _all(out.select("doc_id", "text"))
    assert out.columns == columns and len([r for r in got if r[0] == 9]) == 1 and [r[0] for r in got if r[0] in (0, 1, 2)] == [0]
    assert len([r for r in got if r[1] in (LONG, LONG + " end")]) == 1
    assert cp.mixed(spark, docs, SF_SMALL).columns == columns and cp.mixed(spark, docs, SF_SMALL).count() > 0
    assert cp.good(spark, docs, SF_SMALL).columns == columns
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in cp.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0, name

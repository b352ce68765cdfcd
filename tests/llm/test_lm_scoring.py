import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from basketry.llm import attention as net
from basketry.llm import lm_scoring as lm
from conftest import SF_MID
from llm_cases import clashing, frame, rows, split, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(data, got):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    count = Counter()
    for i, t in data:
        if not held(i):
            count.update([*split(t), None])
    whole, distinct = sum(count.values()), len(count)
    want = []
    for i, t in data:
        words = [*split(t), None]
        base = sum(np.log10((count[w] + 0.1) / (whole + 0.1 * (distinct + 1))) for w in words)
        want.append((i, held(i), len(words), sum(count[w] > 0 for w in words), whole, round(base, 5)))
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 5)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_table(spark):
    """Counts by brute force, and held-out texts likelier than by the base."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = lm.scored(docs, PATH, steps=800).collect()
    _check(texts(SF_MID), got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_edges(spark):
    docs = clashing(frame(spark), kind=1, block=2, score="x", id=3)
    _check([(i, t) for i, t, *_ in rows()], lm.scored(docs, PATH, steps=5).collect())
    assert lm.scored(frame(spark, []), PATH, steps=5).count() == 0


def _weights():
    rng = np.random.default_rng(0)
    w = net.start(rng.permutation(net.SPACE))
    return {k: v if k == "place" else v * 8 for k, v in w.items()}


def test_probabilities_sum_to_one():
    w, x = _weights(), np.tile(np.arange(net.LENGTH, dtype=np.int32), (net.SPACE, 1))
    y = np.tile(np.arange(net.SPACE, dtype=np.int32)[:, None], (1, net.STRIDE))
    assert np.allclose(net.probability(w, x, y).sum(axis=0), 1, atol=1e-3)


def test_causal_and_windows_score_each_place_once():
    w, rng = _weights(), np.random.default_rng(1)
    line = rng.integers(0, net.SPACE - 2, 100).astype(np.int32)
    x, y, counts = net.windows([line], net.SPACE - 2)
    assert counts.sum() == 101 and y[counts].tolist() == [*line, net.SPACE - 2]
    p = net.probability(w, x, y)
    changed = line.copy()
    changed[60:] = 5
    x2, y2, _ = net.windows([changed], net.SPACE - 2)
    assert np.allclose(p[counts][:60], net.probability(w, x2, y2)[counts][:60])


def test_gradient():
    w, rng = _weights(), np.random.default_rng(2)
    w = {k: v if k == "place" else v.astype(np.float64) for k, v in w.items()}
    x, y, counts = net.windows([rng.integers(0, 50, 70).astype(np.int32)], net.SPACE - 2)
    loss, g = net.gradient(w, x, y, counts)
    assert abs(loss + np.log(net.probability(w, x, y)[counts]).mean()) < 1e-3
    for name in ("E", "Q", "K", "V", "O", "D", "C", "M"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        step = 1e-3
        moved = {k: v.copy() for k, v in w.items()}
        moved[name][at] += step
        up = net.gradient(moved, x, y, counts)[0]
        moved[name][at] -= 2 * step
        assert abs((up - net.gradient(moved, x, y, counts)[0]) / (2 * step) - g[name][at]) < 0.02 * abs(g[name][at]) + 1e-4, name


def test_every_training_id_is_dealt_once(spark, monkeypatch):
    """All documents and all of a long one, over many parts and rounds."""
    monkeypatch.setattr(lm, "CHUNK", 64)
    long = " ".join(f"w{i % 977}" for i in range(150_000))  # over 96,000 ids
    data = [(i, t) for i, t, *_ in rows()] + [(1000 + i, f"short text {i}") for i in range(2500)] + [(5001, long)]
    docs = spark.createDataFrame([(i, t or "") for i, t in data], "doc_id long, text string").repartition(3)
    model = (np.arange(lm.IDS) % (net.SPACE - 2)).astype(np.int32)
    folder = lm.dealt(docs, model, 12, 4, PATH)
    ids, want, n = lm.worker_ids(PATH), np.zeros(net.SPACE, np.int64), 0
    for i, t in data:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            line = model[np.frombuffer(ids.of(t or ""), "<u4")]
            want += np.bincount(line, minlength=net.SPACE)
            n += 1
    want[net.SPACE - 2] += n
    table = spark.read.parquet(folder).collect()
    got = np.zeros(net.SPACE, np.int64)
    for r in table:
        _, y, counts = net.unpacked_windows(lm.expanded(r["payload"])[0], net.SPACE - 2)
        got += np.bincount(y[counts], minlength=net.SPACE)
    assert (got == want).all()
    assert {r["round"] for r in table} == {0, 1, 2, 3} and all(r["part"] % 4 == r["round"] for r in table)


def test_steps_grow_with_the_training_ids(spark, monkeypatch):
    """More parts, more rounds; averaged weights still beat the base."""
    monkeypatch.setattr(lm, "PART_IDS", 150_000)
    turns, averaged = [], lm.averaged
    monkeypatch.setattr(lm, "averaged", lambda *a: turns.append(averaged(*a)) or turns[-1])
    got = lm.scored(spark.read.parquet(f"{SF_MID}/documents.parquet"), PATH, steps=300).where("held_out").collect()
    assert len(turns) > 1 and turns[-1][0] >= 300 * 0.8
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_every_place_sees_nine_ids():
    """The id eight places before the last one still counts at every place."""
    w, rng = _weights(), np.random.default_rng(4)
    line = rng.integers(0, net.SPACE - 2, 60).astype(np.int32)
    x, y, counts = net.windows([line], net.SPACE - 2)
    p = net.probability(w, x, y)[counts]
    for place in range(9, 60):
        changed = line.copy()
        changed[place - 9] = (changed[place - 9] + 1) % (net.SPACE - 2)
        x2, y2, _ = net.windows([changed], net.SPACE - 2)
        assert net.probability(w, x2, y2)[counts][place] != p[place], place


def test_pairs_of_one_frequent_id_are_spread():
    """A third of the pairs begin with one id, a third end with it."""
    rng = np.random.default_rng(1)
    other = rng.permutation(lm.IDS)[:20_000].astype(np.uint32)
    pairs = np.unique(np.concatenate([np.uint32(7) * np.uint32(lm.IDS) + other, other * np.uint32(lm.IDS) + np.uint32(7),
                                      other * np.uint32(lm.IDS) + np.roll(other, 1)]))
    for buckets in (8, 64, 1000):
        bucket = lm._pair_bucket(pairs, buckets)
        assert bucket.min() >= 0 and np.bincount(bucket, minlength=buckets).max() < 2 * len(pairs) / buckets


def test_texts_are_read_and_split_once(spark):
    """Sizing reads the texts, then one pass splits them; dealing and scoring
    go by the stored lines, which hold the ids of every document."""
    from pyspark.sql import functions as F
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    data = rows() + [(100 + i, f"some words of text {i}", "en", "s", 20) for i in range(600)]
    docs = frame(spark, data).withColumn("text", F.udf(seen, "string")("text"))
    _check([(i, t) for i, t, *_ in data], lm.scored(docs, PATH, steps=5).collect())
    assert read.value <= 2 * len(data)
    docs = frame(spark, data).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines, _, tokens = lm.gathered(docs, 7, PATH)
    ids, got = lm.worker_ids(PATH), []
    for r in lines.collect():
        flat, size, held, own, null, n_tokens, *_ = lm.expanded(r["payload"])
        each = np.split(flat, np.cumsum(size)[:-1])
        got += [(None if no else int(i), x.tolist(), bool(h), int(n)) for i, no, x, h, n in zip(own, null, each, held, n_tokens)]
    want = [(i, np.frombuffer(ids.of(t or ""), "<u4").tolist(), lm.is_held_out(i), len(split(t)) + 1) for i, t, *_ in data]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert tokens == sum(n for _, _, h, n in want if not h)


def test_odd_weights_stay_finite():
    """Logits far beyond the range of exp still give probabilities."""
    w, rng = _weights(), np.random.default_rng(6)
    w = {k: v if k == "place" else v * (300 if k in "CM" else 1) for k, v in w.items()}
    x, y, counts = net.windows([rng.integers(0, 50, 70).astype(np.int32)], net.SPACE - 2)
    p = net.probability(w, x, y)
    assert np.isfinite(p).all() and (p <= 1.001).all()
    loss, g = net.gradient(w, x, y, counts)
    assert np.isfinite(loss) and all(np.isfinite(a).all() for a in g.values())


def test_words_travel_once_a_unit(spark, monkeypatch):
    """Rows by bucket go by units of many blocks, not by blocks; the blocks'
    lines are whatever the unit is."""
    from pyspark.sql import functions as F
    data = rows() + [(100 + i, f"some words of text {i} and {i % 7}", "en", "s", 20) for i in range(3000)]
    docs = frame(spark, data).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).coalesce(1)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(lm, "SLICE_ROWS", 20)
    got = {}
    for unit in (1, 1 << 30):
        monkeypatch.setattr(lm, "UNIT_BYTES", unit)
        kinds = [r["kind"] for r in spark.read.parquet(lm.blocked(docs, 5)).select("kind").collect()]
        lines, pairs, tokens = lm.gathered(docs, 5, PATH)
        blocks = sorted(tuple(np.asarray(x).tolist() for x in lm.expanded(r["payload"])) for r in lines.collect())
        sums = Counter()
        for r in pairs.collect():
            sums.update(dict(zip(*(x.tolist() for x in lm.expanded(r["payload"])))))
        got[unit] = blocks, sums, tokens, kinds.count(lm.DOCS), kinds.count(lm.WORDS)
    assert got[1][:4] == got[1 << 30][:4] and got[1][3] > 20
    assert got[1 << 30][4] <= 5 < 20 < got[1][4]


def test_rows_by_bucket_at_10_gb_of_text():
    """Their number is that of units by buckets, 2,560 by 2,560 before."""
    assert (10 << 30) ** 2 / lm.UNIT_BYTES / lm.BUCKET_BYTES < 250_000


def _naive(w, x, y):
    """Next ids' probabilities place by place, in 64 bits."""
    w = {k: v if k == "place" else v.astype(np.float64) for k, v in w.items()}
    out = np.empty(y.shape)

    def share(logits, at):
        return np.exp(logits[at] - logits.max()) / np.exp(logits - logits.max()).sum()

    for i, line in enumerate(x):
        for j in range(net.STRIDE):
            at = net.CONTEXT + j
            seen = line[:at + 1]
            a = w["K"][seen] @ w["Q"][line[at]] * net.HEAD ** -0.5 + w["D"][at - np.arange(at + 1)]
            a = np.exp(a - a.max())
            h = np.append(w["E"][line[at]] + a / a.sum() @ w["V"][seen] @ w["O"], 1)
            c, m = divmod(int(w["place"][y[i, j]]), net.CLASSES)
            out[i, j] = share(h @ w["C"], c) * share(h @ w["M"][c], m)
    return out


def test_probability_by_definition():
    """The tables of single ids and pairs give what the definition gives; so does
    the training step, and attention far beyond the range of exp is finite."""
    rng = np.random.default_rng(7)
    x, y, counts = net.windows([rng.integers(0, net.SPACE - 2, 70).astype(np.int32), rng.integers(0, 9, 5).astype(np.int32)], net.SPACE - 2)
    for odd in (1, 60):
        w = {k: v if k == "place" else v * (odd if k in "QK" else np.float32(0.25)) for k, v in _weights().items()}
        want = _naive(w, x, y)
        assert np.allclose(net.probability(w, x, y), want, rtol=2e-3, atol=1e-9), odd
        loss, g = net.gradient(w, x, y, counts)
        assert abs(loss + np.log(want[counts]).mean()) < 1e-2 and all(np.isfinite(v).all() for v in g.values()), odd


def test_sums_by_id():
    rng = np.random.default_rng(8)
    ids, grads = rng.integers(0, 90, 700).astype(np.uint16), rng.normal(size=(700, 16)).astype(np.float32)
    want = np.zeros((net.SPACE, 16))
    np.add.at(want, ids, grads.astype(np.float64))
    assert np.allclose(net._scatter(ids, grads), want, atol=1e-4)

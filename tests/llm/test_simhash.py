import numpy as np
import pytest
import xxhash

from basketry.llm import simhash as sh
from basketry.llm.components import components, forest
from conftest import SF_SMALL
from llm_cases import clashing, frame, rows, split, texts


def brute_fingerprint(text, size=4):
    words = split(text)
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(data, most=4):
    """(doc_id, fingerprint) -> component id."""
    prints = [brute_fingerprint(t) for _, t in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(data)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= most:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(data):
        groups.setdefault(find(i), []).append(doc_id)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((doc_id, f"{prints[i]:016x}", least[find(i)]) for i, (doc_id, _) in enumerate(data)), key=repr)


def test_table(spark):
    got = sorted(map(tuple, sh.query(spark, SF_SMALL).collect()), key=repr)
    assert got == brute(texts(SF_SMALL))


def test_edges(spark):
    got = sorted(map(tuple, sh.near_duplicates(clashing(frame(spark), fp=1, root=2, component_id="x")).collect()), key=repr)
    assert got == brute([(i, t or "") for i, t, *_ in rows()])
    assert sh.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("most", [3, 4, 5])
@pytest.mark.parametrize("hashed", [64, 6])
def test_links_keep_every_component(most, hashed):
    rng = np.random.default_rng(most)
    centres = rng.integers(0, 1 << 62, 12, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres:
        for _ in range(25):
            fps.add(int(c) ^ sum({1 << int(b) for b in rng.integers(0, 56, rng.integers(1, 7))}))
    fp = np.array(sorted(fps), np.uint64)
    low = 56  # all in one range would need equal leading bits: deal as links() does
    radius = (most + 1) // 2
    pairs = []
    flips = [(int(m), radius - k) for k, masks in enumerate(sh._flips(8, radius)) for m in masks]
    ranges = {}
    for i, f in enumerate(fp.tolist()):
        for m, left in flips:
            ranges.setdefault((f >> low) ^ m, []).append((i, left))
    for own in ranges.values():
        index, left = np.array([x[0] for x in own]), np.array([x[1] for x in own])
        a, b = sh.colliding(fp[index], left, low, most)
        pairs += list(zip(index[a], index[b]))
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    near = np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= most)
    assert (forest(len(fp), a, b) == forest(len(fp), near[:, 0], near[:, 1])).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300, 301), (301, 300), (5, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_range_is_split(spark, monkeypatch):
    """Fingerprints that agree in their leading 16 bits: no group writes out
    more than VARIANTS variants, and the components are the same."""
    rng = np.random.default_rng(7)
    base = (0xBEEF << 48) + rng.integers(0, 1 << 20, 300, dtype=np.uint64) * np.uint64(1 << 20)
    fp = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 30), base ^ np.uint64(1 << 63)]))
    near = np.argwhere(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4)
    want = forest(len(fp), near[:, 0], near[:, 1])
    monkeypatch.setattr(sh, "VARIANTS", 20_000)
    sizes, colliding = [], sh.colliding

    def counted(own, left, low, most):
        sizes.append(sum(sum(sh.math.comb(low, k) for k in range(n + 1)) for n in left.tolist()))
        return colliding(own, left, low, most)
    monkeypatch.setattr(sh, "colliding", counted)
    a, b = sh.split_links(fp, np.full(len(fp), 2), 0, 4)
    assert max(sizes) <= 20_000 and (forest(len(fp), a, b) == want).all()
    monkeypatch.setattr(sh, "colliding", colliding)
    monkeypatch.setattr(sh, "HOT", 1_000_000)
    dealt, ranges_of = [], sh.ranges_of
    monkeypatch.setattr(sh, "ranges_of", lambda *x: dealt.append(x[1:3]) or ranges_of(*x))
    found = sh.links(spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp long")).collect()
    at = {int(x): i for i, x in enumerate(fp.view(np.int64))}
    a, b = (np.array([at[r[c]] for r in found], np.int64) for c in "ab")
    assert dealt and (forest(len(fp), a, b) == want).all()

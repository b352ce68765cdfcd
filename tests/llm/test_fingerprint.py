import hashlib

import numpy as np

from basketry.llm import fingerprint as fp
from conftest import SF_SMALL
from llm_cases import LONG, clashing, frame, texts


def test_span_equality_and_common_extension():
    a, b = fp.Prefixes.of("xxabcabcabcz"), fp.Prefixes.of("abcabcabcy")
    assert a.equal(2, b, 0, 9) and not a.equal(2, b, 0, 10) and a.equal(2, a, 5, 6)
    assert a.common_extension(2, b, 0) == 9 and a.common_extension(0, b, 0) == 0 and a.common_extension(2, a, 5) == 6
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("ab"), 300))
    p = fp.Prefixes.of(text)
    for i, j in rng.integers(0, 300, (60, 2)):
        n = 0
        while max(i, j) + n < 300 and text[i + n] == text[j + n]:
            n += 1
        assert p.common_extension(int(i), p, int(j)) == n


def test_likeness():
    a, b = fp.Fingerprint("some text that is long enough to have spans"), fp.Fingerprint("another one altogether, with its own words")
    assert fp.likeness(a, a) == 1.0 and fp.likeness(a, b) < 0.2
    assert fp.likeness(fp.Fingerprint(""), fp.Fingerprint("")) == 1.0 and fp.likeness(fp.Fingerprint(""), a) == 0.0
    whole = len(LONG)
    assert 0.6 < fp.likeness(fp.Fingerprint(LONG), fp.Fingerprint(LONG[:2 * whole // 3])) < 0.67
    assert fp.likeness(fp.Fingerprint(LONG), fp.Fingerprint("at the front " + LONG)) > 0.9


def _check(data, got):
    """data: (doc_id, text) in the order of next documents."""
    assert len(got) == len(data)
    by_key = {}
    for r in got:
        by_key.setdefault((r["doc_id"], r["edited_sha256"], r["n_chars"]), []).append(r)
    for k, (doc_id, text) in enumerate(data):
        following = data[(k + 1) % len(data)][1]
        cut = len(text) // 3
        other = text[:len(text) - cut] + following[:cut]
        r = by_key[(doc_id, hashlib.sha256(other.encode()).hexdigest(), len(text))][0]
        own, changed = fp.Fingerprint(text), fp.Fingerprint(other)
        assert (r["fingerprint"], r["edited_fingerprint"]) == (str(own), str(changed))
        assert r["near_edited"] == fp.likeness(own, changed)


def test_table_over_many_ranges(spark):
    data = texts(SF_SMALL)[::-1]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for ranges in (1, 7, 500):
        got = fp.fingerprints(docs, ranges).collect()
        _check(data, got)
        for r, (_, following) in zip(sorted(got, key=lambda r: -r["doc_id"]), data[1:] + data[:1]):
            assert r["near_next"] == fp.likeness(fp.Fingerprint(dict(data)[r["doc_id"]]), fp.Fingerprint(following))


def test_an_id_of_a_third_of_all_rows_is_split(spark):
    """Null ids and one id, a third of the rows each: no range gets more than
    a few times its share, and every row is the next of one row."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text {i} of many, with some words") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r["count"] for r in fp.ranged(docs, 30).groupBy("range").count().collect()]
    assert sum(sizes) == 3000 and len(sizes) > 25 and max(sizes) < 3 * 3000 / 30
    keys = {(r["doc_id"], r["text"]): r["key"] for r in fp.ranged(docs, 30).collect()}
    ordered = sorted(rows, key=keys.get, reverse=True)
    assert [i for i, _ in ordered] == sorted((i for i, _ in rows), key=lambda i: -(1 << 63) if i is None else i, reverse=True)
    for ranges in (30, 200):
        _check(ordered, fp.fingerprints(docs, ranges).collect())


def test_repeated_rows(spark):
    """Any of them may come first: all have the same result but the last."""
    rows = [(1, "one and the same text")] * 50 + [(0, "another")]
    _check(rows, fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect())


def test_fingerprint_by_big_integers():
    """The whole text's hash, and its span hashes, as sums of plain integers."""
    for text in ("", "a", "abc abd", "één ünïcode tekst 漢字 😀 " * 9, LONG[:3000]):
        p = fp.Prefixes.of(text)
        for i, n in ((0, len(text)), (len(text) // 3, len(text) // 2)):
            n = min(n, len(text) - i)
            for j in range(max(0, len(text) - n - 5), len(text) - n + 1):
                want = text[i:i + n] == text[j:j + n]
                plain = lambda at: tuple(sum(ord(c) * pow(b, k, m) for k, c in enumerate(text[at:at + n])) % m
                                         for m, b in zip(fp.PRIMES, fp.BASES))
                assert (plain(i) == plain(j)) == want == p.equal(i, p, j, n)


def test_edges(spark):
    from llm_cases import rows
    got = fp.fingerprints(clashing(frame(spark), range=1, place=2, closing=True)).collect()
    assert len(got) == len(rows()) and all(0 <= r["near_next"] <= 1 and r["edited_sha256"] for r in got)
    one = fp.fingerprints(frame(spark, [(1, "only one text", "en", "s", 13)])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert one[0]["edited_sha256"] == hashlib.sha256(b"only one only").hexdigest()
    assert fp.fingerprints(frame(spark, [])).count() == 0
    unique = [(5, "aaa"), (4, ""), (3, "xyz"), (2, "é" * 10)]
    _check(unique, fp.fingerprints(frame(spark, [(i, t, "en", "s", 0) for i, t in unique])).collect())

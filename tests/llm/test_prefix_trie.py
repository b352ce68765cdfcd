import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from basketry.llm import prefix_trie as pt
from conftest import SF_MID
from llm_cases import LONG, clashing

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Definition: a dict of prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0, digest), (role, text)))
    convs = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    members = defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c / 20) * 20  # the remainder has the id's sign
        turns = (convs.get(base) or [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns)))
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode().split()) if p else 0
    return Counter((min(m)[0], len(p), min(members[p[:-1]])[0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c, n in sorted(m) if n == len(p)).encode()).hexdigest())
                   for p, m in members.items())


def got(df):
    assert df.columns == [c.split()[0] for c in pt.NODE.split(", ")]
    return Counter(map(tuple, df.collect()))


def test_table_against_definition_and_sql(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_MID}/conversations.parquet'").fetchall()
    found = got(pt.query(spark, SF_MID))
    assert len(found) > 300 and found == brute(rows)
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM '{SF_MID}/conversations.parquet'")
    assert found == Counter(duckdb.sql(pt.SQL).fetchall())


def hard_rows():
    """Equal conversations, prefixes of others, one text in many, turnless
    ones, nulls, ties of turns, repeated rows, negative ids, long texts."""
    r = random.Random(3)
    rows = [(c, t, r.choice("ua"), r.choice(["a b", "c", "", None, "d  e\tf"])) for c in range(-45, 300) for t in range(r.randint(1, 5))]
    rows += [(c, t, "s", "one and the same") for c in range(1000, 1400) for t in range(3)]
    rows += [(2000 + c, t, "s", "deep") for c in range(4) for t in range(60 + 20 * c)]
    rows += [(None, 1, "u", "nobody"), (3000, None, "u", "first"), (3000, None, None, None), (3000, 5, "u", "tie"), (3000, 5, "a", "tie"),
             (3000, 5, "a", "tie"), (3001, 1, "u", LONG), (3001, 2, "u", LONG), (1 << 40, 0, "u", "far")]
    return rows


@pytest.mark.parametrize("block", [1 << 16, 7, 1])
def test_hard_rows(spark, block, monkeypatch):
    """Also with blocks of few rows, so that most nodes span some."""
    monkeypatch.setattr(pt, "BLOCK_ROWS", block)
    rows = hard_rows()
    df = clashing(spark.createDataFrame(rows, SCHEMA), depth=1, node="x", seq="y", part=3, words=0)
    assert got(pt.trie(pt.rebuilt(pt.conversations(df)))) == brute(rows)


def test_empty_and_one(spark):
    of = lambda rows: got(pt.trie(pt.rebuilt(pt.conversations(spark.createDataFrame(rows, SCHEMA)))))
    assert not of([]) and not of([(None, 1, "u", "x")])
    for rows in ([(0, 0, "u", "x y")], [(5, 0, "u", "x")], [(1, 0, "u", ""), (2, 0, "u", "")]):
        assert of(rows) == brute(rows)


def test_copies_are_dealt_over_ranges(spark):
    """A third of the conversations are equal: they are split by id."""
    rows = [(c, 0, "u", "same" if c % 3 == 0 else f"own {c}") for c in range(3000)]
    sizes = [r["count"] for r in pt.placed(pt.rebuilt(pt.conversations(spark.createDataFrame(rows, SCHEMA)))).where(
        "side = 1").groupBy("part").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 2.5 * 3000 / len(sizes)


def test_extents_by_definition():
    import numpy as np
    r = random.Random(1)
    for n in (1, 2, 3, 17, 64):
        lcp = np.array([0] + [r.randint(0, 4) for _ in range(n - 1)], np.int64)
        row, depth = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(6)))
        left, right = pt.extents(pt.sparse(lcp), row, depth)
        for i, d, a, b in zip(row, depth, left, right):
            x = y = i
            while x > 0 and lcp[x] >= d:
                x -= 1
            while y + 1 < n and lcp[y + 1] >= d:
                y += 1
            assert (a, b) == (x, y)

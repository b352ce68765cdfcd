import hashlib

import duckdb
import numpy as np

from basketry.llm import exact_dedup as ed
from conftest import SF_SMALL
from llm_cases import clashing, frame, rows


def brute(data):
    groups = {}
    for i, t in data:
        t = t or ""
        groups.setdefault("".join(c for c in t if c not in " \t\n\x0b\f\r"), []).append((-len(t), i is None, i or 0))
    out, done = [], set()
    for i, t in data:
        t = t or ""
        key = "".join(c for c in t if c not in " \t\n\x0b\f\r")
        own, best = (-len(t), i is None, i or 0), min(groups[key])
        kept = own == best and key not in done
        done |= {key} if kept else set()
        out.append((i, None if best[1] else best[2], len(groups[key]), kept, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_edges(spark):
    got = ed.exact_duplicates(clashing(frame(spark), keep_id="x", kept=3, part=1, payload=2)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got), key=repr) \
        == brute([(i, t) for i, t, *_ in rows()])
    assert ed.exact_duplicates(frame(spark, [])).count() == 0


def test_oracle(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    want = duckdb.sql(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ed.SQL})").fetchall()
    assert sorted(map(tuple, ed.query(spark, SF_SMALL).collect())) == sorted(want)


def test_trie_spills_by_subtree():
    rng = np.random.default_rng(2)
    keys = [bytes(rng.choice(list(b"ab"), int(rng.integers(0, 60)))) for _ in range(2000)]
    keys += [b"shared prefix " * 20 + bytes([x, y]) for x in range(40) for y in range(10)] + [b"shared prefix " * 20]
    for most in (500, 5_000, 1 << 30):
        trie, want = ed.Trie(most), {}
        for n, key in enumerate(keys):
            owner = ((-(n % 7), False, n), 1, 1)
            trie.insert(key, owner)
            want[key] = ed.better(want[key], owner) if key in want else owner
        assert bool(trie.spilled) == (most < 1 << 20)
        found = list(trie.owners())
        assert len(found) == len(want) and dict(found) == want

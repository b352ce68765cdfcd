import hashlib

import numpy as np
import pytest

from basketry.llm import suffix_dedup as sd
from conftest import SF_SMALL
from llm_cases import clashing, frame, rows, texts


def brute(data):
    """data: (doc_id, text) in order."""
    seen, out = set(), []
    for doc_id, text in data:
        text = (text or "").encode()
        gone = bytearray(len(text))
        for s in range(len(text) - 99):
            if text[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            else:
                seen.add(text[s:s + 100])
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(1 for r in bytes(gone).split(b"\0") if r)
        out.append((doc_id, len(text), len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _rows(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in df.collect()), key=repr)


def _order(data):
    return sorted(data, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))


def test_table(spark):
    got = sorted(map(tuple, sd.query(spark, SF_SMALL).collect()), key=repr)
    assert got == brute(texts(SF_SMALL)) and sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("hot", [0, 2, 20_000])
def test_shared_passages(spark, hot):
    """Lines that many documents share with their own text around them, near
    copies, periodic texts and overlaps; also with every anchor hot."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefgh ij\u00e9"), n))
    line, passage = word(130), word(400)
    data = [(i, word(int(rng.integers(0, 150))) + line[int(rng.integers(0, 9)):] + word(int(rng.integers(0, 150)))) for i in range(30)]
    data += [(100 + i, passage[:200] + word(i % 3) + passage[200:]) for i in range(12)]
    data += [(200, "ab" * 300), (201, "ba" * 90), (202, "x" * 99), (203, "x" * 100), (204, "x" * 101), (205, "x" * 350), (206, passage * 3),
             (207, "\0" * 120), (208, "\0" * 120 + "z")]
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in data])
    assert _rows(sd.deduplicated(docs, hot)) == brute(_order(data))


def test_edges(spark):
    data = [(i, t) for i, t, *_ in rows()]
    assert _rows(sd.deduplicated(clashing(frame(spark), block=1, payload="x", kept=2))) == brute(_order(data))
    assert sd.deduplicated(frame(spark, [])).count() == 0


def test_spans_and_kept_bytes_make_the_text(spark):
    text = dict(texts(SF_SMALL))
    for r in sd.deduplicated(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect():
        whole = text[r["doc_id"]].encode()
        at, kept = 0, b""
        for i, j in r["spans"]:
            assert at <= i < j and (i > at or at == 0)
            kept, at = kept + whole[at:i], j
        assert kept + whole[at:] == bytes(r["kept"])

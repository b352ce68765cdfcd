import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from basketry.llm import packing as pk
from conftest import SF_SMALL
from llm_cases import clashing, frame, rows, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(data, pieces, context=2048):
    tokenizer = Tokenizer.from_file(PATH)
    ids = [(i, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for i, t in data]
    sequences, documents = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        documents[p["doc_id"]].append(p)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= context and at & (at - 1) == 0  # no padding
    for doc_id in {i for i, _ in ids}:
        own = [x for i, x in ids if i == doc_id]
        assert sum(p["length"] for p in documents[doc_id]) == sum(map(len, own))
        if len(own) == 1:
            at = 0
            for p in sorted(documents[doc_id], key=lambda p: p["start"]):
                assert p["start"] == at and p["doc_tokens"] == len(own[0])
                assert p["ids_crc32"] == zlib.crc32(own[0][at:at + p["length"]].tobytes())
                at += p["length"]


def test_table(spark):
    pieces = pk.query(spark, SF_SMALL).collect()
    _check(texts(SF_SMALL), pieces)
    assert len(pieces) < 2.2 * len(texts(SF_SMALL))


def test_edges(spark):
    docs = clashing(frame(spark), start=1, tier=2, step=3)
    for n in (1, 4):
        _check([(i, t) for i, t, *_ in rows()], pk.packed(docs.repartition(n), PATH).collect())
    _check([(i, t) for i, t, *_ in rows()], pk.packed(docs, PATH, context=64, least=8).collect(), 64)
    assert pk.packed(frame(spark, []), PATH).count() == 0


def test_cached_words_give_the_tokenizers_ids():
    tokenizer, ids = Tokenizer.from_file(PATH), pk.Ids(PATH)
    for text in ["It's they're 12,5 a.b c...d E.U. ﬁne İstanbul Straße ΣΑΣ don't!? <|endoftext|> x<|endoftext|>y", "a\u00a0b c\u3000d",
                 "e\u0301 \u0301x 漢字かな 😀👍🏽 ª µ ÿ Ÿ", *(t for _, t in texts(SF_SMALL)[:40])]:
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert ids.of(text) == want, text


def test_steps_hold_equal_numbers_of_ids(spark):
    steps = defaultdict(int)
    tier = {}
    for p in pk.packed(spark.read.parquet(f"{SF_SMALL}/documents.parquet").coalesce(1), PATH, step_ids=8192).collect():
        steps[p["step"]] += p["length"]
        tier[p["step"]] = p["tier"]
    for t in set(tier.values()):
        own = [n for s, n in sorted(steps.items()) if tier[s] == t]
        assert all(n == 8192 for n in own[:-1])


def test_an_earlier_operators_words_are_dropped(spark):
    """A worker that has run the quality stage starts packing without its cache."""
    def run(batches):
        import pyarrow as pa
        from basketry.llm.shared import forget, worker_state
        worker_state("quality")["word"] = 1
        forget("quality")
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(worker_state("quality"))], pa.int64())})
    assert {r["n"] for r in spark.range(4).mapInArrow(run, "n long").collect()} == {0}

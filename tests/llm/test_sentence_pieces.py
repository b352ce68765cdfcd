import functools
import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import sentence_pieces as sp
from conftest import SF_MID
from llm_cases import clashing, frame, rows, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@functools.cache
def _shared():
    return sp.Pieces(PATH)


@pytest.fixture
def pieces():
    return _shared()


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_table(spark, pieces):
    """Every row against the library."""
    want = []
    for i, text in texts(SF_MID):
        ids = pieces.library.encode(text)
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(pieces.library.decode(ids)), True, True))
    got = sp.query(spark, SF_MID)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_edges(spark, pieces):
    got = sp.encoded(clashing(frame(spark), ids=1, same_ids="x"), PATH).collect()
    assert len(got) == len(rows())
    want = sorted((repr(i), pieces.library.encode(t or "")) for i, t, *_ in rows())
    assert sorted((repr(r["doc_id"]), r["ids"]) for r in got) == want
    assert all(r["same_ids"] and r["same_text"] for r in got)
    assert sp.encoded(frame(spark, []), PATH).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t▁aetheron.,!=é漢😀\x000<>"), st.characters(exclude_categories=["Cs"])), max_size=120))
def test_any_text(text):
    pieces = _shared()
    ids = pieces.library.encode(text)
    assert pieces.encode(text) == ids and pieces.decode(ids) == pieces.library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(3, 31_999), st.integers(3, 258)), max_size=12))
def test_any_ids(ids):
    assert _shared().decode(ids) == _shared().library.decode(ids)


def test_long_stretches_and_forgetting(pieces, monkeypatch):
    """A word of 200,000 characters, and a worker that forgets all the time."""
    r = random.Random(5)
    text = "".join(r.choice("abcdefgh漢") for _ in range(200_000))
    assert pieces.encode(text) == pieces.library.encode(text)
    monkeypatch.setattr(sp, "MOST_HELD", 3)
    many = [" ".join("".join(r.choice("etaoin") for _ in range(r.randint(1, 70))) for _ in range(50)) for _ in range(20)]
    assert [i.tolist() for i in pieces.encode_all(many)] == pieces.library.encode(many)


def test_heap_and_rows_agree(pieces):
    r = random.Random(7)
    words = [" " * r.randint(0, 1) + "".join(r.choice("etaoinsh") for _ in range(r.randint(1, 40))) for _ in range(500)]
    assert pieces.together(words) == [sp.np.array(pieces.merged(w), "<i4").tobytes() for w in words]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    spec = pb.ModelProto.FromString(open(PATH, "rb").read())
    spec.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError):
        sp.Pieces(str(tmp_path / "m"))

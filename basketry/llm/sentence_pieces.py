"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs that are pieces, ordered by
score, then by place. The best pair is merged and its new neighbours join the
agenda; pairs of symbols that have changed since count no more. What is left
are pieces, or characters that are none and become their UTF-8 bytes' pieces.

A text falls into stretches at places that no piece spans (a word sign after
another character), so merges of different stretches cannot meet: each
stretch has an agenda of its own. A batch's short stretches that the worker
has not seen yet are worked off together, one row of an array each: a round
takes every row's best pair. Long stretches, and those with characters that
are no pieces, have their agenda in a heap (n log n). A text's ids are those
of its stretches, which a worker keeps.

Decoding joins the pieces, byte pieces as UTF-8 with a replacement character
for each byte that is not, and drops the leading word sign.

Each Arrow batch is encoded and decoded by the sentencepiece library as well:
``same_ids`` and ``same_text`` say whether a row agrees. The other columns
hold what is computed here.

Edge cases: null and empty texts have no ids and decode to the empty text;
null ids of documents are kept; repeated rows give repeated rows; very long
texts and very long stretches without any word sign are encoded whole; control
pieces' names in a text are plain text; an empty table gives an empty one;
further columns are left out. Models that are not of merge type, normalise the
text, or have user-defined pieces are refused.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import plain_text, ship, sliced, worker_state

ship(__name__)

SIGN = "▁"
#: Stretches that a worker keeps, characters of long ones among them, the
#: longest stretch that is worked off with others, and how many at once.
MOST_HELD, MOST_LONG, MOST_TOGETHER, TOGETHER = 600_000, 4 << 20, 64, 20_000
DEAD = np.iinfo(np.int32).max
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Pieces:
    """The vocabulary of a model file, with ``encode`` and ``decode``."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        with open(path, "rb") as file:
            model = file.read()
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        self.library = SentencePieceProcessor(model_proto=model)
        rules = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback:
            raise ValueError("not a merge-type vocabulary with byte pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model normalises its text")
        if any(p.type in (USER_DEFINED, UNUSED) for p in spec.pieces):
            raise ValueError("the model has user-defined or unused pieces")
        # a space stands for the word sign: texts and stretches stay compact strings
        self.prefix = " " if rules.add_dummy_prefix else ""
        self.pieces = {p.piece.replace(SIGN, " "): (p.score, i) for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN)
        self.surface = [spec.trainer_spec.unk_surface if p.type == UNKNOWN else "" if p.type == CONTROL else p.piece for p in spec.pieces]
        self.bytes_of = {i: b for b, i in self.byte.items()}
        self.inside = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        # a stretch begins at a word sign after another character, where no piece has that
        inner = any(pair[1] == " " != pair[0] for pair in self.inside)
        self.stretch = re.compile("[^\n]+|\n" if inner else " *[^ \n]+| +|\n")
        self.held: dict[str, bytes] = {}
        self.long = 0
        self.plain = [s.replace(SIGN, " ").encode() for s in self.surface]
        for i, b in self.bytes_of.items():
            self.plain[i] = bytes([b])
        # the same as arrays: piece of a character, and rank (by score; the best is 0) of a pair of pieces
        self.of_char = np.full(0x110000, -1, np.int32)
        by_score = sorted((-score, i) for score, i in self.pieces.values())
        rank = {i: k for k, (_, i) in enumerate(by_score)}
        self.of_rank = np.array([i for _, i in by_score] + [-1], np.int32)
        pairs = []
        for piece, (_, i) in self.pieces.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = self.pieces.get(piece[:k]), self.pieces.get(piece[k:])
                if left and right:
                    pairs.append((left[1] * len(spec.pieces) + right[1], rank[i]))
        pairs.sort()
        self.keys = np.array([x[0] for x in pairs] + [np.iinfo(np.int64).max], np.int64)
        self.ranks = np.array([x[1] for x in pairs] + [DEAD], np.int32)
        self.count = len(spec.pieces)
        # pieces of one score are told apart by place, which ranks cannot say
        scores = Counter(score for score, _ in self.pieces.values())
        tied = [p for p, (score, _) in self.pieces.items() if scores[score] > 1 and len(p) > 1]
        self.ties = re.compile("|".join(map(re.escape, sorted({p[:2] for p in tied}))) if tied else "(?!)")

    def merged(self, text: str) -> list[int]:
        """Ids of a stretch, by the agenda."""
        whole = self.pieces.get(text)
        if whole and len(text) == 1:
            return [whole[1]]
        pieces, n = self.pieces, len(text)
        symbol = list(text)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            found = pieces.get(text[i:i + 2])
            if found:
                agenda.append((-found[0], i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, length = heapq.heappop(agenda)
            left, right = symbol[i], symbol[j]
            if not left or not right or len(left) + len(right) != length:
                continue  # one of them was merged meanwhile
            symbol[i], symbol[j] = left + right, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = symbol[i] + symbol[k]
                found = pieces.get(pair)
                if found:
                    heapq.heappush(agenda, (-found[0], i, k, len(pair)))
            h = before[i]
            if h >= 0:
                pair = symbol[h] + symbol[i]
                found = pieces.get(pair)
                if found:
                    heapq.heappush(agenda, (-found[0], h, i, len(pair)))
        ids = []
        for s in symbol:
            if s:
                found = pieces.get(s)
                if found:
                    ids.append(found[1])
                else:
                    ids += [self.byte[b] for b in s.encode()]
        return ids

    def parts(self, text: str) -> list[int]:
        """Ids of a stretch: those of its parts between neighbours that no
        piece has."""
        cuts = [k for k in range(1, len(text)) if text[k - 1:k + 1] not in self.inside]
        return [i for a, b in zip([0, *cuts], [*cuts, len(text)]) for i in self.merged(text[a:b])]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair (DEAD: no piece)."""
        key = left.astype(np.int64) * self.count + right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], DEAD)

    def together(self, words: list[str]) -> list[bytes]:
        """Ids of stretches of characters that are pieces, as bytes: an agenda
        in each row, a merge in each row and round."""
        n, size = len(words), np.array([len(w) for w in words])
        wide = int(size.max())
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        used = np.arange(wide) < size[:, None]
        symbol = np.full((n, wide + 1), -1, np.int32)  # the last column ends every row
        symbol[:, :wide][used] = self.of_char[codes]
        after = np.broadcast_to(np.arange(1, wide + 2, dtype=np.int32), (n, wide + 1)).copy()
        before = after - 2
        agenda = np.full((n, wide + 1), DEAD, np.int32)
        pair = used[:, 1:]
        agenda[:, :wide - 1][pair] = self.rank(symbol[:, :wide - 1][pair], symbol[:, 1:wide][pair])
        rows, left = np.arange(n), agenda
        while True:
            place = left.argmin(1)
            best = left[np.arange(len(rows)), place]
            active = best != DEAD
            if not active.all():
                rows, place, best = rows[active], place[active], best[active]
                if not len(rows):
                    break
            gone = after[rows, place]
            behind = np.minimum(after[rows, gone], wide)
            joined = symbol[rows, place] = self.of_rank[best]
            symbol[rows, gone], agenda[rows, gone] = -1, DEAD
            after[rows, place], before[rows, behind] = behind, place
            ahead = before[rows, place]  # -1: none, and then the row's end has no piece
            agenda[rows, place] = self.rank(joined, symbol[rows, behind])
            some = ahead >= 0
            r, p = rows[some], ahead[some]
            agenda[r, p] = self.rank(symbol[r, p], joined[some])
            left = agenda[rows]
        alive = symbol >= 0
        ids, ends = symbol[alive].tobytes(), np.cumsum(alive.sum(1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def learn(self, words) -> None:
        """Keep the ids of ``words`` (not empty)."""
        words = sorted(words, key=len)
        if not words:
            return
        size = np.array([len(w) for w in words])
        missing = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)] < 0
        odd = (np.add.reduceat(missing, np.cumsum(size) - size) > 0) | (size > MOST_TOGETHER)
        odd |= np.array([self.ties.search(w) is not None for w in words])
        for k in np.flatnonzero(odd):
            self.held[words[k]] = np.array(self.parts(words[k]), "<i4").tobytes()
        words = [words[k] for k in np.flatnonzero(~odd)]
        for at in range(0, len(words), TOGETHER):
            some = words[at:at + TOGETHER]
            self.held.update(zip(some, self.together(some)))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out, group, size = [], [], 0
        for text in texts:  # few words are objects at a time
            group.append(text)
            size += len(text)
            if size > 1 << 20:
                out += self._encoded(group)
                group, size = [], 0
        return out + self._encoded(group)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.held) >= MOST_HELD or self.long > MOST_LONG:
            self.held.clear()
            self.long = 0
        words = [self.stretch.findall(self.prefix + t.replace(SIGN, " ")) if t else [] for t in texts]
        held, out, late = self.held.__getitem__, [], []
        for some in words:
            try:
                out.append(b"".join(map(held, some)))
            except KeyError:
                late.append(len(out))
                out.append(b"")
        new = {w for w in set().union(*(words[k] for k in late)) if w not in self.held}
        self.long += sum(len(w) for w in new if len(w) > MOST_TOGETHER)
        self.learn(new)
        for k in late:
            out[k] = b"".join(map(held, words[k]))
        return [np.frombuffer(ids, "<i4") for ids in out]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> str:
        if not len(ids):
            return ""
        raw = b"".join(map(self.plain.__getitem__, ids))
        if self.prefix and self.surface[ids[0]].startswith(SIGN):
            raw = raw[1:]
        out = []
        while True:
            try:
                return "".join([*out, raw.decode()])
            except UnicodeDecodeError as error:  # one replacement for each byte that is no character's
                out += [raw[:error.start].decode(), "\ufffd"]
                raw = raw[error.start + 1:]


def worker_pieces(path: str) -> Pieces:
    state = worker_state("pieces")
    if path not in state:
        state[path] = Pieces(path)
    return state[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, text (decoded), same_ids, same_text of every text."""
    def run(batches):
        pieces = worker_pieces(path)
        for batch in sliced(batches):
            texts = batch.column(1).to_pylist()
            ids = pieces.encode_all(texts)
            lists = [i.tolist() for i in ids]
            decoded = [pieces.decode(i) for i in lists]
            theirs = pieces.library.encode(texts, num_threads=1)
            back = pieces.library.decode(theirs, num_threads=1) if texts else []
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]))),
                 pa.array(decoded, pa.string()),
                 pa.array([a == b for a, b in zip(lists, theirs)], pa.bool_()),
                 pa.array([a == b for a, b in zip(decoded, back)], pa.bool_())],
                ["doc_id", "ids", "text", "same_ids", "same_text"])

    return docs.select(F.col("doc_id").cast("long"), plain_text()).mapInArrow(
        run, "doc_id long, ids array<int>, text string, same_ids boolean, same_text boolean")


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document's ids and their decoded text, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encoded(docs, path or public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"), "same_ids", "same_text")

"""Hierarchical multi-length packing of token ids.

A document is cut into whole windows of ``context`` ids, each a sequence of
its own, and a rest. Rests are routed to the tier of the smallest power of two
that holds them (from ``least`` to ``context``). Tiers are packed from the
longest: a window takes the longest rest of its tier and fills its gap with
the longest rests that fit, which come from shorter tiers; where none fits,
one is cut to the gap and its remainder is routed again. A partition's last,
unfilled window is cut into powers of two, so no sequence needs padding.

Sequences of a tier make step groups of ``step_ids`` ids, so every step costs
the same whatever its tier.

A task packs its own partition as it streams by: no shuffle, and memory for
one batch and the rests that wait. Sequence ids name the partition, so a task
that is run again gives the same rows.

Edge cases: null and empty texts have the end id only; null ids are kept;
rows with one id are documents of their own; an empty table gives an empty
one; further columns are left out.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import forget, plain_text, ship, sliced, worker_state

ship(__name__)

CONTEXT, LEAST, STEP_IDS = 2048, 256, 65_536
END = np.array([1], "<u4").tobytes()
#: Words, and parts of words, that a worker keeps (about 100 MB each).
MOST_CACHED = 600_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "tier int, step long")


class Ids(dict):
    """Word (bytes without white space) -> its ids as little-endian bytes.

    The tokenizer drops white space and splits letters from other characters,
    so a text's ids are those of its words one after the other, and those of a
    word of Latin letters and trailing punctuation are those of its parts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        # the byte-level alphabet: printable bytes stand for themselves, the
        # others for the code points from 256
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        sign = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.signs = {c: "".join(sign[b] for b in chr(c).encode()) for c in range(256)}

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(b".,;:!?")
        letters = core.decode()
        if letters.isalpha() and (letters.isascii() or max(letters) <= "\xff"):
            ids = self.part(letters.lower()) + (self.part(word[len(core):].decode()) if len(core) < len(word) else b"")
        else:
            ids = self.encoded(word.decode())
        if len(self) > MOST_CACHED:
            self.clear()
        self[word] = ids
        return ids

    def part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            if len(self.parts) > MOST_CACHED:
                self.parts.clear()
            # one run of letters or of punctuation is one piece for the
            # tokenizer's model, which is asked directly
            pieces = self.tokenizer.model.tokenize(text.translate(self.signs))
            ids = self.parts[text] = struct.pack(f"<{len(pieces)}I", *[p.id for p in pieces])
        return ids

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, text: str) -> bytes:
        return b"".join([self[w] for w in text.encode().split()])


def worker_ids(path: str) -> Ids:
    state = worker_state("ids")
    if path not in state:
        state[path] = Ids(path)
    return state[path]


class Packer:
    """Packs one partition. Rests wait in stacks by length; ``lengths`` has a
    bit for each length that has any."""

    def __init__(self, partition: int, context: int = CONTEXT, least: int = LEAST, step_ids: int = STEP_IDS):
        self.first, self.context, self.least, self.step_ids = partition << 40, context, least, step_ids
        self.waiting: list[list] = [[] for _ in range(context + 1)]
        self.lengths, self.sequences, self.rows = 0, 0, []
        self.by_tier: dict[int, int] = {}

    def add(self, doc_id, ids: bytes) -> None:
        total, size = len(ids) // 4, self.context
        for start in range(0, total - size + 1, size):
            self.emit([(doc_id, start, ids[4 * start:4 * (start + size)], total)], size)
        if total % size:
            self.route((doc_id, total - total % size, ids[4 * (total - total % size):], total))

    def route(self, rest: tuple) -> None:
        n = len(rest[2]) // 4
        self.waiting[n].append(rest)
        self.lengths |= 1 << n

    def take(self, n: int) -> tuple:
        rest = self.waiting[n].pop()
        if not self.waiting[n]:
            self.lengths &= ~(1 << n)
        return rest

    def longest(self, most: int) -> int:
        """The longest rest of at most so many ids, 0 if there is none."""
        return (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1 if most > 0 and self.lengths & ((1 << (most + 1)) - 1) else 0

    def emit(self, pieces: list, tier: int) -> None:
        at, nth = 0, self.by_tier.get(tier, 0)
        self.by_tier[tier] = nth + 1
        step = self.first | (tier.bit_length() << 34) | nth // max(1, self.step_ids // tier)
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.first + self.sequences, at, tier, step))
            at += n
        self.sequences += 1

    def cut(self, rest: tuple, n: int) -> tuple:
        """The first n ids; the others are routed anew."""
        doc_id, start, ids, total = rest
        self.route((doc_id, start + n, ids[4 * n:], total))
        return doc_id, start, ids[:4 * n], total

    def pack(self, last: bool = False) -> None:
        tier = self.context
        while tier >= self.least:
            lower = tier // 2 if tier > self.least else 0
            while (n := self.longest(tier)) > lower:
                pieces, gap = [self.take(n)], tier - n
                while gap and self.lengths:
                    if n := self.longest(gap):
                        pieces.append(self.take(n))
                    else:  # all that wait are longer: cut the shortest
                        n = (self.lengths & -self.lengths).bit_length() - 1
                        pieces.append(self.cut(self.take(n), gap))
                        n = gap
                    gap -= n
                if gap == 0:
                    self.emit(pieces, tier)
                elif last:
                    self.tail(pieces, tier - gap)
                else:
                    for rest in pieces:
                        self.route(rest)
                    return
            tier //= 2

    def tail(self, pieces: list, total: int) -> None:
        """The partition's last ids, as sequences of powers of two."""
        pieces = pieces[::-1]
        for bit in reversed(range(total.bit_length())):
            if not total >> bit & 1:
                continue
            size, own = 1 << bit, []
            left = size
            while left:
                doc_id, start, ids, n = pieces.pop()
                if len(ids) // 4 > left:
                    pieces.append((doc_id, start + left, ids[4 * left:], n))
                    ids = ids[:4 * left]
                own.append((doc_id, start, ids, n))
                left -= len(ids) // 4
            self.emit(own, size)

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * 9
        self.rows = []
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def packed(docs: DataFrame, path: str, context: int = CONTEXT, least: int = LEAST, step_ids: int = STEP_IDS,
           end: bytes = END) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, tier (the sequence's ids), step (its step group).

    path: the tokenizer's file, on every executor; context and least: powers
    of two; end: the ids that close a document, as bytes.
    """
    def run(batches):
        forget("quality")  # an earlier stage's words, in a worker that ran both
        ids, packer = worker_ids(path), Packer(TaskContext.get().partitionId(), context, least, step_ids)
        for batch in batches:
            for few in sliced([batch]):
                for doc_id, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                    packer.add(doc_id, ids.of(text) + end)
            packer.pack()
            yield packer.flush()
        packer.pack(last=True)
        yield packer.flush()

    return docs.select(F.col("doc_id").cast("long"), plain_text()).mapInArrow(run, SCHEMA)


def query(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """All pieces of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packed(docs, public_tokenizers.path(tokenizer))

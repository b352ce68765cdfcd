"""Exact duplicates by Patricia-trie owners.

Texts are equal when they are the same after deleting white space. The
normalised byte strings go to partitions by length and content hash, copies
within a batch once. A partition inserts the full strings into a compressed
radix trie, whose terminal nodes hold the group's owner (most code points in
the original, then smallest id) and its size. A trie above its memory budget
spills its heaviest subtree to a file, where later strings of that subtree
go as well, and does the file afterwards with a trie of its own.

Only digests travel back: rows find their group's owner in a join that Spark
can split, however many copies a group has.

Edge cases: null texts are empty and equal to texts of white space; null ids
rank after all others; of rows that tie in everything one is kept; an empty
table gives an empty one; further columns are left out.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import tempfile

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import forget, plain_text, ship, shuffle_partitions, text_bytes, written

ship(__name__)

PARTITION_BYTES = 16 << 20
BATCH_BYTES = 16 << 20
TRIE_BYTES = 64 << 20


def normalised(text: str) -> bytes:
    return b"".join(text.encode().split())


def better(x: tuple, y: tuple) -> tuple:
    """The owner of two groups of one text, (-code points, id is null, id),
    and the sums of their rows and of the rows that tie with the owner."""
    (a, rows_a, ties_a), (b, rows_b, ties_b) = x, y
    return min(a, b), rows_a + rows_b, ties_a * (a <= b) + ties_b * (b <= a)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class Node:
    __slots__ = ("label", "below", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label, self.below, self.owner = label, {}, owner


class Trie:
    """Owners of byte strings that agree in their first ``skip`` bytes."""

    def __init__(self, most_bytes: int = TRIE_BYTES, skip: int = 0):
        self.most, self.skip, self.root = most_bytes, skip, Node(b"")
        self.held: dict[int, int] = {}   # bytes below each branch of the root
        self.spilled: dict[int, object] = {}

    def insert(self, key: bytes, owner: tuple) -> None:
        at, node = self.skip, self.root
        branch = key[at] if at < len(key) else -1
        if branch in self.spilled:
            self._append(self.spilled[branch], key, owner)
            return
        while at < len(key):
            child = node.below.get(key[at])
            if child is None:
                node.below[key[at]] = Node(key[at:], owner)
                self._grown(branch, len(key) - at)
                return
            if not key.startswith(child.label, at):
                same = _common(child.label, key[at:at + len(child.label)])
                middle = Node(child.label[:same])
                child.label = child.label[same:]
                middle.below[child.label[0]] = child
                node.below[key[at]] = middle
                child = middle
            at += len(child.label)
            node = child
        node.owner = owner if node.owner is None else better(node.owner, owner)

    def _grown(self, branch: int, size: int) -> None:
        self.held[branch] = self.held.get(branch, 0) + size + 200
        if sum(self.held.values()) > self.most:
            heaviest = max(self.held, key=self.held.get)
            del self.held[heaviest]
            file = self.spilled[heaviest] = tempfile.TemporaryFile()
            for key, owner in self._walk(self.root.below.pop(heaviest), bytes(self.skip)):
                self._append(file, key, owner)

    @staticmethod
    def _append(file, key: bytes, owner: tuple) -> None:
        tail = pickle.dumps(owner)
        file.write(struct.pack("<QI", len(key), len(tail)) + key + tail)

    @staticmethod
    def _walk(node: Node, before: bytes):
        todo = [(node, before)]
        while todo:
            node, before = todo.pop()
            key = before + node.label
            if node.owner is not None:
                yield key, node.owner
            todo.extend((child, key) for child in node.below.values())

    def owners(self, prefix: bytes = b""):
        """(key, owner) of every string; keys begin with ``prefix``, which
        stands for the first ``skip`` bytes."""
        for key, owner in self._walk(self.root, prefix):
            yield key, owner
        for file in self.spilled.values():
            file.seek(0)
            first, shared = None, 0
            for key, _ in self._read(file):
                if first is None:
                    first, shared = key, len(key)
                shared = min(shared, self.skip + _common(first[self.skip:shared], key[self.skip:]))
            below = Trie(self.most, max(shared, self.skip))
            file.seek(0)
            for key, owner in self._read(file):
                below.insert(key, owner)
            file.close()
            yield from below.owners(prefix + first[len(prefix):below.skip])

    @staticmethod
    def _read(file):
        while head := file.read(12):
            n, m = struct.unpack("<QI", head)
            yield file.read(n), pickle.loads(file.read(m))


def _keys(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, text_sha256 of every row."""
    def run(batches):
        forget("quality")  # an earlier stage's words, in a worker that ran both
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(normalised(t)).hexdigest() for t in texts])],
                ["doc_id", "n_chars", "text_sha256"])

    return docs.mapInArrow(run, "doc_id long, n_chars long, text_sha256 string")


def _strings(docs: DataFrame, parts: int) -> DataFrame:
    """part, payload: packed normalised strings with their owner so far."""
    def packed(groups: dict):
        by_part: dict[int, list] = {}
        for key, owner in groups.items():
            part = (len(key) * 0x9E3779B1 ^ xxhash.xxh64_intdigest(key)) % parts
            by_part.setdefault(part, []).append((key, owner))
        squeeze = zstandard.ZstdCompressor(level=1)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(by_part), pa.int32()),
             pa.array([squeeze.compress(pickle.dumps(x)) for x in by_part.values()], pa.binary())], ["part", "payload"])

    def run(batches):
        groups, held = {}, 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key, owner = normalised(t), ((-len(t), i is None, i or 0), 1, 1)
                if key in groups:
                    owner = better(groups[key], owner)
                else:
                    held += len(key)
                groups[key] = owner
                if held > BATCH_BYTES:
                    yield packed(groups)
                    groups, held = {}, 0
        if groups:
            yield packed(groups)

    return docs.mapInArrow(run, "part int, payload binary")


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """text_sha256, keep_id, keep_chars, group_size, ties: one row a text."""
    parts = max(2 * shuffle_partitions(docs.sparkSession), text_bytes(docs) // PARTITION_BYTES)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        trie, expand = Trie(trie_bytes), zstandard.ZstdDecompressor()
        for payload in group["payload"]:
            for key, owner in pickle.loads(expand.decompress(payload)):
                trie.insert(key, owner)
        rows = [(hashlib.sha256(key).hexdigest(), None if null else i, -chars, n, ties)
                for key, ((chars, null, i), n, ties) in trie.owners()]
        out = pd.DataFrame(rows, columns=["text_sha256", "keep_id", "keep_chars", "group_size", "ties"])
        return out.astype({"keep_id": "Int64"})

    return _strings(docs, parts).groupBy("part").applyInPandas(
        run, "text_sha256 string, keep_id long, keep_chars long, group_size long, ties long")


def exact_duplicates(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, n_chars, keep_id, group_size, kept, text_sha256 of every row."""
    docs = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    keys = written(_keys(docs), "keys")
    found = written(owners(docs, trie_bytes), "owners")
    owns = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    rows = keys.join(found, "text_sha256").withColumn("kept", owns)
    if found.where("ties > 1").limit(1).count():  # rows that tie in everything: one of them
        same = Window.partitionBy("text_sha256", "doc_id").orderBy("n_chars")
        tied = F.col("kept") & (F.col("ties") > 1)
        rows = rows.where(~tied).unionByName(
            rows.where(tied).withColumn("kept", F.row_number().over(same) == 1))
    return rows.select("doc_id", "n_chars", "keep_id", "group_size", "kept", "text_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH keyed AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents),
ranked AS (
  SELECT doc_id, body, count(*) OVER (PARTITION BY body) AS group_size,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS nth
  FROM keyed)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(body) AS text_sha256 FROM ranked
"""

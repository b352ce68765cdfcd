"""Prefix trie of conversations from sorted common prefixes.

Conversations become rows of turn digests (16 bytes a turn), sorted as byte
strings over ranges of the whole table. Neighbours' common prefixes (LCPs) and
a sparse table of their minima over all powers of two answer, for each
candidate prefix (a row and a depth) on its own, how far left and right rows
share it: two binary searches over the table's levels, no stack. The interval
found is the prefix's members; the leftmost candidate stands for the node.
Sums over a node's subtree are differences of prefix sums over its interval.

A task works through its range in blocks of at most ``BLOCK_ROWS`` rows and
``BLOCK_TURNS`` turns, and looks one row beyond each side (a range's neighbour
rows are added to it), so every node, word and leaf is counted once. A node
within a block is final; those that span blocks, a path per block border, are
merged by the digest of their prefix, and their children get the merged
parent by a join on (parent, salt). The list of ids that end at a node is
hashed as it streams by in order, never held.

Rebuilding: conversation c starts with the first h turns of conversation
c - c % ``family`` and goes on with its own after its first h, h = crc32(c)
% ``shared``: one join of conversations by that id, at most 2 * ``family`` to
a row.

Edge cases: null roles and texts are empty ones; turns of one number are
ordered by the digest of role and text, repeated rows stay repeated; a
negative id's remainder is negative; rows without a conv_id belong to no
conversation and take no part. An empty table has no conversation that could
be a member, thus no node. Texts of any length are digested on their own; a
conversation is one row of 36 bytes a turn, which bounds the longest one
(some 50 million turns). Further columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import WORD, plain_text, ship, shuffle_partitions, written

ship(__name__)

WIDTH = 16
BLOCK_ROWS, BLOCK_TURNS = 1 << 16, 1 << 19
RANGE_BYTES = 32 << 20
SALTS = 16
RUN_IDS = 512

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
PART = NODE + ", state int, node binary, parent binary, first_end long, ends string"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of digest, words in order): one row each."""
    role, text = plain_text("role"), plain_text("text")
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("int").alias("words")).alias("x"))
    return rows.groupBy("conv_id").agg(F.transform(
        F.sort_array(F.collect_list("x")), lambda x: F.struct(x["digest"].alias("digest"), x["words"].alias("words"))).alias("turns"))


def rebuilt(convs: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """conv_id, seq (digests one after the other), words (of each turn)."""
    base = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    own = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % family})
    joined = own.join(base, "base", "left").select("conv_id", F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(base.schema["head"].dataType)),
        F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    return joined.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda x: F.lower(F.hex(x["digest"]))), "")).alias("seq"),
                         F.transform("turns", lambda x: x["words"]).alias("words"))


def lcps(turns: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Common turns of each row with the one before it (first: 0)."""
    out = np.zeros(len(size), np.int64)
    most = np.minimum(size[1:], size[:-1])
    some = np.flatnonzero(most)
    if len(some):
        lengths = most[some]
        begin = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum()) - np.repeat(begin, lengths)
        same = (turns[np.repeat(start[some], lengths) + at] == turns[np.repeat(start[some + 1], lengths) + at]).all(1)
        out[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(lengths, lengths), at), begin)
    return out


def sparse(values: np.ndarray) -> list[np.ndarray]:
    """Level k: the minimum of every run of 2**k values."""
    levels = [values]
    while 2 << (len(levels) - 1) <= len(values):
        last, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-half], last[half:]))
    return levels


def extents(levels: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row that share the first ``depth`` turns of ``row``:
    binary searches over the levels, each candidate on its own."""
    n = len(levels[0])
    left, right = row.copy(), row.copy()
    for k in reversed(range(len(levels))):
        level, step = levels[k], 1 << k
        ok = right + step < n  # minima over right+1 .. right+step
        ok[ok] = level[right[ok] + 1] >= depth[ok]
        right[ok] += step
        ok = left - step >= 0  # over left-step+1 .. left
        ok[ok] = level[left[ok] - step + 1] >= depth[ok]
        left[ok] -= step
    return left, right


def least(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Minimum over left .. right of the table's values."""
    power = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), np.int64)
    for k in np.unique(power):
        some = power == k
        out[some] = np.minimum(levels[k][left[some]], levels[k][right[some] - (1 << k) + 1])
    return out


def block_nodes(rows: list[tuple], before: tuple | None, after: tuple | None):
    """The nodes of one block of sorted rows (conv_id, seq, words), given the
    rows around it (None at the ends of the table), as columns of PART."""
    lent = [before[1] if before else b"", *[r[1] for r in rows], after[1] if after else b""]
    n, turns = len(rows), np.frombuffer(b"".join(lent), "<u8").reshape(-1, 2)
    size = np.array([len(x) // WIDTH for x in lent], np.int64)
    start = np.cumsum(size) - size
    common = lcps(turns, start, size)
    low, high = common[1], common[n + 1]  # turns shared with the row before, after
    size, start, lcp = size[1:-1], start[1:-1] - start[1], common[1:n + 1].copy()
    nxt = np.r_[lcp[1:], high]
    conv = np.array([r[0] for r in rows], np.int64)
    words = np.concatenate([np.zeros(0, np.int64), *[np.asarray(r[2], np.int64) for r in rows]])
    # sums[start + i + e]: words of the first e turns of row i
    at = start + np.arange(n)
    sums = np.zeros(len(words) + n, np.int64)
    place = np.ones(len(sums), bool)
    place[at] = False
    sums[place] = words
    sums = np.cumsum(sums)
    sums -= np.repeat(sums[at], size + 1)
    whole = sums[at + size]                    # words of the row
    fresh = whole - sums[at + lcp]             # of those nodes that begin at the row
    leaf = (nxt < size) | (np.arange(n) == n - 1) & (after is None)
    run = lambda x: np.r_[0, np.cumsum(x)]     # noqa: E731
    wholes, freshes, leaves = run(whole), run(fresh), run(leaf)

    row = np.repeat(np.arange(n), size + 1)
    depth = np.arange(len(row)) - np.repeat(at, size + 1)
    left, right = extents(sparse(lcp), row, depth)
    own = depth > np.r_[-1 if before is None else low, lcp[1:]][row]  # the node begins at this row, over all blocks
    parent = at[np.r_[0, left[:-1]]] + depth - 1  # the node one turn up, at its leftmost row
    children = np.bincount(parent[own & (depth > 0)], minlength=len(row))

    node = np.flatnonzero(left == row)
    row, depth, right = row[node], depth[node], right[node]
    ids = least(sparse(conv), row, right)
    here = sums[at[row] + np.maximum(depth - 1, 0)]  # words above the node's own turn
    new = np.where(own[node], whole[row] - here, fresh[row])
    saved = wholes[right + 1] - wholes[row] - (right - row + 1) * here - new - (freshes[right + 1] - freshes[row + 1])
    end = np.zeros(n, np.int64)                # last row with the same turns, for each row that begins a run
    twin = np.r_[False, (lcp[1:] == size[1:]) & (size[1:] == size[:-1])]
    first = np.flatnonzero(~twin)
    end[first] = np.r_[first[1:], n] - 1
    spans = (before is not None) & (row == 0) & (depth <= low) | (after is not None) & (right == n - 1) & (depth <= high)
    spanning = np.zeros(len(at) + len(words), bool)
    spanning[node] = spans
    up = parent[node]
    orphan = (depth > 0) & spanning[np.maximum(up, 0)]
    names = {}                                 # row -> digests of its prefixes, as far as asked for

    def name(i, d):
        held = names.setdefault(i, [hashlib.md5()])
        seq = rows[i][1]
        while len(held) <= d:
            more = held[-1].copy()
            more.update(seq[(len(held) - 1) * WIDTH:len(held) * WIDTH])
            held.append(more)
        return held[d].digest()

    ids_of = np.full(len(spanning), -1, np.int64)
    ids_of[node] = ids
    text = conv.astype(str)
    none = hashlib.sha256(b"").hexdigest()
    for k in range(len(node)):
        i, d = int(row[k]), int(depth[k])
        # rows that end at this node lead its interval, unless it began in an earlier block with longer rows
        ended = text[i:end[i] + 1] if size[i] == d else text[:0]
        state = 2 if spans[k] else 1 if orphan[k] else 0
        out = [int(ids[k]), d, int(ids_of[up[k]]) if d and not orphan[k] else None, int(right[k]) - i + 1,
               int(children[node[k]]), int(leaves[right[k] + 1] - leaves[i]), int(saved[k])]
        key = name(i, d) if state == 2 else None
        above = name(i, d - 1) if state and d else None
        if state < 2:
            yield [*out, hashlib.sha256(",".join(ended).encode()).hexdigest() if len(ended) else none, state, key, above, None, None]
            continue
        yield [*out, None, state, key, above, None, None]
        for b in range(0, len(ended), RUN_IDS):
            yield [None, d, None, 0, 0, 0, 0, None, 3, key, None, int(ended[b]), ",".join(ended[b:b + RUN_IDS])]


def placed(convs: DataFrame) -> DataFrame:
    """part, side, conv_id, seq, words: rows sorted over ranges, and for each
    range its neighbours' rows (side 0 before, 2 after)."""
    spark = convs.sparkSession
    convs = written(convs, "conversations")
    wide = int(convs.agg(F.sum(F.octet_length("seq").cast("long") * 2 + 64)).first()[0] or 0)
    parts = max(shuffle_partitions(spark), -(-wide // RANGE_BYTES))
    rows = written(convs.repartitionByRange(parts, "seq", "conv_id").withColumn("part", F.spark_partition_id()), "ranges")
    # one row a range, thus a small window over them
    ends = rows.groupBy("part").agg(F.min(F.struct("seq", "conv_id")).alias("first"), F.max(F.struct("seq", "conv_id")).alias("last"))
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    ends = ends.withColumns({"before": F.lag("last").over(order), "after": F.lead("first").over(order)})
    beside = ends.select("part", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("before").alias("x")), F.struct(F.lit(2).alias("side"), F.col("after").alias("x")))).alias("y"))
    beside = beside.where(F.col("y.x").isNotNull()).select(
        "part", "y.side", "y.x.conv_id", "y.x.seq", F.lit(None).cast("array<int>").alias("words"))
    return rows.select("part", F.lit(1).alias("side"), "conv_id", "seq", "words").unionByName(beside).repartition(
        parts, "part").sortWithinPartitions("part", "side", "seq", "conv_id")


def trie(convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node over ``convs`` (conv_id, seq,
    words)."""
    names = [c.split()[0] for c in PART.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.string()]

    def packed(rows):
        rows = [tuple(r) for r in rows]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def nodes(rows, before, after):
        out = []
        for r in block_nodes(rows, before, after):
            out.append(r)
            if len(out) == 20_000:
                yield packed(out)
                out = []
        if out:
            yield packed(out)

    def run(batches):
        part, before, held, turns = None, None, [], 0
        for batch in batches:
            for p, side, *r in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if p != part:
                    if held:
                        yield from nodes(held, before, None)
                    part, before, held, turns = p, None, [], 0
                if side == 0:
                    before = r
                elif side == 2:
                    yield from nodes(held, before, r)
                    held, before, turns = [], None, 0
                else:
                    if held and (len(held) >= BLOCK_ROWS or turns >= BLOCK_TURNS):
                        yield from nodes(held, before, r)
                        before, held, turns = held[-1], [], 0
                    held.append(r)
                    turns += len(r[2])
        if held:
            yield from nodes(held, before, None)

    found = written(placed(convs).mapInArrow(run, PART), "nodes")
    columns = [c.split()[0] for c in NODE.split(", ")]
    # nodes that span blocks: at most a path for each border
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = found.where("state = 2").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), *sums)
    merged = written(merged.join(ends_hashes(found.where("state = 3")), "node", "left"), "spanning")
    salted = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"), F.explode(
        F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    below = found.where("state = 1").unionByName(merged.where("depth > 0").withColumns(
        {"state": F.lit(1), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))}), allowMissingColumns=True)
    below = below.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")).join(
        salted, ["parent", "salt"]).withColumn("parent_conv_id", F.col("above"))
    root = merged.where("depth = 0").withColumns({
        "parent_conv_id": F.lit(None).cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))})
    return found.where("state = 0").select(*columns).unionByName(below.select(*columns)).unionByName(root.select(*columns))


def ends_hashes(runs: DataFrame) -> DataFrame:
    """node, ends_sha256: the runs of ids of each node, in order, hashed as
    they stream by."""
    def run(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if node != at:
                    if at is not None:
                        out.append((at, state.hexdigest()))
                    at, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([{"node": a, "ends_sha256": b} for a, b in out],
                                             pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))
        if at is not None:
            yield pa.RecordBatch.from_pylist([{"node": at, "ends_sha256": state.hexdigest()}],
                                             pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())]))

    return runs.select("node", "ends", "first_end").repartition("node").sortWithinPartitions(
        "node", "first_end").select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    """Every node of the trie over all rebuilt conversations."""
    return trie(rebuilt(conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


#: CRC-32 of the decimal id, bit by bit (polynomial 0xEDB88320).
SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, list({'k': md5(length(role) || ':' || role || text), 'w': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}
                       ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
  FROM turns GROUP BY conv_id
), hashed AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
    list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda c, j: xor(c >> 1, (c & 1) * 3988292384), xor(crc, b)), 4294967295::BIGINT)) % 4 AS h
  FROM convs
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS t
  FROM hashed c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, len(t) AS turns, unnest(range(len(t) + 1)) AS d, list_transform(t, lambda x: x.k) AS k, list_transform(t, lambda x: x.w) AS w
  FROM rebuilt
), nodes AS (
  SELECT list_slice(k, 1, d) AS p, d, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(w[d]), 0) AS words,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = d), '') AS ends
  FROM prefixes GROUP BY ALL
), children AS (
  SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), above AS (
  SELECT list_slice(u.p, 1, e) AS p, sum((u.n - 1) * u.words) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM nodes) u LEFT JOIN children c USING (p) GROUP BY ALL
)
SELECT v.conv_id, v.d AS depth, f.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(c.n, 0) AS n_children,
       a.leaves AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN above a USING (p) LEFT JOIN children c USING (p)
LEFT JOIN nodes f ON v.d > 0 AND f.p = list_slice(v.p, 1, v.d - 1)
"""

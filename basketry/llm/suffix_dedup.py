"""Repeated byte strings by column-wise suffix sorting of many documents.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier
(in a document with a smaller id, or earlier in the same document) is removed.
Strings never cross documents and are judged on the input.

The collection. Each window of LENGTH bytes has an anchor, the smallest hash
among its GRAM-byte strings (leftmost if equal); equal windows have equal
anchors at equal places. Windows of one anchor follow each other and make a
segment. Anchors that occur once in all documents are left out after a count
over the whole corpus, and the segments of the others meet by anchor.

The sort. A task lays its segments side by side, anchors in one column, and
writes the columns to a file. Then it goes through the columns from the last
to the first, inserting one symbol of every segment a round: a stable sort of
the column in the order so far (the Burrows-Wheeler step) gives the order of
the longer suffixes, and the common prefix of two neighbours is one more than
the least common prefix between them before. As equal windows start in the
same column, suffixes of different columns need no common order; each round's
order is kept in place of a merged one, which saves the passes over all that
earlier rounds have inserted. Neighbours with LENGTH bytes in common are equal
windows; all but the earliest are marked.

Copies of a segment within a block of documents are settled in the block, so
one travels for each block. An anchor with very many different segments (a
line that a large share of the documents has, with their own texts around it)
sends its windows one by one, dealt by the hash of the whole window: what
meets in a task is then a set of equal windows, one for each block.

Edge cases: null texts are empty; texts shorter than LENGTH stay whole; null
ids come after all others; rows with one id are documents of their own, in the
order of their texts; an empty table gives an empty one; further columns are
left out.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame

from basketry.llm.shared import block_rows, blocks_of, expanded, ship, shuffle_partitions, squeezed, text_bytes

ship(__name__)

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM  # an anchor stands at most so far behind its window's start
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
#: Different segments of one anchor from which its windows travel alone.
HOT = 20_000
NULL_ID = (1 << 63) - 1


def _grams(data: np.ndarray) -> np.ndarray:
    """A hash of each GRAM-byte string, by doubling."""
    h, width, base = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), 2 * width
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _pieces(rows: list[tuple]):
    """(first row, texts) in pieces of about PIECE_BYTES; a longer text is a
    piece of its own."""
    first, texts, size = 0, [], 0
    for i, (_, text) in enumerate(rows):
        if texts and size + len(text) > PIECE_BYTES:
            yield first, texts
            first, texts, size = i, [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield first, texts


def _segments(texts: list[bytes]):
    """The joined bytes, and of each segment: row, place of its first window
    in the row and in the joined bytes, windows, place of its anchor in it,
    its anchor's hash, and a hash that tells most different segments apart."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, np.uint64)] * 2
    if len(data) < LENGTH:
        return data, none
    ends = np.cumsum([len(t) for t in texts])
    grams = _grams(data)
    low = np.uint64((1 << 24) - 1)
    starts, anchors = [], []
    for at in range(0, len(data) - LENGTH + 1, 1 << 22):  # places fit in 24 bits
        part = grams[at:at + (1 << 22) + REACH]
        least = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < REACH + 1:
            rest = REACH + 1 - width
            least = np.minimum(least[:len(least) - rest], least[rest:])
        starts.append(np.arange(at, at + len(least)))
        anchors.append((least & low).astype(np.int64) + at)
    start, anchor = np.concatenate(starts), np.concatenate(anchors)
    row = np.searchsorted(ends, start, "right")
    whole = start + LENGTH <= ends[row]
    start, anchor, row = start[whole], anchor[whole], row[whole]
    if not len(start):
        return data, none
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    windows = np.diff(np.append(new, len(start)))
    start, anchor, row = start[new], anchor[new], row[new]
    before = np.concatenate([[0], ends[:-1]])
    apart = grams[start] * np.uint64(3) + grams[start + windows + REACH - 1] + windows.astype(np.uint64)
    return data, [row, start - before[row], start, windows, anchor - start, grams[anchor], apart]


def _counted(group: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """A block's distinct anchors, with how many different segments each has
    and whether it occurs again in the block."""
    rows = block_rows(group["payload"])
    hashes, apart = [], []
    for _, texts in _pieces(rows):
        _, found = _segments(texts)
        hashes.append(found[5])
        apart.append(found[6])
    hashes, apart = np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(apart or [np.zeros(0, np.uint64)])
    order = np.lexsort((apart, hashes))
    hashes, apart = hashes[order], apart[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    other = new | np.concatenate([[True], apart[1:] != apart[:-1]]) if len(hashes) else new
    first = np.flatnonzero(new)
    kinds = np.add.reduceat(other, first, dtype=np.int64) if len(first) else first
    again = np.diff(np.append(first, len(hashes))) > 1
    hashes = hashes[first]
    value = np.minimum(kinds, 1 << 30).astype(np.uint32) * np.uint32(2) + again.astype(np.uint32)
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    block = int(group["block"].iloc[0])
    out = [(int(bucket[o[0]]), block, hashes[o].tobytes() + np.minimum(value[o], 65535).astype(np.uint16).tobytes())
           for o in np.split(order, cuts) if len(o)]
    return pd.DataFrame(out, columns=["bucket", "block", "payload"])


def _repeated(group: pd.DataFrame, hot: int) -> pd.DataFrame:
    """For each block, those of its anchors that occur twice or more in all
    documents; the lowest bit of ``hot`` ones is in a second array."""
    hashes, values, blocks = [], [], []
    for block, payload in zip(group["block"], group["payload"]):
        n = len(payload) // 10
        hashes.append(np.frombuffer(payload, np.uint64, n))
        values.append(np.frombuffer(payload, np.uint16, n, 8 * n))
        blocks.append(np.full(n, block, np.int32))
    hashes, values, blocks = np.concatenate(hashes), np.concatenate(values), np.concatenate(blocks)
    order = np.argsort(hashes, kind="stable")
    hashes, values, blocks = hashes[order], values[order], blocks[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    size = np.diff(np.append(first, len(hashes)))
    again = (size > 1) | (np.bitwise_or.reduceat(values, first) & 1 > 0)
    heavy = np.add.reduceat(values >> 1, first, dtype=np.int64) > hot
    again, heavy = np.repeat(again, size), np.repeat(heavy, size)
    hashes, heavy, blocks = hashes[again], heavy[again], blocks[again]
    order = np.argsort(blocks, kind="stable")
    cuts = np.flatnonzero(np.diff(blocks[order])) + 1
    return pd.DataFrame([(int(blocks[o[0]]), squeezed(hashes[o], heavy[o])) for o in np.split(order, cuts) if len(o)],
                        columns=["block", "payload"])


def _sent(docs: pd.DataFrame, replies: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """A block's distinct segments with repeated anchors, by bucket; spans of
    later copies within the block go along."""
    if not len(replies):
        return pd.DataFrame({"bucket": [], "payload": []})
    rows, block = block_rows(docs["payload"]), int(docs["block"].iloc[0])
    known = [expanded(p) for p in replies["payload"]]
    hashes, heavy = np.concatenate([k[0] for k in known]), np.concatenate([k[1] for k in known])
    order = np.argsort(hashes)
    hashes, heavy = hashes[order], heavy[order]
    seen: set = set()
    out: dict[int, list] = {}
    again: list[tuple] = []
    for first, texts in _pieces(rows):
        data, (row, place, at, windows, offset, anchor, _) = _segments(texts)
        where = np.minimum(np.searchsorted(hashes, anchor), len(hashes) - 1)
        keep = np.flatnonzero(hashes[where] == anchor)
        joined = data.tobytes()
        for r, p, s, w, o, h, alone in zip(*(x[keep].tolist() for x in (row, place, at, windows, offset, anchor)),
                                           heavy[where[keep]].tolist()):
            r += first
            for k in range(w) if alone else (0,):
                n = 1 if alone else w
                string = joined[s + k:s + k + n + LENGTH - 1]
                key = string if alone else (string, o)
                if key in seen:
                    again.append((r, p + k, p + k + len(string)))
                    continue
                seen.add(key)
                bucket = (xxhash.xxh64_intdigest(string) if alone else h) % buckets
                out.setdefault(bucket, []).append((r, p + k, n, 0 if alone else o, string))
    if again:
        out.setdefault(block % buckets, [])
    ids = np.array([NULL_ID if i is None else i for i, _ in rows], np.int64)
    made = []
    for bucket, segments in out.items():
        r = np.array([x[0] for x in segments], np.int64)
        made.append((bucket, squeezed(
            block, ids[r] if len(r) else r, r, np.array([x[1] for x in segments], np.int64),
            np.array([x[2] for x in segments], np.int64), np.array([x[3] for x in segments], np.int64),
            b"".join(x[4] for x in segments),
            np.array(again, np.int64).reshape(-1, 3) if bucket == block % buckets else None)))
    return pd.DataFrame(made, columns=["bucket", "payload"])


def _columns(file, begin: np.ndarray, windows: np.ndarray, strings: bytes) -> int:
    """Write the segments' symbols to ``file``, one column after the other
    (0 beyond a segment's ends); the number of columns."""
    width = REACH + LENGTH
    size = windows + LENGTH - 1
    source = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(strings, np.uint8)
    for c in range(width):
        at = c - begin
        inside = (at >= 0) & (at < size)
        column = np.zeros(len(begin), np.uint8)
        column[inside] = data[(source + at)[inside]]
        file.write(column.tobytes())
    return width


def marked(ids, blocks, rows, places, windows, offsets, strings: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the first and the last of its windows that also start
    earlier (first > last: none). Windows between them lie in their union."""
    m = len(ids)
    rank = np.empty(m, np.int64)
    rank[np.lexsort((places, rows, blocks, ids))] = np.arange(m)
    begin = REACH - offsets
    first, last = np.full(m, 1 << 30), np.full(m, -1)
    order, common = np.arange(m), np.zeros(m + 1, np.uint8)  # common[i]: of neighbours i - 1 and i
    common[1:m] = LENGTH  # before the first round all suffixes are empty, and equal
    inserted = 0
    with tempfile.TemporaryFile() as file:
        width = _columns(file, begin, windows, strings)
        file.flush()
        for c in range(width - 1, -1, -1):
            file.seek(c * m)
            symbols = np.frombuffer(file.read(m), np.uint8)[order]
            moved = np.argsort(symbols, kind="stable")
            same = np.flatnonzero(symbols[moved[1:]] == symbols[moved[:-1]]) + 1
            longer = np.zeros(m + 1, np.uint8)
            if len(same):
                between = np.empty(2 * len(same), np.int64)
                between[::2], between[1::2] = moved[same - 1] + 1, moved[same] + 1
                least = np.minimum.reduceat(common, between)[::2]
                longer[same] = np.minimum(least.astype(np.int64) + 1, LENGTH) if inserted >= LENGTH else np.minimum(least, inserted) + 1
            order, common = order[moved], longer
            inserted += 1
            if inserted < LENGTH:
                continue
            start = np.flatnonzero(common[:m] < LENGTH)
            sizes = np.diff(np.append(start, m))
            if sizes.max(initial=0) < 2:
                continue
            at = c - begin[order]
            valid = (at >= 0) & (at < windows[order])
            ranks = np.where(valid, rank[order], m)
            earliest = np.repeat(np.minimum.reduceat(ranks, start), sizes)
            hit = order[valid & (ranks > earliest)]
            first[hit] = c - begin[hit]
            last[hit] = np.maximum(last[hit], first[hit])
    return first, last


def _found(group: pd.DataFrame) -> pd.DataFrame:
    """Spans to remove, by block, from the segments of a bucket."""
    parts = [expanded(p) for p in group["payload"]]
    blocks = np.concatenate([np.full(len(p[2]), p[0]) for p in parts])
    ids, rows, places, windows, offsets = (np.concatenate([p[k] for p in parts]) for k in range(1, 6))
    spans: dict[int, list] = {p[0]: [p[7]] for p in parts if p[7] is not None and len(p[7])}
    if len(ids):
        first, last = marked(ids, blocks, rows, places, windows, offsets, b"".join(p[6] for p in parts))
        hit = np.flatnonzero(last >= 0)
        hit = hit[np.argsort(blocks[hit], kind="stable")]
        for own in np.split(hit, np.flatnonzero(np.diff(blocks[hit])) + 1):
            if len(own):
                spans.setdefault(int(blocks[own[0]]), []).append(
                    np.stack([rows[own], places[own] + first[own], places[own] + last[own] + LENGTH], axis=1))
    return pd.DataFrame([(b, squeezed(np.concatenate(s))) for b, s in spans.items()], columns=["block", "payload"])


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows (row, start, stop) as maximal runs, in order."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = spans[:, 2].copy()
    base = spans[:, 0] << 40  # running maximum within a row
    reach = np.maximum.accumulate(reach + base) - base
    new = np.concatenate([[True], (spans[1:, 0] != spans[:-1, 0]) | (spans[1:, 1] > reach[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(spans)) - 1
    return np.stack([spans[first, 0], spans[first, 1], reach[last]], axis=1)


def _kept(docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    rows = block_rows(docs["payload"])
    spans = [expanded(p)[0] for p in replies["payload"]]
    by_row: dict[int, list] = {}
    if spans:
        for r, i, j in merged(np.concatenate(spans)).tolist():
            by_row.setdefault(r, []).append((i, j))
    out = []
    for r, (doc_id, text) in enumerate(rows):
        at, kept = 0, []
        for i, j in by_row.get(r, ()):
            kept.append(text[at:i])
            at = j
        kept = b"".join([*kept, text[at:]])
        out.append((doc_id, len(text), len(text) - len(kept), [list(s) for s in by_row.get(r, ())], kept,
                    hashlib.sha256(kept).hexdigest()))
    frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])
    return frame.astype({"doc_id": "Int64"})


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (removed runs, [start, stop) in
    bytes), kept (the remaining bytes), kept_sha256 of every row."""
    least, size = shuffle_partitions(docs.sparkSession), text_bytes(docs)
    blocks, buckets = max(least, size // BLOCK_BYTES), max(2 * least, size // BLOCK_BYTES)
    packed = blocks_of(docs, blocks)
    counted = packed.groupBy("block").applyInPandas(lambda g: _counted(g, buckets), "bucket int, block int, payload binary")
    replies = counted.groupBy("bucket").applyInPandas(lambda g: _repeated(g, hot), "block int, payload binary")
    sent = (packed.groupBy("block").cogroup(replies.groupBy("block"))
            .applyInPandas(lambda d, r: _sent(d, r, buckets), "bucket int, payload binary"))
    found = sent.groupBy("bucket").applyInPandas(_found, "block int, payload binary")
    return (packed.groupBy("block").cogroup(found.groupBy("block"))
            .applyInPandas(_kept, "doc_id long, n_bytes long, n_removed long, spans array<array<long>>, "
                                  "kept binary, kept_sha256 string"))


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                     "kept_sha256")

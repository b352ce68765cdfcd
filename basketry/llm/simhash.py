"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common variant within
r bits of each. Every distinct fingerprint emits all its variants within r
bits, variants meet in a shuffle, and those that collide are a link.

The shuffle deals variants by their leading bits. The variants of one
fingerprint with the same leading bits travel as one row, the fingerprint and
the flips that are left for the other bits; the task that has the leading
bits writes the variants out, sorts them and finds equal ones. Of the links
found in one task a spanning forest leaves it, so copies are never paired.

Edge cases: a null text is an empty one; texts without words have the
fingerprint zero and are linked like others; equal fingerprints are one node;
rows with one id and different texts are rows like others; a component of null
ids only has the id null; an empty table gives an empty one; further columns
are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components, forest
from basketry.llm.shared import plain_text, ship, written

ship(__name__)

SEED = 42
#: Variants that a task holds at once, about.
VARIANTS = 2_000_000
HOT = 8 * VARIANTS  #: a range of more goes to several tasks
SPLIT = 8  #: bits by which a range is split again
LEAST_PREFIX = 8


def simhash(text: str, size: int = 4) -> int:
    """A bit is 1 if it is set in over half the hashes of the shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = [len(joined)] if n == 1 else ends[size - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)])),
                             np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """doc_id, text_id (a hash that tells rows with one id apart), fp (the
    fingerprint's bits as a signed long)."""
    def run(batches):
        for batch in batches:
            fps = [simhash(t, size) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))],
                ["doc_id", "text_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(plain_text()), plain_text())
    return rows.mapInArrow(run, "doc_id long, text_id long, fp long")


def _flips(bits: int, most: int) -> list[np.ndarray]:
    """For 0 to ``most``: the masks of ``bits`` low bits with so many set."""
    one = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    out, last, top = [np.zeros(1, np.uint64)], np.zeros(1, np.uint64), np.full(1, -1)
    for _ in range(most):
        pairs = [(m | one[i], i) for m, t in zip(last, top) for i in range(t + 1, bits)]
        last = np.array([m for m, _ in pairs], np.uint64)
        top = np.array([t for _, t in pairs], np.int64)
        out.append(last)
    return out


def _within(fp: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(fp[a] ^ fp[b]) <= most


def colliding(fp: np.ndarray, left: np.ndarray, low: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct fingerprints ``fp`` of one range of leading
    bits, as a spanning forest. left: flips left for each one's ``low`` low
    bits. A variant is a 40-bit hash with its owner below it."""
    keep, owner_bits = np.uint64((1 << low) - 1), np.uint64(24)
    owners = np.uint64((1 << 24) - 1)
    masks = _flips(low, (most + 1) // 2)
    keys = []
    for k in range(len(masks)):
        own = np.flatnonzero(left >= k).astype(np.uint64)
        variant = (fp[own][:, None] & keep) ^ masks[k][None, :]
        variant *= np.uint64(0x9E3779B97F4A7C15)
        variant &= ~owners
        variant |= own[:, None]
        keys.append(variant.ravel())
    keys = np.concatenate(keys)
    keys.sort()
    meet = np.flatnonzero((keys[1:] >> owner_bits) == (keys[:-1] >> owner_bits))
    a, b = (keys[meet] & owners).astype(np.int64), (keys[meet + 1] & owners).astype(np.int64)
    near = _within(fp, a, b, most)
    if not near.all():  # neighbours that only share the hash (or an odd ``most``): all pairs of their run
        odd = np.unique(keys[meet[~near]] >> owner_bits)
        lo, hi = np.searchsorted(keys, odd << owner_bits), np.searchsorted(keys, (odd << owner_bits) | owners, "right")
        for i, j in zip(lo.tolist(), hi.tolist()):
            run = np.unique(keys[i:j] & owners).astype(np.int64)
            for k in range(1, len(run)):
                hit = run[k:][_within(fp, run[k:], run[:-k], most)]
                a, b = np.append(a, hit), np.append(b, run[:-k][np.isin(run[k:], hit)])
        near = _within(fp, a, b, most)
    a, b = a[near], b[near]
    root = forest(len(fp), a, b)
    child = np.flatnonzero(root != np.arange(len(fp)))
    return root[child], child


def _dealt(group: np.ndarray, left: np.ndarray, fp: np.ndarray, at: int, upto: int) -> tuple[np.ndarray, ...]:
    """Rows (index, left) of fingerprints split by their bits from ``at`` to
    ``upto`` (leading bits first) with all flips they may still have there:
    (range, index, left), by range."""
    bits = upto - at
    own = (fp[group] >> np.uint64(64 - upto)) & np.uint64((1 << bits) - 1)
    ranges, index, rest = [], [], []
    for k, masks in enumerate(_flips(bits, int(left.max(initial=0)))):
        can = np.flatnonzero(left >= k)
        ranges.append((own[can][:, None] ^ masks[None, :]).ravel())
        index.append(np.repeat(group[can], len(masks)))
        rest.append(np.repeat(left[can] - k, len(masks)))
    ranges, index, rest = map(np.concatenate, (ranges, index, rest))
    order = np.argsort(ranges, kind="stable")
    return ranges[order], index[order], rest[order]


def split_links(fp: np.ndarray, left: np.ndarray, at: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """What :func:`colliding` finds for a range of ``at`` leading bits, as a
    spanning set; a range of more than VARIANTS variants is split by further
    bits until each part has at most so many (or no bits are left)."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [(at, np.arange(len(fp)), left)]
    while todo:
        at, group, own = todo.pop()
        if len(group) < 2:
            continue
        size = sum(math.comb(64 - at, k) * int((own >= k).sum()) for k in range((most + 1) // 2 + 1))
        if at >= 60 or size <= VARIANTS and len(group) < 1 << 24:
            x, y = colliding(fp[group], own, 64 - at, most)
            a.append(group[x])
            b.append(group[y])
            continue
        upto = min(60, at + SPLIT)
        ranges, index, rest = _dealt(group, own, fp, at, upto)
        cuts = np.flatnonzero(np.diff(ranges)) + 1
        todo += [(upto, i, r) for i, r in zip(np.split(index, cuts), np.split(rest, cuts))]
    return np.concatenate(a), np.concatenate(b)


def ranges_of(rows: DataFrame, at: int, upto: int, radius: int) -> DataFrame:
    """``rows`` (fp, left, range) with the range's bits from ``at`` to ``upto``
    added, a row for each way to flip at most ``left`` of them."""
    bits = upto - at
    flips = [(int(m), k) for k, masks in enumerate(_flips(bits, radius)) for m in masks]
    own = F.shiftrightunsigned("fp", 64 - upto).bitwiseAND(F.lit((1 << bits) - 1))
    ways = F.filter(F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("flipped")) for m, k in flips]),
                    lambda f: f["flipped"] <= F.col("left"))
    return rows.withColumn("flip", F.explode(ways)).select(
        F.shiftleft("range", bits).bitwiseOR(own.bitwiseXOR(F.col("flip.mask"))).alias("range"),
        "fp", (F.col("left") - F.col("flip.flipped")).alias("left"))


def variants_of(bits: int, radius: int) -> Column:
    """How many variants a row with ``left`` flips makes of ``bits`` bits."""
    most = F.lit(0)
    for k in range(radius + 1):
        most = most + F.when(F.col("left") >= k, F.lit(math.comb(bits, k))).otherwise(F.lit(0))
    return most.cast("long")


def _linker(at: int, most: int):
    """The task of a range of ``at`` leading bits."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        fp = group["fp"].to_numpy().view(np.uint64)
        a, b = split_links(fp, group["left"].to_numpy(), at, most)
        return pd.DataFrame({"a": fp[a].view(np.int64), "b": fp[b].view(np.int64)})
    return run


def links(fps: DataFrame, most: int = 4) -> DataFrame:
    """a, b: a spanning set of the links among the distinct ``fps`` (fp), two
    that differ in at most ``most`` bits. Ranges of more than HOT variants are
    dealt again by further leading bits, so that many tasks share them."""
    radius = (most + 1) // 2
    variants = sum(math.comb(64, k) for k in range(radius + 1))
    at = min(20, max(LEAST_PREFIX, math.ceil(math.log2(max(1, fps.count() * variants / VARIANTS)))))
    flips = [(int(m), radius - k) for k, masks in enumerate(_flips(at, radius)) for m in masks]
    sent = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(r).alias("left"))
                                                for m, r in flips])).alias("flip"))
    sent = sent.select(F.shiftrightunsigned("fp", 64 - at).bitwiseXOR(F.col("flip.mask")).cast("long").alias("range"),
                       "fp", F.col("flip.left").alias("left"))
    found = None
    while True:
        sizes = sent.groupBy("range").agg(F.sum(variants_of(64 - at, radius)).alias("size"))
        hot = written(sizes.where(F.col("size") > HOT).select("range"), "hot") if at < 60 else None
        last = hot is None or not hot.limit(1).count()
        cool = sent if last else sent.join(hot, "range", "left_anti")

        own = cool.groupBy("range").applyInPandas(_linker(at, most), "a long, b long")
        found = own if found is None else found.union(own)
        if last:
            return found
        upto = min(60, at + SPLIT)
        sent, at = written(ranges_of(sent.join(hot, "range", "left_semi"), at, upto, radius), "ranges"), upto


def linked(rows: DataFrame, most: int = 4) -> DataFrame:
    """``rows`` (doc_id, fp, ...; a written table) with root (a fingerprint of
    the component) and component_id (its smallest doc_id)."""
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), most))
    grouped = written(nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "grouped")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    found = written(grouped.join(ids, "root").select("fp", "root", "component_id"), "components")
    return rows.join(found, "fp")


def near_duplicates(docs: DataFrame, size: int = 4, most: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the smallest doc_id that links
    reach) of every row."""
    return linked(written(fingerprints(docs, size), "fingerprints"), most).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def query(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

"""Document fingerprints from prefix polynomial hashes.

A text's prefix array H, with H[i] the sum of c_j * B**j over j < i modulo a
prime, gives the hash of any span in constant time, so the equality of any
two spans, and the longest common extension of two places by binary search.
Two primes near 2**31 make it 62 bits.

The fingerprint of a text has its length, the hash of all of it, the hashes of
its prefixes and of its suffixes on a ladder of lengths (eight rungs for each
doubling), and the smallest hashes of its spans of ``SPAN`` code points. The
likeness of two fingerprints is the larger of

* the common extension: equal rungs are found by binary search from the front
  and from the back, and their lengths are divided by that of the longer text;
* the share of common spans, estimated from the smallest hashes of both.

The next document is found without a global window: rows are dealt over ranges
of (doc_id, hash of the text), about RANGE_BYTES of texts each, compressed by
range and batch; each range is sorted and gone through, and one more row, the
first of the range below, closes the gap. Bounds come from quantiles of the
ids; an id that is several quantiles at once, such as null for a third of the
rows, is split by the hash into as many ranges.

Edge cases: a null text is an empty one, and two empty texts are alike (1.0);
null ids are below all others; rows with one id follow each other by a hash of
their texts, the largest first; a very long text is one row of its range, held
whole; repeated rows are each other's next; a single row is its own next; an empty table
gives an empty one; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.shared import (expanded, plain_text, search, ship, shuffle_partitions, squeezed, text_bytes,
                                 worker_state)

ship(__name__)

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1664525)
SPAN = 24
SKETCH = 64
RUNGS = 8
MOST_LENGTH = 1 << 31
RANGE_BYTES = 128 << 20  #: texts of a range, about: what a task holds at a time


def ladder() -> np.ndarray:
    """1, 2, ... with eight lengths for each doubling."""
    steps = np.unique(np.floor(2 ** (np.arange(0, 31 * RUNGS + 1) / RUNGS)).astype(np.int64))
    return steps[steps < MOST_LENGTH]


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both primes: the powers of the base and of its inverse, to n at
    least, kept by the worker and doubled when a longer text comes."""
    state = worker_state("powers")
    have = state.get("n", 0)
    if have < n:
        size = max(4096, 2 * have)
        while size < n:
            size *= 2
        tables = []
        for p, b in zip(PRIMES, BASES):
            pair = []
            for base in (b, pow(b, -1, p)):
                out = np.ones(size, np.uint64)
                done = 1
                while done < size:
                    more = min(done, size - done)
                    out[done:done + more] = out[:more] * np.uint64(pow(base, done, p)) % np.uint64(p)
                    done += more
                pair.append(out)
            tables.append(tuple(pair))
        state["tables"], state["n"] = tables, size
    return state["tables"]


class Prefixes:
    """Prefix hashes of a sequence of code points."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.powers = _powers(self.n + 1)
        values = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for (power, _), p in zip(self.powers, PRIMES):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * power[:self.n] % np.uint64(p), out=sums[1:])
            self.sums.append(sums % np.uint64(p))

    @classmethod
    def of(cls, text: str) -> "Prefixes":
        return cls(np.frombuffer(text.encode("utf-32-le"), np.uint32))

    def spans(self, start, stop) -> np.ndarray:
        """62-bit hashes of the spans [start, stop), which may be arrays;
        equal spans have equal hashes wherever they stand."""
        out = []
        for (_, inverse), sums, p in zip(self.powers, self.sums, PRIMES):
            p = np.uint64(p)
            out.append((sums[stop] + p - sums[start]) % p * inverse[start] % p)
        return out[0] << np.uint64(31) ^ out[1]

    def equal(self, i: int, other: "Prefixes", j: int, length: int) -> bool:
        return bool(self.spans(i, i + length) == other.spans(j, j + length))

    def common_extension(self, i: int, other: "Prefixes", j: int) -> int:
        """Length of the longest common extension of the places i and j."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low


class Fingerprint:
    """length, whole, front and back (16 bits a rung), spans (32 bits each)."""

    __slots__ = ("length", "whole", "front", "back", "spans")

    def __init__(self, text: str):
        h, rungs = Prefixes.of(text), worker_state("ladder")
        if not rungs:
            rungs["all"] = ladder()
        n = h.n
        rungs = rungs["all"][:np.searchsorted(rungs["all"], n, "right")]
        self.length, self.whole = n, int(h.spans(0, n))
        short = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)
        self.front = short(h.spans(np.zeros_like(rungs), rungs))
        self.back = short(h.spans(n - rungs, np.full_like(rungs, n)))
        starts = np.arange(max(1, n - SPAN + 1)) if n else np.zeros(0, np.int64)
        spans = (h.spans(starts, np.minimum(starts + SPAN, n)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)).astype(np.uint32)
        self.spans = np.unique(spans)[:SKETCH]

    def __str__(self) -> str:
        return f"{self.length:x}.{self.whole:016x}.{self.front.tobytes().hex()}.{self.back.tobytes().hex()}.{self.spans.astype('>u4').tobytes().hex()}"


def _equal_rungs(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading rungs are equal, by binary search: texts that agree
    on a rung agree on all shorter ones."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return low


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """0 to 1; 1 for equal texts."""
    if a.whole == b.whole and a.length == b.length:
        return 1.0
    longest, rungs = max(a.length, b.length), worker_state("ladder")["all"]
    extension = sum(int(rungs[k - 1]) if (k := _equal_rungs(x, y)) else 0 for x, y in ((a.front, b.front), (a.back, b.back)))
    both = np.union1d(a.spans, b.spans)[:SKETCH]
    shared = len(np.intersect1d(np.intersect1d(a.spans, b.spans, True), both, True)) / max(1, len(both))
    return min(1.0, max(extension / longest, shared))


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the start of the next one."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _row(doc_id, text: str, own: Fingerprint, following: str, next_one: Fingerprint) -> tuple:
    other = edited(text, following)
    changed = own if other == text else Fingerprint(other)
    return (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), str(own), str(changed),
            likeness(own, changed), likeness(own, next_one))


def _packed(batches):
    """range, payload: the rows of a batch by range, compressed."""
    for batch in batches:
        held: dict[int, list] = {}
        for own, closed, key, doc_id, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
            held.setdefault(own, []).append((False, key, text, doc_id))
            if closed is not None:
                held.setdefault(closed, []).append((True, key, text, doc_id))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([squeezed(x) for x in held.values()], pa.binary())], ["range", "payload"])


def _rows_of(payloads: list[bytes]):
    """The output of one range: its rows in order, each with the one after it;
    the first of the closing rows comes after the last."""
    rows = sorted((r for p in payloads for r in expanded(p)[0]), key=lambda r: r[1], reverse=True)
    rows.sort(key=lambda r: r[0])
    own = None
    for k, (closing, _, text, doc_id) in enumerate(rows):
        if closing:
            break
        own = own or Fingerprint(text)
        following = rows[k + 1][2]
        next_one = Fingerprint(following)
        yield _row(doc_id, text, own, following, next_one)
        own = next_one


def _stream(batches):
    """A partition's ranges, one after the other."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    made = lambda out: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 7, kinds)], names)
    open_range, held = None, []
    for batch in batches:
        for which, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if which != open_range and held:
                yield made(list(_rows_of(held)))
                held = []
            open_range = which
            held.append(payload)
    yield made(list(_rows_of(held)))


def _key(place: int, share: float = 0.0) -> str:
    """The key of an id and of a hash that lies at ``share`` of all hashes."""
    return f"{place + (1 << 63):016X}{min((1 << 64) - 1, int(share * (1 << 64))):016X}"


def _bounds(points: list[int]) -> list[str]:
    """Range bounds from quantiles of the ids. One that stands there r times
    holds about r ranges' rows and is cut into r by the hash."""
    times = Counter(points)
    return sorted(_key(place, k / r) for place, r in times.items() for k in range(r))


def ranged(docs: DataFrame, ranges: int) -> DataFrame:
    """``docs`` (doc_id, text) with the sort key of each row and its range."""
    place = F.coalesce("doc_id", F.lit(-(1 << 63)))
    digits = lambda c: F.lpad(F.hex(c), 16, "0")
    key = F.concat(digits(place.bitwiseXOR(F.lit(-(1 << 63)))), digits(F.xxhash64("text")))
    points = docs.agg(F.percentile_approx(place, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    bounds = _bounds(points or [])
    table = F.split(F.lit(",".join(bounds)), ",")  # one literal, however many
    return docs.withColumn("key", key).withColumn("range", search(bounds, F.col("key"), table))


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    ranges = ranges or max(8 * shuffle_partitions(spark), text_bytes(docs) // RANGE_BYTES)
    docs = ranged(docs, ranges)
    # the first row of a range closes the next range above that has rows; the
    # first of all closes the lowest
    ends = docs.groupBy("range").agg(F.max("key").alias("first")).orderBy("range").collect()
    closes = [(end["first"], ends[(at + 1) % len(ends)]["range"]) for at, end in enumerate(ends)]
    closing = F.broadcast(spark.createDataFrame(closes, "first string, closed int"))  # a row a range
    packed = (docs.join(closing, F.col("key") == F.col("first"), "left").select("range", "closed", "key", "doc_id", "text")
              .mapInArrow(_packed, "range int, payload binary"))
    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(_stream, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    """Every document and its edited text."""
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

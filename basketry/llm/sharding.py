"""Sharding over fixed virtual slots.

Every record is hashed into one of ``slots`` virtual slots, once and for all.
The bytes of each slot are summed, and a versioned map says which shard holds
which slot. Version 1 deals slots from the largest to the smallest to the
shard with the fewest bytes; a later version is an edit of the one before it,
which moves whole slots only (:func:`rebalanced`). Maps have one row a slot,
whatever the data, so they fit the driver and go into the plan as literals.

Law: ``bytes``: sizes are near equal. With thousands of slots the shards
differ by less than the largest record or the smallest slots.

Edge cases: a null text is an empty one of 16 bytes; null ids are hashed like
any other value, with the text; repeated rows share a slot and get places of
their own; very long texts count with all their bytes; an empty table gives an
empty one; further columns are left out.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.shared import plain_text

OVERHEAD = 16
SLOTS = 4096


def slot_of(slots: int = SLOTS, id_col: str = "doc_id") -> Column:
    """The record's virtual slot: id and text decide, so neither copies of a
    text nor rows of one id (or of none) meet in a slot."""
    return F.pmod(F.xxhash64(F.col(id_col), F.crc32(F.encode(plain_text(), "UTF-8"))), F.lit(slots)).cast("int")


def slot_sizes(docs: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """(bytes, rows) of every slot: one aggregate, ``slots`` rows at most."""
    size = F.octet_length(plain_text()).cast("long") + OVERHEAD
    sums = docs.select(slot_of(slots).alias("slot"), size.alias("size")).groupBy("slot").agg(
        F.sum("size").alias("size"), F.count("*").alias("rows"))
    found = {r["slot"]: (r["size"], r["rows"]) for r in sums.collect()}
    return [found.get(s, (0, 0)) for s in range(slots)]


def dealt(sizes: list[tuple[int, int]], shards: int) -> list[int]:
    """Version 1 of the map: slot -> shard, largest slots first, each to the
    shard with the fewest bytes so far."""
    heap = [(0, k) for k in range(shards)]
    shard = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s][0], s)):
        size, k = heap[0]
        shard[slot] = k
        heapq.heapreplace(heap, (size + sizes[slot][0], k))
    return shard


def rebalanced(shard: list[int], sizes: list[tuple[int, int]], shards: int, tolerance: float = 0.03) -> list[int]:
    """The next version for ``shards`` shards: slots move from the fullest
    shard to the emptiest while the two differ by over ``tolerance`` of a
    shard's mean and a move brings them closer; all others stay."""
    shard = list(shard)
    held: list[list[int]] = [[] for _ in range(shards)]
    total = [0] * shards
    for slot, k in enumerate(shard):
        if k >= shards:  # a shard that was taken away
            k = shard[slot] = min(range(shards), key=lambda x: (total[x], x))
        held[k].append(slot)
        total[k] += sizes[slot][0]
    for _ in range(len(shard)):
        most, least = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[most] - total[least]
        fits = [s for s in held[most] if 0 < sizes[s][0] < gap]
        if not fits or gap <= tolerance * sum(total) / shards:
            break
        slot = min(fits, key=lambda s: (abs(gap - 2 * sizes[s][0]), s))
        held[most].remove(slot)
        held[least].append(slot)
        total[most] -= sizes[slot][0]
        total[least] += sizes[slot][0]
        shard[slot] = least
    return shard


def map_table(spark, versions: list[list[int]]) -> DataFrame:
    """version, slot, shard: all versions of a map, as it is stored."""
    rows = [(v, s, k) for v, m in enumerate(versions, 1) for s, k in enumerate(m)]
    return spark.createDataFrame(rows, "version int, slot int, shard int")


def store_map(spark, path: str, versions: list[list[int]]) -> None:
    """Write the versions as a table with a folder for each version; versions
    that are there already are left as they are."""
    map_table(spark, versions).write.mode("ignore").partitionBy("version").parquet(path)


def stored_map(spark, path: str, version: int | None = None) -> list[int]:
    """A version of a stored map (default: the latest)."""
    table = spark.read.parquet(path)
    version = version or table.agg(F.max("version")).first()[0]
    return [r["shard"] for r in table.where(F.col("version") == version).orderBy("slot").collect()]


def assign(docs: DataFrame, shard: list[int], sizes: list[tuple[int, int]]) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot.

    ``slot`` is the record's place in its shard, gapless from 0: the records
    of the shard's earlier virtual slots come first, then those of its own by
    (doc_id, crc). Numbering sorts one virtual slot at a time; rows move
    without their texts.
    """
    text = F.encode(plain_text(), "UTF-8")
    base, filled = [], {}
    for slot, k in enumerate(shard):
        base.append(filled.get(k, 0))
        filled[k] = filled.get(k, 0) + sizes[slot][1]
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
                       F.crc32(text).alias("text_crc32"), slot_of(len(shard)).alias("virtual_slot"))
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    at = lambda table, kind: F.get(F.array(*[F.lit(x) for x in table]), F.col("virtual_slot")).cast(kind)
    return rows.withColumn("nth", F.row_number().over(order)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), at(shard, "int").alias("shard"),
        (at(base, "long") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def query(spark, sf_dir: str, shards: int = 40) -> DataFrame:
    """All documents in shards 0 to 39."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sizes = slot_sizes(docs)
    return assign(docs, dealt(sizes, shards), sizes)

"""Helpers shared by the operators of this subpackage: shared-folder tables,
sizing, by-value shipping of task code, and native search in sorted bounds."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import shared_table_root

#: The white space of every contract here: space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions to Python workers by value, so that a
    worker needs no copy of this package on its path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table in a folder of its own below the session's
    ``spark.checkpoint.dir``, read again: cuts the lineage, survives the loss
    of executors, and gives the planner true sizes."""
    path = f"{shared_table_root(df.sparkSession)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plain_text(col: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (one pass, one number)."""
    return int(docs.agg(F.sum(F.octet_length(plain_text()).cast("long"))).first()[0] or 0)


def search(bounds: list, value: Column, table: Column | None = None) -> Column:
    """How many of the sorted literal ``bounds`` are at most ``value``: binary
    search inside the expression, log2(len) steps a row. ``table``: the bounds
    as one array literal, where there are very many."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    table = F.array(*[F.lit(b) for b in bounds]) if table is None else table
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, s: F.when(F.get(table, low + s - 1) <= value, low + s).otherwise(low))


def worker_state(name: str) -> dict:
    """A dict that lives as long as the Python worker's process, for caches
    that outlast one task (functions sent by value get new globals)."""
    import types
    home = sys.modules.setdefault("_basketry_worker_state", types.ModuleType("_basketry_worker_state"))
    return home.__dict__.setdefault(name, {})


def forget(name: str) -> None:
    """Drop what an operator whose tasks are over keeps in this worker, and
    give freed Arrow memory back."""
    import pyarrow as pa
    worker_state(name).clear()
    pa.default_memory_pool().release_unused()


BATCH_BYTES = 8 << 20
SLICE_ROWS = 500


def sliced(batches):
    """The batches in slices of few rows, so that few texts are Python objects
    at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def blocks_of(docs: DataFrame, blocks: int) -> DataFrame:
    """block, payload: the documents (doc_id, text) as packed rows, each a
    compressed list of (doc_id, bytes) from one batch. A row's id and text
    decide its block."""
    import pickle
    import zlib

    import pyarrow as pa
    import zstandard

    def packed(held):
        squeeze = zstandard.ZstdCompressor(level=3)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()),
             pa.array([squeeze.compress(pickle.dumps(x)) for x in held.values()], pa.binary())], ["block", "payload"])

    def run(batches):
        held, size = {}, 0
        for batch in sliced(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text.encode()
                held.setdefault(zlib.crc32(text, zlib.crc32(str(doc_id).encode())) % blocks, []).append((doc_id, text))
                size += len(text)
                if size > BATCH_BYTES:
                    yield packed(held)
                    held, size = {}, 0
        if held:
            yield packed(held)

    return docs.select(F.col("doc_id").cast("long"), plain_text()).mapInArrow(run, "block int, payload binary")


def block_rows(payloads) -> list[tuple]:
    """(doc_id, bytes) of a block's rows, by id (null last), then text: the
    same order whenever the block is read."""
    import pickle

    import zstandard
    expand = zstandard.ZstdDecompressor()
    rows = [r for p in payloads for r in pickle.loads(expand.decompress(p))]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def squeezed(*arrays, level: int = 3) -> bytes:
    """Arrays and byte strings as one compressed value."""
    import pickle

    import zstandard
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(arrays))


def expanded(payload: bytes) -> tuple:
    import pickle

    import zstandard
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))

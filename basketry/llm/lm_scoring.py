"""Scoring documents with a causal self-attention model on subword ids.

From all training documents (crc32 of the id as text, modulo 10, not 0) Spark
gathers the count of every word and of every pair of neighbouring ids. The
pairs give the model its vocabulary (the most frequent ids, one more for all
others, which share it by their counts), the classes of its output, and a
pair model that is mixed in with a small weight. The attention model itself
(:mod:`basketry.llm.attention`) is trained on every window of every training
document: the windows are dealt to parts of about PART_IDS ids and the parts to
rounds, as many as the root of the parts. In a round each task goes through its
part from the weights of the last round, and the weights are averaged, so both
the steps and the parts of a step grow with the input. Of a small input there
are as many passes as make ``steps`` steps.

Texts are read and split once: documents are stored by block as the numbers of
their words, and the distinct words of a unit of some blocks go to buckets.
There each distinct word of the corpus is counted and turned into ids once,
counts and ids go back to each unit that has the word, and the lines of ids of
its blocks are stored for the pairs, the windows and the scores. So no
vocabulary is broadcast or collected. Rows by unit and bucket grow with the
square of the input: about 2,000 for 1 GB of text, 200,000 for 10 GB.

score: log10 of the model's probability of the ids and the end of the text;
base_score: the same of words and end under add-0.1 unigram counts.

Edge cases: a null text is empty (one token, the end); a null id is never held
out; rows with one id are documents of their own; without training documents
the model is untrained and base_score counts nothing as known; an empty table
gives an empty one; further columns are left out.
"""

from __future__ import annotations

import math
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import attention as net
from basketry.llm.packing import worker_ids
from basketry.llm.shared import SLICE_ROWS, expanded, plain_text, ship, shuffle_partitions, sliced, squeezed, text_bytes, written
from basketry.session import shared_table_root

ship(__name__)

BLOCK_BYTES = 4 << 20
UNIT_BYTES, BUCKET_BYTES = 16 << 20, 32 << 20  #: of texts whose words are listed together; of all texts for each bucket of words
FEW_WORDS = 1 << 16  #: words that are Python objects at a time
FOLDS = 10
WORDS, PAIRS, DOCS, LINES = range(4)  #: kinds of stored rows
END_ID, IDS = 49407, 49408
STEPS = 2000  #: at least; a large input takes more in its one pass
PART_IDS, CHUNK = 2_000_000, 4096  #: training ids of a task in a round, about; windows in a row
PAIR_SHARE = 0.05
BATCH = 4000


def stored(*arrays) -> bytes:
    """Compressed at little cost: every id passes through here a few times."""
    return squeezed(*arrays, level=1)


def is_held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def _numbered(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of each text, the distinct words, and the numbers of all words one
    text after the other. A-Z are lower-cased."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)  # white space at an end of a text leaves an empty one
    text = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    found = flat.filter(full).dictionary_encode()
    sizes = np.bincount(text[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return sizes, found.dictionary.cast(pa.binary()), found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _chosen(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The runs ``at`` of ``flat``, one after the other; ``size``: of each run."""
    start, own = np.cumsum(size) - size, size[at]
    return flat[np.repeat(start[at] - (np.cumsum(own) - own), own) + np.arange(own.sum())]


def _block(rows: list[pa.RecordBatch]) -> tuple:
    """A block's documents (ids, which are null, which are held out, words of
    each), the numbers of their words, and its distinct words."""
    ids = [i for r in rows for i in r.column(0).to_pylist()]
    sizes, words, numbers = _numbered(pa.concat_arrays([r.column(1) for r in rows]))
    return (np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool),
            np.fromiter(map(is_held_out, ids), bool, len(ids)), sizes.astype(np.uint32), numbers.astype(np.uint32), words)


def _unit(blocks: list[tuple], unit: int, buckets: int) -> list[tuple]:
    """The documents of each block of a unit as numbers of the unit's words,
    which stand by bucket, and for each bucket its words with their training
    counts."""
    found = pa.concat_arrays([words for *_, words in blocks]).dictionary_encode()
    own, at, words = found.indices.to_numpy(zero_copy_only=False), 0, found.dictionary.to_numpy(zero_copy_only=False)
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    counts, out = np.zeros(len(order), np.int64), []
    for ids, null, held, sizes, numbers, own_words in blocks:
        to = rank[own[at:at + len(own_words)]]
        at += len(own_words)
        counts[to] += np.bincount(numbers[np.repeat(~held, sizes)], minlength=len(to))
        out.append((DOCS, -1, unit, int((~held).sum()), stored(ids, null, held, sizes, to[numbers])))
    bucket, words = bucket[order], words[order]
    size, letters = np.fromiter(map(len, words), np.int32, len(words)), b"".join(words)
    ends = np.concatenate([[0], np.cumsum(size)]).tolist()
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(order)]
    for i, j in zip(cuts, cuts[1:]):
        if j > i:
            out.append((WORDS, int(bucket[i]), unit, 0, stored(size[i:j], letters[ends[i]:ends[j]], counts[i:j].astype(np.uint32))))
    return out


def blocked(docs: DataFrame, buckets: int) -> str:
    """The folder of a table kind, bucket, unit, used, payload: what
    :func:`_unit` makes, in a folder per kind. A block has about BLOCK_BYTES
    and ends where a slice of training documents does, if that is not far; the
    blocks of about UNIT_BYTES are a unit, so that a word travels once for all
    of them, and rows by unit and bucket stay few."""
    def run(batches):
        units = ((TaskContext.get().partitionId() << 32) + n for n in range(1 << 32))

        def made(blocks):
            out = _unit(blocks, next(units), buckets)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        blocks, held, rows, size, used = [], 0, [], 0, 0
        for batch in batches:
            begin, lengths = 0, pc.binary_length(batch.column(1)).to_pylist()
            for at, (doc_id, length) in enumerate(zip(batch.column(0).to_pylist(), lengths), 1):
                size += length + 16
                used += not is_held_out(doc_id)
                if size >= 4 * BLOCK_BYTES or size >= BLOCK_BYTES and used % SLICE_ROWS == 0:
                    blocks.append(_block([*rows, batch.slice(begin, at - begin)]))
                    held += size
                    rows, size, used, begin = [], 0, 0, at
                    if held >= UNIT_BYTES:
                        yield made(blocks)
                        blocks, held = [], 0
            if begin < batch.num_rows:
                rows.append(batch.slice(begin))
        if rows:
            blocks.append(_block(rows))
        if blocks:
            yield made(blocks)

    names = ["kind", "bucket", "unit", "used", "payload"]
    folder = f"{shared_table_root(docs.sparkSession)}/llm-{uuid.uuid4().hex}/blocks"
    docs.select("doc_id", "text").mapInArrow(run, "kind int, bucket int, unit long, used long, payload binary").write.partitionBy(
        "kind").parquet(folder)
    return folder


def _pair_bucket(pairs: np.ndarray, buckets: int) -> np.ndarray:
    """A pair's bucket, from both of its ids: pairs of a very frequent first
    id are spread like any others."""
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _summed(group: pd.DataFrame, path: str) -> pd.DataFrame:
    """For each unit the corpus counts of its words and their ids, in their
    order; tokens and distinct words of the bucket are in its first row."""
    parts = [expanded(p) for p in group["payload"]]
    size = np.concatenate([p[0] for p in parts])
    ends = np.concatenate([[0], np.cumsum(size)])
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(p[1] for p in parts))])
    found = words.dictionary_encode()
    own, words = found.indices.to_numpy(), found.dictionary
    total = np.bincount(own, np.concatenate([p[2] for p in parts])).astype(np.int64)
    ids, n, flat = worker_ids(path), [], []
    for at in range(0, len(words), FEW_WORDS):
        each = [ids[w] for w in words.slice(at, FEW_WORDS).to_numpy(zero_copy_only=False)]
        n.append(np.fromiter(map(len, each), np.int64, len(each)) // 4)
        flat.append(np.frombuffer(b"".join(each), "<u4").astype(np.uint16))  # IDS < 2**16
    n, flat = np.concatenate(n), np.concatenate(flat)
    out, at = [], 0
    for unit, part in zip(group["unit"], parts):
        mine = own[at:at + len(part[0])]
        at += len(mine)
        out.append((int(group["bucket"].iloc[0]), int(unit), stored(total[mine], n[mine].astype(np.uint32), _chosen(flat, n, mine)), 0, 0))
    out[0] = (*out[0][:3], int(total.sum()), int((total > 0).sum()))
    return pd.DataFrame(out, columns=["bucket", "unit", "payload", "tokens", "words"])


def _lines(docs: pd.DataFrame, replies: pd.DataFrame, buckets: int, tokens: int, distinct: int, ends: int) -> pd.DataFrame:
    """The lines of ids of a unit's blocks with what is known of their documents
    but their score, and the pairs of ids of its training documents by bucket."""
    parts = [expanded(p) for p in replies.sort_values("bucket")["payload"]]
    counts, n, flat = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3))
    n = n.astype(np.int64)
    logs = np.log10((np.append(counts, ends) + 0.1) / (tokens + 0.1 * (distinct + 1)))
    out, pairs = [], []
    for payload in docs["payload"]:
        ids, null, held, sizes, numbers = expanded(payload)
        text = np.repeat(np.arange(len(ids)), sizes)
        base = np.bincount(text, logs[numbers], len(ids)) + logs[-1]
        known = np.bincount(text, counts[numbers] > 0, len(ids)).astype(np.int64) + int(ends > 0)
        line = _chosen(flat, n, numbers).astype(np.uint16)
        size = np.bincount(text, n[numbers], len(ids)).astype(np.int64)
        out.append((LINES, -1, stored(line, size, held, ids, null, sizes.astype(np.int64) + 1, known, base)))
        own = line[np.repeat(~held, size)].astype(np.uint32)
        line = np.concatenate([[np.uint32(END_ID)], np.insert(own, np.cumsum(size[~held]), END_ID)])
        pairs.append(line[:-1] * np.uint32(IDS) + line[1:])  # IDS**2 < 2**32
    pairs, n = np.unique(np.concatenate(pairs), return_counts=True)
    bucket = _pair_bucket(pairs, buckets)
    order = np.argsort(bucket, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(own):
            out.append((PAIRS, int(bucket[own[0]]), stored(pairs[own], n[own])))
    return pd.DataFrame(out, columns=["kind", "bucket", "payload"])


def _pair_sums(group: pd.DataFrame) -> pd.DataFrame:
    parts = [expanded(p) for p in group["payload"]]
    pairs, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    n = np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)
    return pd.DataFrame({"payload": [stored(pairs, n)]})


def gathered(docs: DataFrame, buckets: int, path: str) -> tuple[DataFrame, DataFrame, int]:
    """(lines, pairs, tokens): tables with a payload, in the shared folder, and
    the number of training tokens."""
    spark = docs.sparkSession
    blocks = spark.read.schema("bucket int, unit long, used long, payload binary, kind int").parquet(blocked(docs, buckets))
    replies = written(blocks.where(F.col("kind") == WORDS).groupBy("bucket").applyInPandas(
        lambda g: _summed(g, path), "bucket int, unit long, payload binary, tokens long, words long"), "replies")
    ends = int(blocks.agg(F.sum("used")).first()[0] or 0)
    tokens, distinct = (int(x or 0) for x in replies.agg(F.sum("tokens"), F.sum("words")).first())
    tokens, distinct = tokens + ends, distinct + int(ends > 0)
    folder = f"{shared_table_root(spark)}/llm-{uuid.uuid4().hex}/lines"
    (blocks.where(F.col("kind") == DOCS).select("unit", "payload").groupBy("unit")
     .cogroup(replies.select("unit", "bucket", "payload").groupBy("unit"))
     .applyInPandas(lambda d, r: _lines(d, r, buckets, tokens, distinct, ends), "kind int, bucket int, payload binary")
     .write.partitionBy("kind").parquet(folder))
    table = spark.read.schema("bucket int, payload binary, kind int").parquet(folder)
    pairs = written(table.where(F.col("kind") == PAIRS).groupBy("bucket").applyInPandas(_pair_sums, "payload binary"), "pairs")
    return table.where(F.col("kind") == LINES).select("payload"), pairs, tokens


def id_lines(docs: DataFrame, path: str) -> DataFrame:
    """payload: lines of the ids of the training documents among ``docs``
    (doc_id, text), for :func:`dealt`."""
    def run(batches):
        ids = worker_ids(path)
        for few in sliced(batches):
            each = [ids.of(text) for text in few.column(0).to_pylist()]
            size = np.array([len(x) // 4 for x in each], np.int64)
            flat = np.frombuffer(b"".join(each), "<u4").astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([stored(flat, size, np.zeros(len(each), bool))], pa.binary())], ["payload"])

    fold = F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(FOLDS))
    return docs.where(F.col("doc_id").isNull() | (fold != 0)).select("text").mapInArrow(run, "payload binary")


def vocabulary(pairs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(model id of every tokenizer id, log10 share of each id among those of
    the last model id). The end is the last but one. At most IDS rows come to
    the driver."""
    def run(frames):
        for frame in frames:
            total = np.zeros(IDS, np.int64)
            for payload in frame["payload"]:
                own, n = expanded(payload)
                total += np.bincount(own % np.uint32(IDS), n, IDS).astype(np.int64)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"id": at, "n": total[at]})

    found = pairs.select("payload").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(IDS)
    for r in found:
        count[r["id"]] = r["n"]
    count[END_ID] = 0
    model = np.full(IDS, net.SPACE - 1, np.int32)
    top = np.argsort(-count, kind="stable")[:net.SPACE - 2]
    model[top] = np.arange(len(top))
    model[END_ID] = net.SPACE - 2
    others = model == net.SPACE - 1
    share = np.zeros(IDS)
    share[others] = np.log10((count[others] + 0.5) / (count[others] + 0.5).sum())
    return model, share


def pair_counts(pairs: DataFrame, model: np.ndarray) -> np.ndarray:
    """How often model id j follows i, for all i and j: SPACE**2 numbers."""
    shared = pairs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        to = shared.value.astype(np.int64)
        for frame in frames:
            total = np.zeros(net.SPACE ** 2)
            for payload in frame["payload"]:
                own, n = expanded(payload)
                cell = to[own // np.uint32(IDS)] * net.SPACE + to[own % np.uint32(IDS)]
                total += np.bincount(cell, n, net.SPACE ** 2)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"cell": at, "n": total[at].astype(np.int64)})

    found = pairs.select("payload").mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(net.SPACE ** 2)
    out[found["cell"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(net.SPACE, net.SPACE)


def dealt(docs: DataFrame, model: np.ndarray, parts: int, rounds: int, path: str) -> str:
    """The folder of a table round, part, payload: all windows of all training
    documents, by part, in a folder per round. docs: documents, or their stored
    lines (payload)."""
    lines = id_lines(docs, path) if "text" in docs.columns else docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        to_model = shared.value
        for payload in (p for batch in batches for p in batch.column(0).to_pylist()):
            flat, size, out = expanded(payload)[:3]
            texts = np.split(to_model[flat], np.cumsum(size)[:-1])
            texts = [text for text, no in zip(texts, out) if not no]
            lines, held = [], 0
            for at, text in enumerate(texts, 1):
                lines.append(text)
                held += len(text)
                if held < CHUNK * net.STRIDE and at < len(texts) and at % SLICE_ROWS:
                    continue
                rows = net.packed_windows(lines, net.SPACE - 2)
                payloads = [squeezed(rows[i:i + CHUNK]) for i in range(0, len(rows), CHUNK)]
                part = [zlib.crc32(p) % parts for p in payloads]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p % rounds for p in part], pa.int32()), pa.array(part, pa.int32()),
                     pa.array(payloads, pa.binary())], ["round", "part", "payload"])
                lines, held = [], 0

    rows = lines.select("payload").mapInArrow(run, "round int, part int, payload binary")
    folder = f"{shared_table_root(docs.sparkSession)}/llm-{uuid.uuid4().hex}/windows"
    rows.repartition(min(parts, shuffle_partitions(docs.sparkSession)), "part").write.partitionBy("round").parquet(folder)
    return folder


def _added(payloads) -> bytes:
    """The sum of (windows, steps, arrays), each weighted by its windows."""
    whole, steps, total = 0, 0, None
    for n, step, arrays in map(expanded, payloads):
        whole, steps = whole + n, max(steps, step)
        total = arrays if total is None else {k: total[k] + a for k, a in arrays.items()}
    return stored(whole, steps, total)


def averaged(weights: DataFrame, groups: int) -> tuple[int, dict] | None:
    """(steps, arrays): the mean of the parts' arrays. The sums of ``groups``
    groups of parts come to the driver."""
    sums = weights.groupBy(F.pmod(F.xxhash64("part"), F.lit(groups)).alias("group")).applyInPandas(
        lambda g: pd.DataFrame({"payload": [_added(g["payload"])]}), "payload binary").collect()
    if not sums:
        return None
    whole, steps, total = expanded(_added([r["payload"] for r in sums]))
    return steps, {k: (a / whole).astype(np.float32) for k, a in total.items()}


def fitted(docs: DataFrame, model: np.ndarray, counts: np.ndarray, path: str, steps: int) -> dict:
    """The attention weights after all training documents."""
    spark = docs.sparkSession
    w = net.start(net.classes(counts))
    state, places = net.moments(w), int(counts.sum())
    if not places:
        return w
    parts = -(-places // PART_IDS)
    rounds = math.isqrt(parts - 1) + 1
    passes = math.ceil(steps / (rounds * math.ceil(places / parts / net.STRIDE / net.BATCH)))
    folder = dealt(docs, model, parts, rounds, path)
    windows = spark.read.schema("part int, payload binary, round int").parquet(folder)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((w, state))

        def fit(group: pd.DataFrame) -> pd.DataFrame:
            rows = np.concatenate([expanded(p)[0] for p in sorted(group["payload"])])
            own, after = net.trained(*shared.value, rows, turn / rounds, (turn + 1) / rounds, net.SPACE - 2, passes)
            arrays = {("w", k): a for k, a in own.items() if k != "place"}
            arrays |= {(m, k): a for m in ("first", "second") for k, a in after[m].items()}
            arrays = {k: a * np.float64(len(rows)) for k, a in arrays.items()}
            return pd.DataFrame({"part": group["part"].iloc[:1], "payload": [squeezed(len(rows), after["steps"], arrays)]})

        found = averaged(windows.where(F.col("round") == turn).groupBy("part").applyInPandas(
            fit, "part int, payload binary"), math.isqrt(parts // rounds) + 1)
        if found:  # no part of a small round may have windows
            at, mean = found
            state = {"steps": at} | {m: {k: mean[m, k] for k in state[m]} for m in ("first", "second")}
            w = {k: a if k == "place" else mean["w", k] for k, a in w.items()}
    return w


def train(docs: DataFrame, pairs: DataFrame, path: str, steps: int = STEPS) -> dict:
    """The model: attention weights, vocabulary and pair model."""
    model, share = vocabulary(pairs)
    counts = pair_counts(pairs, model)
    w = fitted(docs, model, counts, path, steps)
    unigram = counts.sum(axis=0) + 0.5
    unigram /= unigram.sum()
    rows, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
    follow = (counts + np.maximum(1, kinds) * unigram) / (rows + np.maximum(1, kinds))
    return {"weights": w, "model": model, "share": share, "pairs": (PAIR_SHARE * follow).astype(np.float32)}


def log_probability(model: dict, lines: list[np.ndarray]) -> np.ndarray:
    """log10 of the probability of each line of tokenizer ids and its end."""
    out = np.array([model["share"][line].sum() for line in lines])
    own = [model["model"][line] for line in lines]
    at = 0
    while at < len(own):  # lines in groups of about BATCH windows
        upto, size = at, 0
        while upto < len(own) and (upto == at or size < BATCH):
            size += len(own[upto]) // net.STRIDE + 1
            upto += 1
        x, y, counts = net.windows(own[at:upto], net.SPACE - 2)
        logs = np.empty(y.shape)
        for i in range(0, len(x), BATCH):
            p = net.probability(model["tables"], x[i:i + BATCH], y[i:i + BATCH]) * np.float32(1 - PAIR_SHARE)
            p += model["pairs"][x[i:i + BATCH, net.CONTEXT:], y[i:i + BATCH]]
            logs[i:i + BATCH] = np.log10(p)
        logs[~counts] = 0
        n = np.array([len(line) // net.STRIDE + 1 for line in own[at:upto]])
        out[at:upto] += np.add.reduceat(logs.sum(axis=1), np.concatenate([[0], np.cumsum(n)[:-1]]))
        at = upto
    return out


def _scored(payload: bytes, model: dict, tokens: int) -> pd.DataFrame:
    flat, size, held, ids, null, n_tokens, known, base = expanded(payload)
    net.keep_freed()
    texts = np.split(flat, np.cumsum(size)[:-1])
    scores = [log_probability(model, texts[i:i + SLICE_ROWS]) for i in range(0, len(texts), SLICE_ROWS)]
    return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "held_out": held, "n_tokens": n_tokens, "n_known": known,
                         "train_tokens": tokens, "base_score": base, "score": np.concatenate(scores)}).assign(
        doc_id=lambda f: f["doc_id"].mask(null))


def scored(docs: DataFrame, path: str, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row. path: the tokenizer's file, on every executor."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))
    lines, pairs, tokens = gathered(docs, max(shuffle_partitions(spark), text_bytes(docs) // BUCKET_BYTES), path)
    model = spark.sparkContext.broadcast(train(lines, pairs, path, steps))  # a few MB at any size

    def run(frames):
        own = model.value | {"tables": net.tables(model.value["weights"])}
        yield from (_scored(p, own, tokens) for frame in frames for p in frame["payload"])

    return lines.mapInPandas(
        run,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark, sf_dir: str, tokenizer: str = "word_bpe_49k.json") -> DataFrame:
    """All documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, public_tokenizers.path(tokenizer))

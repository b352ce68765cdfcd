"""From crawled documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of documents; the last returns the pieces of the sequences.

Stages keep rows apart by id and a hash of the text, so rows with one id and
different texts are rows of their own; of rows that agree in id and text one
stays where copies go. Null texts are empty texts, null ids and sources are
values of their own, further columns are carried along, and an empty table
gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import exact_dedup, mixing, packing, quality, simhash
from basketry.llm.shared import plain_text, written

WHITE_SPACE = " \t\n\x0b\f\r"


def _kept(docs: DataFrame, keepers: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``docs`` (which has ``keys``) that ``keepers`` names, one
    for each; ``copies`` says how many rows of ``docs`` a keeper stands for.
    The keys have an id, so no key is frequent."""
    columns = [c for c in docs.columns if c not in keys]
    keepers = keepers.select(*[F.col(k).alias(f"{k}_kept") for k in keys], F.col("copies").alias("__copies"))
    same = [docs[k].eqNullSafe(keepers[f"{k}_kept"]) for k in keys]
    rows = docs.join(keepers, same)
    if not keepers.where("__copies > 1").limit(1).count():
        return rows.select(*columns)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*columns)))
    repeated = rows.where("__copies > 1").withColumn("__nth", nth).where("__nth = 1")
    return rows.where("__copies = 1").select(*columns).unionByName(repeated.select(*columns))


def good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def distinct(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: the owner of each group of equal texts stays."""
    owners = written(exact_dedup.owners(docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))), "owners")
    body = F.encode(F.translate(plain_text(), WHITE_SPACE, ""), "UTF-8")
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__body": F.sha2(body, 256),
                              "__chars": F.length(plain_text()).cast("long")})
    return _kept(keyed, owners.select(F.col("keep_id").alias("__id"), F.col("text_sha256").alias("__body"),
                                      F.col("keep_chars").alias("__chars"), F.col("ties").alias("copies")),
                 ["__id", "__body", "__chars"])


def different(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays, the one with the
    smallest id."""
    rows = written(simhash.linked(written(simhash.fingerprints(docs), "fingerprints")), "linked")
    first = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_id")
    firsts = rows.groupBy("root").agg(F.min(first).alias("first")).select("first.doc_id", "first.text_id")
    copies = rows.groupBy("doc_id", "text_id").agg(F.count("*").alias("copies"))
    same = copies["doc_id"].eqNullSafe(firsts["doc_id"]) & (copies["text_id"] == firsts["text_id"])
    keepers = written(copies.join(firsts, same, "left_semi").select(
        F.col("doc_id").alias("__id"), F.col("text_id").alias("__text"), "copies"), "keepers")
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__text": F.xxhash64(plain_text())})
    return _kept(keyed, keepers, ["__id", "__text"])


def mixed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a document comes as often as the mix takes all of it, and once
    more with its first words, as they stand, if the mix takes a part of it
    besides (about one document a source and turn)."""
    rows = mixing.mixed(docs)
    taken = written(rows.groupBy(F.col("doc_id").alias("__doc"), F.col("h").alias("__h"), F.col("source").alias("__source"),
                                 F.col("size").alias("__size"))
                    .agg(F.expr("sum(taken) div count(*)").alias("__taken")).where("__taken > 0"), "taken")
    columns = docs.columns
    h = F.xxhash64("doc_id", F.crc32(F.encode(plain_text(), "UTF-8")))
    keyed = docs.withColumn("__own", h)
    rows = keyed.join(taken, keyed["doc_id"].eqNullSafe(taken["__doc"]) & (keyed["__own"] == taken["__h"])
                      & keyed["source"].eqNullSafe(taken["__source"]))
    whole, part = F.expr("__taken div __size"), F.expr("cast(__taken % __size as int)")
    rows = rows.withColumn("__part", F.explode(F.concat(
        F.array_repeat(F.lit(0), whole.cast("int")),
        F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))))
    # words with the white space before them: the text's own beginning, byte for byte
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.greatest("__part", F.lit(1))), "")
    rows = rows.withColumn("text", F.when(F.col("__part") > 0, first).otherwise(F.col("text")))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("__part") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*columns)


def sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good), ("exact_dedup", distinct), ("simhash", different), ("mixing", mixed), ("packing", sequences)]

#: No SQL: a trained classifier and a tokenizer decide.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each read from the last one's table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name)
    return docs

"""Small frames with the awkward cases, and readers of the test tables."""

import duckdb

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))


def rows():
    """Null ids, texts and sources; empty, blank and very long texts; equal
    texts, repeated rows, one id with two texts."""
    texts = [
        (0, "The quick brown fox jumps over the lazy dog near the river bank", "s1"),
        (1, "The  quick brown fox\njumps over the lazy dog near the river bank", "s1"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank", "s2"),
        (3, None, "s1"), (4, "", None), (5, " \t\n", "s2"), (6, "één ünïcode tekst – 漢字 😀 hier", "s3"),
        (7, LONG, "s3"), (8, LONG + " end", "s1"), (None, "no id here", "s2"), (None, "no id here either", None),
        (9, "twice the same row", "s1"), (9, "twice the same row", "s1"), (10, "one id", "s2"), (10, "two texts", "s2"),
        (11, "Der Der Der Der Der Der Der", "s4"), (12, "a", "s4"), (13, "tie", "s4"), (14, "t ie", "s4"), (15, "ti e", "s4"),
        (16, "zero\x00byte and \x0bvertical", "s1"),
    ]
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df, **columns):
    """``df`` with more columns, named like an operator's own."""
    from pyspark.sql import functions as F
    return df.withColumns({k: F.lit(v) for k, v in columns.items()})


def table(sf_dir, name="documents"):
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()


def texts(sf_dir):
    """(doc_id, text) by id."""
    return sorted((r[0], r[1] or "") for r in table(sf_dir))


def split(text):
    """Words, with A-Z lower-cased, as bytes."""
    return (text or "").encode().lower().split()

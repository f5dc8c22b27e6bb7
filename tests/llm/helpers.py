"""Tables that every operator must cope with."""

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "word " * 40_000 + "x" * 100_000


def documents(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    rows = [(i, t, langs[i], f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def odd(spark, texts=()):
    """Nulls in every column, empty and very long texts, repeated rows, and columns with the names
    that operators use themselves."""
    rows = [
        (0, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, LONG, "en", "a", len(LONG)),
        (3, "Same words here as there, again and again.", "en", "a", 10),
        (3, "Same words here as there, again and again.", "en", "a", 10),
        (None, "no id but some words in a row", "de", "b", 5),
        (4, " \n\t ", None, "b", 4),
        (5, "é ü 日本語 \U0001f600 \x00 \r\n x", "fr", None, 9),
        *((10 + i, t, "en", "c", len(t)) for i, t in enumerate(texts)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = ["row", "result", "id", "key", "node", "n", "spans", "score", "kept", "label", "fingerprint", "item", "copy"]
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in clashing))


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tables(spark, folder, **frames):
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)

"""Awkward rows that every operator must take: nulls, empty, long, repeated, odd names."""

from pyspark.sql import functions as F

LONG = "word soup number " * 4000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and then some more words follow here", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, LONG, "en", None),
    (5, "same text twice in the table with enough words to count as a text", None, "b"),
    (5, "same text twice in the table with enough words to count as a text", None, "b"),
    (6, "same text twice in the table with enough words to count as a text", "en", None),
    (None, "no id here but still a text of more than ten words for the rules", "en", "a"),
    (None, None, None, None),
    (7, "ß Ünï çødé \U0001f600 \\ \x00   end", "de", "ü"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use for themselves.
CLASHES = ["size", "shard", "fp", "key", "doc", "twin", "n", "blob", "findings", "quality", "_id", "_u", "label", "bytes", "spans"]


def awkward(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, limit=None):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

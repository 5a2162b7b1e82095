"""A training corpus from raw documents: quality, near-duplicates, benchmark leaks, mixture, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last return the
columns of ``documents``; between stages rows are written to the shared folder and read again. Near-duplicates are
linked by five-word shingle sets with an exactly checked Jaccard similarity of 0.8 or more, and the one with the
smallest id stays. The mixture repeats a document as often as it is to be read, so the last stage deals out repetitions,
each with a slot of its own. Every stage gives no rows for an empty table. A text is one value of a row: a task holds some
hundred bytes for each word of its longest text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import decontaminate, mixing, quality, sharding, simhash
from ledgerline.llm.common import store

SHARDS = 24


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text passes the base rules and the compression bands. Null, empty and very short texts go;
    repeated rows each stay or go alike. Columns of any name are left alone."""
    return quality.with_quality(docs, into="_quality").where("_quality.kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id, of repeated rows one. Null and empty texts are
    one group; a null id stands for its group only if that has no other."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that hold no benchmark item. Null and empty texts and items match nothing and stay; repeated rows all stay
    or all go; without items every row stays."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.with_matches(docs, benchmark, into="_matches").where(F.size("_matches") == 0).select(*docs.columns)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's target asks, up to three times. A null source is one of its own; null and empty
    texts have no words, so their rows are taken or not without weight; repeated rows count each."""
    mixed = mixing.with_repeats(docs, into="_mix").where("_mix.repeats > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("_mix.repeats").cast("int")))
    return mixed.select(*docs.columns, again.alias("_again")).drop("_again")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, sizes near equal. Null texts are empty, null ids come first, repeated rows get slots of
    their own; equal texts are neighbours."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mixture", source_mixture),
    ("shards", shards),
]

#: Compression, fingerprints and latent vectors have no form in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

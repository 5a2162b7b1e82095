import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import joins
from ledgerline.operators.joins import fits_broadcast, lookup_join, spread_join
from ledgerline.operators.ordered import has_large_group, large_groups, ordered_columns
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with two thirds of the rows, small keys, and a NULL value here and there."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.col("id").alias("at"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 2).alias("v"),
    )


def test_split_and_plain_agree(skewed):
    wanted = dict(lag={"a": F.col("v"), "b": F.col("at")}, lead={"c": F.col("v")}, running={"d": F.col("v")})
    plain = ordered_columns(skewed, ["k"], ["at"], split=False, **wanted)
    split = ordered_columns(skewed, ["k"], ["at"], split=True, slices=16, **wanted)
    assert rows(plain) == rows(split)


def test_size_estimate_chooses_the_strategy(skewed):
    assert has_large_group(skewed, ["k"], 500)
    assert not has_large_group(skewed, ["k"], 700)
    assert [r["k"] for r in large_groups(skewed, ["k"], 500).collect()] == ["hot"]


def test_numbers_over_the_whole_frame(spark):
    numbered = ordered_columns(spark.range(1000), [], ["id"], running={"n": F.lit(1)}, slices=7)
    assert numbered.filter("n <> id + 1").count() == 0


def test_identical_rows_are_split_too(spark):
    copies = spark.range(500).select(F.lit("x").alias("k"), F.lit(1).alias("at"))
    numbered = ordered_columns(copies, ["k"], ["at"], running={"n": F.lit(1)}, split=True, slices=5)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 501))


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, at int")
    for split in (False, True):
        out = ordered_columns(df, ["k"], ["at"], lag={"p": F.col("at")}, split=split, slices=3)
        assert rows(out) == rows(spark.createDataFrame([(None, 1, None), (None, 2, 1), ("a", 1, None)], "k string, at int, p int"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4)], "k string, w int")
    plain = skewed.join(lookup, ["k"], how)
    assert rows(spread_join(skewed, lookup, ["k"], how, limit=100)) == rows(plain)
    assert rows(lookup_join(skewed, lookup, ["k"], how, max_bytes=2, limit=100)) == rows(plain)


def test_lookup_is_broadcast_only_within_its_bound(spark, skewed, capsys):
    lookup = spark.range(50).select(F.concat(F.lit("k"), "id").alias("k"))
    lookup_join(skewed, lookup, ["k"]).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lookup_join(skewed, lookup, ["k"], max_bytes=50).explain()
        assert "SortMergeJoin" in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_lookup_of_many_narrow_rows_is_broadcast(spark):
    dimension = spark.range(600_000).select(F.col("id").alias("k"), F.concat(F.lit("55"), "id").alias("phone"), F.lit("GOLD").alias("kind"))
    assert fits_broadcast(dimension) and not fits_broadcast(dimension, max_bytes=2**20)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equal_rows_and_null_keys_spread(spark, how):
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([("hot", 1), (None, 2)], "k string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(left, right, ["k"], how, limit=200)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(joined) == rows(left.join(right, ["k"], how))
    assert max(sizes) < 0.6 * sum(sizes) and len(sizes) > 2


@pytest.mark.parametrize("how", ["inner", "left"])
def test_tasks_of_a_shuffle_join_grow_with_its_rows(spark, monkeypatch, how):
    """However few shuffle partitions the session has, a task sorts about ``JOIN_ROWS`` rows."""
    monkeypatch.setattr(joins, "JOIN_ROWS", 100)
    spread = spark.range(6000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("v"))
    hot = spark.range(6000, 9000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 1500, 2).select(F.col("id").alias("k"), (F.col("id") * 3).alias("w"))
    for left, limit in ((spread, 10_000), (spread.unionByName(hot), 1000)):
        plain = sorted(left.join(right, "k", how).collect(), key=str)
        joined = spread_join(left, right, ["k"], how, limit=limit)
        assert sorted(joined.collect(), key=str) == plain
        plan = joined._jdf.queryExecution().executedPlan().toString()
        counts = [int(n) for n in re.findall(r"hashpartitioning\(k#\d+L[^)]*, (\d+)\), REPARTITION_BY_NUM", plan)]
        assert counts and min(counts) >= left.count() // 100 * 0.8, plan


def test_copies_of_few_texts_are_measured_before_a_broadcast(spark, tmp_path):
    """A dictionary makes the file more than 8 times smaller than its rows; the size of the file must not pass for theirs."""
    parts = spark.range(400_000).select(F.col("id").alias("k"), F.concat(F.lit("x" * 60), F.col("id") % 3).alias("kind"))
    parts.coalesce(1).write.parquet(str(tmp_path / "parts"))
    stored = spark.read.parquet(str(tmp_path / "parts"))
    size = sum(f.stat().st_size for f in (tmp_path / "parts").glob("*.parquet"))
    assert 400_000 * 60 > 8 * size
    assert not fits_broadcast(stored, max_bytes=400_000 * 60)

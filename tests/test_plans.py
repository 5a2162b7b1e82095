"""What the physical plans must and must not contain."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PYTHON_IS_NEEDED = {"knn_vectors", "knn_vectors_approximate", "session_arrays"}
LAZY = [
    "product_performance", "revenue_by_category_month", "on_time_payments", "filter_options", "decode_category", "price_rules",
    "invoice_amounts", "subscription_flags", "ticket_sla", "validate_ids", "calendar", "change_feed", "scd1_late_rows",
    "scd2_changes", "duplicate_keys", "quarantine", "key_checks", "inject_faults", "session_timeline", "scatter_points",
    "grid_cells", "lookup_random_pick", "knn_grid", "fact_subscription", "cross_join_schedule",
]


def plan(spark, name, mode="formatted"):
    out = io.StringIO()
    with redirect_stdout(out):
        entry.queries()[name](spark, SF).explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_row_functions_and_no_cross_joins(spark, name):
    text = plan(spark, name)
    for unwanted in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert unwanted not in text, unwanted


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "invoice_amounts")
    lines = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert any("struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in line for line in lines)


def test_star_joins_broadcast_their_checked_dimensions(spark):
    text = plan(spark, "product_performance", "simple")
    assert text.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in text


def test_clustered_read_is_pruned(spark):
    frame = entry.queries()["clustered_write_pruned_read"](spark, SF)
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    assert "GreaterThanOrEqual(day,1997-03-01)" in out.getvalue()
    path = frame.inputFiles()[0].rsplit("/", 1)[0]
    whole = spark.read.parquet(path)
    assert frame.agg({"n": "sum"}).first()[0] < whole.count()
    # Row groups: their statistics do not overlap the season, but for those at its edges.
    import datetime as dt

    import pyarrow.parquet as pq

    hit = total = 0
    for file in frame.inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file:")).metadata
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(0).statistics
            total += 1
            hit += s.min <= dt.date(1997, 5, 31) and s.max >= dt.date(1997, 3, 1)
    assert hit <= max(1, total // 2)


def test_partition_filter_reaches_the_table_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerline.streaming import ingest

    days = spark.range(4).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("partition_date"))
    days.write.partitionBy("partition_date").parquet(str(tmp_path / "t"))
    wanted = F.col("partition_date") == F.lit("2024-01-02").cast("date")
    seen = []
    stream = ingest.table_stream(spark, str(tmp_path / "t"), days.schema, where=wanted)
    query = stream.writeStream.foreachBatch(lambda batch, _: seen.append(batch.count())).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    out = io.StringIO()
    with redirect_stdout(out):
        query.explain(True)
    assert sum(seen) == 1 and "partition_date" in out.getvalue().split("PartitionFilters")[-1][:200]


def test_amounts_start_few_jobs_before_the_action(spark):
    """Beyond one job for the schema of each table it opens."""
    def jobs(group, build):
        spark.sparkContext.setJobGroup(group, group)
        try:
            build()
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext._jsc.clearJobGroup()

    opened = ["lineitem", "orders", "part", "part", "events", "customer"]
    schemas = jobs("schemas", lambda: [spark.read.parquet(f"{SF}/{t}.parquet") for t in opened])
    assert jobs("planning", lambda: entry.queries()["invoice_amounts"](spark, SF)) - schemas <= 4


def test_history_shuffles_twice(spark):
    """Once to remove same-instant changes, once by key; all later steps reuse that partitioning."""
    assert plan(spark, "scd2_changes", "simple").count("Exchange hashpartitioning") == 2

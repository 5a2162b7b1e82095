import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline import workspace
from ledgerline.operators import changes as ch
from ledgerline.operators import packing
from ledgerline.operators.metrics import throughput
from ledgerline.sources import files, tables
from ledgerline.streaming import apply, ingest
from tests.conftest import rows

EVENTS = "k string, seq int, v string, op string"


def test_workspace_uses_the_configured_folder(spark):
    assert workspace.new_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workspace.new_dir(spark, "x") != workspace.new_dir(spark, "x")


def test_each_file_is_loaded_once(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.range(30)
    df.repartition(3).write.parquet(landing)
    ingest.ingest_files(spark, landing, df.schema, target, checkpoint)
    assert spark.read.parquet(target).count() == 30
    ingest.ingest_files(spark, landing, df.schema, target, checkpoint)
    assert spark.read.parquet(target).count() == 30
    spark.range(30, 40).coalesce(1).write.mode("append").parquet(landing)
    ingest.ingest_files(spark, landing, df.schema, target, checkpoint, max_files=1)
    out = spark.read.parquet(target)
    assert out.count() == 40 and out.select("_metadata_file_path").distinct().count() == 4
    assert out.filter("bronze_ts is null or _metadata_file_modification_time is null").count() == 0


def test_directory_names_are_not_columns(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in" / "day=1"))
    ingest.ingest_files(spark, str(tmp_path / "in"), "id long", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert "day" not in spark.read.parquet(str(tmp_path / "out")).columns


def test_csv_stream_one_file_per_batch(spark, tmp_path):
    tables.export_csv(spark.range(20).repartition(4), str(tmp_path / "in"))
    stream = ingest.file_stream(spark, str(tmp_path / "in"), "id long", "csv", max_files=1, options={"header": "true"})
    seen = []
    ingest.run_batches(stream, lambda batch, n: seen.append(batch.count()), str(tmp_path / "cp"))
    assert len(seen) == 4 and sum(seen) == 20


def test_bytes_limit_makes_several_batches(spark, tmp_path):
    spark.range(4000).repartition(4).write.parquet(str(tmp_path / "in"))
    stream = ingest.table_stream(spark, str(tmp_path / "in"), "id long", where=F.col("id") >= 2000, max_bytes=1000)
    seen = []
    ingest.run_batches(stream, lambda batch, n: seen.append(batch.count()), str(tmp_path / "cp"))
    assert len(seen) == 4 and sum(seen) == 2000


def test_timed_run_stops(spark, tmp_path):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    query = ingest.run_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), name="timed", available_now=False)
    ingest.run_for(query, 2)
    assert not query.isActive


def test_stored_partition_date(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 10, 1, 5)), (2, dt.datetime(2024, 10, 2))], "id int, at timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = ingest.file_stream(spark, str(tmp_path / "in"), df.schema).withColumn("partition_date", F.to_date("at"))
    ingest.run_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), partition_by=["partition_date"])
    out = spark.read.parquet(str(tmp_path / "out"))
    # A malformed date in the list is NULL, not an error.
    wanted = [F.lit(d).try_cast("date") for d in ("2024-10-01", "2024-30-09", "2024-10-03")]
    assert out.filter(F.col("partition_date").isin(*wanted)).count() == 1


def test_reference_csv_drops_byte_order_mark(spark, tmp_path):
    path = tmp_path / "states.csv"
    path.write_text("﻿codigo_uf;uf;latitude\n35;SP;-22.19\n33;RJ;-22.25\n", encoding="utf-8")
    out = files.reference_csv(spark, str(path), "codigo_uf int, uf string, latitude double", sep=";")
    assert rows(out) == [(33, "RJ", -22.25), (35, "SP", -22.19)]


def test_rescue_of_extra_columns_and_bad_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "id int, v string, extra string")
    out = files.rescue_columns(df, ["ID", "v", "missing"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "a", None, '{"extra":"x"}'), (2, "b", None, None)]
    path = tmp_path / "bad.csv"
    path.write_text("id,v\n1,a\nnot-a-number,b\n")
    from pyspark.sql.types import StructType

    bad = files.csv_with_rescue(spark, str(path), StructType().add("id", "integer").add("v", "string"))
    assert rows(bad) == [(None, "b", "not-a-number,b"), (1, "a", None)]


def test_source_size_and_throughput(spark, tmp_path):
    spark.range(10).repartition(2).write.parquet(str(tmp_path / "t"))
    sizes = files.source_bytes(spark, str(tmp_path / "t") + "/*.parquet").first()
    assert sizes["files"] == 2 and sizes["bytes"] == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    df = spark.createDataFrame([("ab", None), ("é", 1)], "a string, b int")
    report = throughput(df, 2.0).first()
    assert report["rows"] == 2 and report["text_bytes"] == 5 and report["rows_a_second"] == 1
    assert report["mib_a_second"] == pytest.approx(2.5 / 2**20)
    assert report["gib_a_minute"] == pytest.approx(5 / 2**30 * 30)


@pytest.mark.parametrize("count", [0, 1, 100, 101, 1000])
def test_pack_then_unpack_is_identity(spark, count):
    df = spark.range(count).repartition(3).withColumn("v", F.concat(F.lit("x"), "id"))
    packed = packing.pack_batches(df, ["id", "v"], size=100)
    sizes = [r[0] for r in packed.select(F.size("body")).collect()]
    assert all(0 < n <= 100 for n in sizes) and sum(sizes) == count
    assert rows(packing.unpack_batches(packed)) == rows(df)


def test_versions_and_fallback(spark, tmp_path):
    root = str(tmp_path / "t")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert tables.ensure_table(spark, root, build).count() == 3
    assert tables.ensure_table(spark, root, build).count() == 3 and len(calls) == 1
    table = tables.VersionedTable(spark, root)
    assert table.publish(spark.range(9), version=1) == 1 and table.read().count() == 3
    assert tables.refresh(table, lambda: spark.range(5)).count() == 5 and table.versions() == [1, 2]
    assert table.read(1).count() == 3

    def broken():
        raise RuntimeError("source was rewritten")

    out, way = tables.refresh_with_fallback(broken, table, lambda: spark.range(7))
    assert way == "full" and out.count() == 7
    out, way = tables.refresh_with_fallback(lambda: spark.range(1), table, build)
    assert way == "incremental" and table.versions() == [1, 2, 3]
    # A version without its marker is invisible.
    spark.range(99).write.parquet(f"{root}/v=9")
    assert table.read().count() == 7


def test_periods(spark, tmp_path):
    days = [dt.date(2024, 1, 15), dt.date(2024, 3, 14), dt.date(2024, 3, 15), dt.date(2024, 9, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    tables.append_in_periods(df, str(tmp_path / "p"), "d")
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("d", "period")) == list(zip(days, [0, 0, 1, 3]))


def test_clustered_files_have_disjoint_ranges(spark, tmp_path):
    tables.write_clustered(spark.range(10_000).repartition(5), str(tmp_path / "c"), ["id"], files=4)
    spans = spark.read.parquet(str(tmp_path / "c")).groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    spans = sorted((r[1], r[2]) for r in spans)
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_file_count(spark, tmp_path):
    tables.write_table(spark.range(100), str(tmp_path / "w"), files=2)
    assert len(list((tmp_path / "w").glob("*.parquet"))) == 2


# ------------------------------------------------------------------ streams into history tables

def land(spark, path, lots):
    for i, lot in enumerate(lots):
        spark.createDataFrame(lot, EVENTS).coalesce(1).write.parquet(f"{path}/lot{i}")


LOTS = [
    [("a", 5, "x", "U"), ("b", 1, "p", "U"), (None, 1, "bad", "U")],
    [("a", 3, "w", "U"), ("b", 2, None, "D"), ("c", 1, "q", "U")],
    [("b", 4, "r", "U"), ("a", 4, None, "D"), ("c", 1, "q", "U")],
]


def test_stream_scd1_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    land(spark, tmp_path / "in", LOTS)
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)

    def run(checkpoint):
        stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
        apply.apply_scd1(stream, table, str(tmp_path / checkpoint), ["seq"], except_columns=["seq", "op"],
                         delete_when=F.col("op") == "D")
        return rows(ch.scd1_rows(table.read()).select("k", "v"))

    assert run("cp") == [("a", "x"), ("b", "r"), ("c", "q")]
    # A lost checkpoint brings all batches again; their sequences are known, so nothing changes.
    assert run("cp-again") == [("a", "x"), ("b", "r"), ("c", "q")]


def test_stream_scd2_with_late_rows_equals_batch(spark, tmp_path):
    land(spark, tmp_path / "in", LOTS)
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    log = tables.BucketedLog(spark, str(tmp_path / "log"), table)
    form = dict(except_columns=["seq", "op"])
    stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
    apply.apply_scd2(stream, table, log, str(tmp_path / "cp"), ["seq"], delete_when=F.col("op") == "D", **form)
    whole = spark.createDataFrame([r for lot in LOTS for r in lot], EVENTS)
    batch = ch.scd2_history(ch.scd2_log(whole, ["k"], ["seq"], delete_when=F.col("op") == "D", **form), ["k"])
    columns = ["k", "v", ch.START, ch.END]
    assert rows(table.read().select(columns)) == rows(batch.select(columns)) == [
        ("a", "w", 3, 4), ("a", "x", 5, None), ("b", "p", 1, 2), ("b", "r", 4, None), ("c", "q", 1, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_late_batches_give_the_batch_history(spark, tmp_path, seed):
    source = random.Random(seed)
    data = [(f"k{i % 3}", i, source.choice("xy"), "D" if source.random() < 0.2 else "U") for i in range(90)]
    late = data[:]
    source.shuffle(late)
    land(spark, tmp_path / "in", [late[i : i + 18] for i in range(0, 90, 18)])
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    log = tables.BucketedLog(spark, str(tmp_path / "log"), table)
    form = dict(except_columns=["seq", "op"])
    stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
    apply.apply_scd2(stream, table, log, str(tmp_path / "cp"), ["seq"], delete_when=F.col("op") == "D", **form)
    whole = spark.createDataFrame(data, EVENTS)
    batch = ch.scd2_history(ch.scd2_log(whole, ["k"], ["seq"], delete_when=F.col("op") == "D", **form), ["k"])
    columns = ["k", "v", ch.START, ch.END]
    assert rows(table.read().select(columns)) == rows(batch.select(columns))


def test_batches_write_only_what_their_keys_change(spark, tmp_path):
    """Untouched rows stay where they are; folds and readers put the parts together, deletes and late rows included."""
    source = random.Random(5)
    data = [(f"k{i % 40:02}", i, source.choice("xyz"), "D" if source.random() < 0.15 else "U") for i in range(400)]
    late = data[:200]
    source.shuffle(late)
    lots = [late] + [[r for r in data[200:] if r[0] in (f"k{n:02}", f"k{n + 20:02}")] for n in range(6)]
    land(spark, tmp_path / "in", lots)
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    log = tables.BucketedLog(spark, str(tmp_path / "log"), table)
    form = dict(except_columns=["seq", "op"])
    stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
    apply.apply_scd2(stream, table, log, str(tmp_path / "cp"), ["seq"], delete_when=F.col("op") == "D", **form)
    whole = spark.createDataFrame([r for lot in lots for r in lot], EVENTS)
    columns = ["k", "v", ch.START, ch.END]
    wanted = rows(ch.scd2_history(
        ch.scd2_log(whole, ["k"], ["seq"], delete_when=F.col("op") == "D", **form), ["k"]).select(columns))
    assert rows(table.read().select(columns)) == wanted
    assert table.read().columns == columns
    some = spark.createDataFrame([("k03",), ("k23",), ("none",)], "k string")
    assert rows(table.read(only=some, within=F.col("k") < "k2").select(columns)) == [r for r in wanted if r[0] == "k03"]
    sizes = [table._at(v).select("k").distinct().count() for v in range(1, 8)]
    assert sizes[0] == sizes[5] == 40 and max(sizes[1:5] + sizes[6:]) <= 2  # one fold on the way
    table.compact("fold")
    assert rows(table.read().select(columns)) == wanted and not table._current()[1]
    assert table.compact("again") is None


def test_bucket_that_becomes_empty(spark, tmp_path):
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=1)
    table.replace(spark.createDataFrame([("a", 1)], "k string, v int"), "one", [0])
    table.replace(spark.createDataFrame([], "k string, v int"), "two", [0])
    assert table.read() is None


def test_failed_batch_leaves_the_old_state(spark, tmp_path):
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    table.replace(spark.createDataFrame([("a", 1)], "k string, v int"), "one", [0, 1])
    broken = spark.createDataFrame([("a", 1)], "k string, v int").withColumn("v", F.raise_error(F.lit("x")).cast("int"))
    with pytest.raises(PySparkException):
        table.replace(broken, "two", [0, 1])
    assert rows(table.read().select("k", "v")) == [("a", 1)]


def test_new_checkpoint_and_second_stream_bring_news(spark, tmp_path):
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    lots = {"old": [("a", 1, "1", "U"), ("b", 1, "2", "U")], "new": [("a", 2, "NEW", "U"), ("c", 2, "3", "U")]}
    for name, lot in lots.items():
        land(spark, tmp_path / name, [lot])
        stream = ingest.file_stream(spark, str(tmp_path / name), EVENTS)
        apply.apply_scd1(stream, table, str(tmp_path / f"cp-{name}"), ["seq"], except_columns=["seq", "op"])
    assert rows(ch.scd1_rows(table.read()).select("k", "v")) == [("a", "NEW"), ("b", "2"), ("c", "3")]


def test_same_batch_is_applied_once(spark, tmp_path):
    land(spark, tmp_path / "in", LOTS)
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    for _ in range(2):
        stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS)
        apply.apply_scd1(stream, table, str(tmp_path / "cp"), ["seq"], except_columns=["seq", "op"])
    token = apply.batch_token(spark, str(tmp_path / "cp"), 0)
    assert table.has(token) and not table.has(token[:-1] + "1")


@pytest.mark.parametrize("kind", ["one", "two"])
def test_batch_of_only_invalid_rows_is_set_aside(spark, tmp_path, kind):
    land(spark, tmp_path / "in", [[(None, 1, "x", "U"), ("a", None, "y", "U")], [("a", 2, "z", "U"), (None, 9, "w", "U")]])
    table = tables.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
    if kind == "one":
        apply.apply_scd1(stream, table, str(tmp_path / "cp"), ["seq"], except_columns=["seq", "op"])
    else:
        log = tables.BucketedLog(spark, str(tmp_path / "log"), table)
        apply.apply_scd2(stream, table, log, str(tmp_path / "cp"), ["seq"], except_columns=["seq", "op"])
    assert [r["v"] for r in table.read().collect()] == ["z"]
    assert sorted(r["v"] for r in table.quarantined().collect()) == ["w", "x", "y"]


def test_null_keys_in_snapshots_and_feeds(spark):
    first = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    when = lambda day: F.lit(f"2024-01-0{day}").cast("timestamp")
    state = ch.scd2_snapshot(None, first, ["k"], when(1))
    state = ch.scd2_snapshot(state, first, ["k"], when(2))
    assert state.count() == 1 and ch.changes_between(first, first, ["k"]).count() == 0
    assert [r["v"] for r in ch.split_valid(first, ["k"])[1].collect()] == [2]
    with pytest.raises(ValueError, match="columns differ"):
        ch.changes_between(first, first.withColumn("w", F.lit(1)), ["k"])


def test_table_stream_keeps_partition_columns(spark, tmp_path):
    days = spark.range(6).select("id", F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).cast("date").alias("partition_date"))
    days.write.partitionBy("partition_date").parquet(str(tmp_path / "days"))
    wanted = F.col("partition_date") == F.lit("2024-01-02").cast("date")
    stream = ingest.table_stream(spark, str(tmp_path / "days"), days.schema, where=wanted)
    ingest.run_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(spark.read.schema(days.schema).parquet(str(tmp_path / "out"))) == rows(days.filter(wanted))
    tables.VersionedTable(spark, str(tmp_path / "versions")).publish(days)
    with pytest.raises(ValueError, match="versions"):
        ingest.table_stream(spark, str(tmp_path / "versions"), days.schema)


def test_index_names_hold_all_buckets():
    for buckets in ([0], [3, 799, 800, 5000], range(2000)):
        names = tables._index_names(buckets)
        assert sorted(b for n in names for b in tables._numbers(n)) == sorted(buckets)
        assert all(len(n) < 240 for n in names)


def test_expectations_on_a_stream(spark, tmp_path):
    from ledgerline.streaming import expect

    land(spark, tmp_path / "in", [[("a", 1, "x", "U"), ("b", None, "y", "U")], [("c", 5, None, "U")]])
    rules = {"has_seq": F.col("seq").isNotNull(), "short": F.length("v") < 3}

    def run(action, name):
        table = expect.ExpectedTable(spark, str(tmp_path / name))
        stream = ingest.file_stream(spark, str(tmp_path / "in"), EVENTS, max_files=1)
        expect.expect_stream(stream, rules, table, str(tmp_path / f"cp-{name}"), action)
        return table

    table = run("drop", "drop")
    assert [r["k"] for r in table.accepted().collect()] == ["a"]
    assert sorted((r["k"], r["failed_rules"]) for r in table.rejected().collect()) == [("b", ["has_seq"]), ("c", ["short"])]
    totals = table.metrics().groupBy("rule").agg(F.sum("passed"), F.sum("failed"))
    assert rows(totals) == [("has_seq", 2, 1), ("short", 2, 1)]
    assert run("warn", "warn").accepted().count() == 3
    with pytest.raises(PySparkException):
        run("fail", "fail")

import json
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators.vector_index import VectorIndex
from ledgerline.operators.vectors import knn_vectors
from ledgerline.operators.views import IncrementalView, Measures, rows_of_groups
from ledgerline.sources.clustering import ClusteredTable, _curve_function, with_curve, write_on_curve
from ledgerline.sources.feed import TIME, VERSION, ChangeTable
from ledgerline.sources.identity import IdentityKeys
from ledgerline.sources.tables import BucketedLog, BucketedTable, VersionedTable
from ledgerline.streaming import apply, ingest
from ledgerline.streaming.drift import conformed, ingest_drifting
from ledgerline.streaming.facts import Dimension, StarSink
from ledgerline.streaming.progress import ProgressLog, rates
from tests.conftest import rows


def keyed(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "k string")


# ------------------------------------------------------------- identity keys

def test_identity_keys_are_dense_unique_and_never_reused(spark, tmp_path):
    numbers = IdentityKeys(spark, str(tmp_path / "ids"), ["k"], buckets=4)
    assert numbers.high_water() == 0
    first = {r["k"]: r["id"] for r in numbers.assign(keyed(spark, "b", "a", "b", None), "one").collect()}
    assert first == {"a": 1, "b": 2, None: None}
    second = {r["k"]: r["id"] for r in numbers.assign(keyed(spark, "z", "a", "c"), "two").collect()}
    assert second == {"a": 1, "c": 3, "z": 4} and numbers.high_water() == 4
    assert rows(numbers.read()) == [("a", 1), ("b", 2), ("c", 3), ("z", 4)]


def test_a_repeated_batch_gets_the_same_numbers(spark, tmp_path):
    numbers = IdentityKeys(spark, str(tmp_path / "ids"), ["k"], buckets=4)
    numbers.assign(keyed(spark, "a", "b"), "one")
    numbers.assign(keyed(spark, "c"), "two")
    again = IdentityKeys(spark, str(tmp_path / "ids"), ["k"], buckets=4)
    assert rows(again.assign(keyed(spark, "a", "b"), "one")) == [("a", 1), ("b", 2)]
    assert again.high_water() == 3


def test_a_batch_that_died_leaves_no_gap(spark, tmp_path, monkeypatch):
    numbers = IdentityKeys(spark, str(tmp_path / "ids"), ["k"], buckets=4)
    numbers.assign(keyed(spark, "a"), "one")

    def stop(name):
        if "_COMMITTED" in name:
            raise RuntimeError("lost")

    monkeypatch.setattr(numbers._files, "touch", stop)
    with pytest.raises(RuntimeError):
        numbers.assign(keyed(spark, "b", "c"), "two")
    monkeypatch.undo()
    assert numbers.high_water() == 1
    assert rows(numbers.assign(keyed(spark, "x", "b"), "two")) == [("b", 2), ("x", 3)]


def test_identity_keys_of_many_rows(spark, tmp_path):
    numbers = IdentityKeys(spark, str(tmp_path / "ids"), ["a", "b"], buckets=8)
    df = spark.range(20_000).select((F.col("id") % 7000).alias("a"), F.lit("x").alias("b"))
    numbers.assign(df, "one")
    found = numbers.read()
    assert found.agg(F.min("id"), F.max("id"), F.count_distinct("id"), F.count("*")).first()[:] == (1, 7000, 7000, 7000)
    assert numbers.assign(spark.createDataFrame([], df.schema), "none").count() == 0 and numbers.high_water() == 7000


# ------------------------------------------------------------- stored change feed

def put(spark, table, token, *changes):
    frame = spark.createDataFrame(changes, "k string, v string, at int, op string")
    apply.merge_scd1(frame, table, token, ["at"], except_columns=["at", "op"], delete_when=F.col("op") == "D")


def test_feed_of_inserts_updates_and_deletes(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], buckets=4, visible=ch.scd1_rows)
    put(spark, table, "1", ("a", "x", 1, "U"), ("b", "x", 1, "U"))
    put(spark, table, "2", ("a", "y", 2, "U"), ("b", "x", 2, "U"), ("c", "z", 2, "U"))
    put(spark, table, "2", ("a", "other", 9, "U"))  # the same token: nothing happens
    put(spark, table, "3", ("c", None, 3, "D"), (None, "lost", 3, "U"))
    feed = table.changes().select("k", "v", ch.OP, VERSION)
    assert rows(feed) == [
        ("a", "x", "insert", 1), ("a", "x", "update_preimage", 2), ("a", "y", "update_postimage", 2), ("b", "x", "insert", 1),
        ("c", "z", "delete", 3), ("c", "z", "insert", 2),
    ]
    assert table.changes(since=2, until=2).count() == 3 and table.changes(since=3).select(TIME).first()[0] is not None
    assert rows(table.quarantined().select("v")) == [("lost",)]


def test_feed_reads_only_touched_buckets(spark, tmp_path, monkeypatch):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], buckets=8, visible=ch.scd1_rows)
    put(spark, table, "1", *[(f"k{n}", "x", 1, "U") for n in range(100)])
    asked = []
    plain = table.read
    monkeypatch.setattr(table, "read", lambda buckets=None: (asked.append(buckets), plain(buckets))[1])
    put(spark, table, "2", ("k5", "y", 2, "U"))
    assert asked and all(len(b) == 1 for b in asked)
    assert table.changes(since=2).count() == 2
    plan = plain([asked[0][0]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("bucket=") <= 2


def test_feed_shows_only_what_was_committed(spark, tmp_path, monkeypatch):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], buckets=4, visible=ch.scd1_rows)
    put(spark, table, "1", ("a", "x", 1, "U"))
    touch = table._files.touch

    def stop(name):
        if "_COMMITTED" in name:
            raise RuntimeError("lost")
        touch(name)

    monkeypatch.setattr(table._files, "touch", stop)
    with pytest.raises(RuntimeError):
        put(spark, table, "2", ("a", "y", 2, "U"))
    monkeypatch.undo()
    assert table.changes().count() == 1
    # A crash between the marker and the move: the next reader moves the images.
    monkeypatch.setattr(table, "publish_images", lambda: None)
    put(spark, table, "2", ("a", "y", 2, "U"))
    monkeypatch.undo()
    assert table.changes(since=2).count() == 2


def test_stream_of_changes_goes_on_and_starts_at_a_version(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "t"), ["k"], buckets=4, visible=ch.scd1_rows)
    put(spark, table, "1", ("a", "x", 1, "U"))
    put(spark, table, "2", ("a", "y", 2, "U"))
    seen = []

    def run(since, checkpoint):
        from ledgerline.streaming.ingest import run_batches

        stream = table.change_stream("k string, v string", since=since)
        run_batches(stream, lambda batch, n: seen.extend(tuple(r) for r in batch.select("v", ch.OP, VERSION).collect()), str(tmp_path / checkpoint))

    run(1, "all")
    assert sorted(seen) == [("x", "insert", 1), ("x", "update_preimage", 2), ("y", "update_postimage", 2)]
    seen.clear()
    put(spark, table, "3", ("a", None, 3, "D"))
    run(1, "all")
    assert seen == [("y", "delete", 3)]
    seen.clear()
    run(2, "late")
    assert sorted(seen) == [("x", "update_preimage", 2), ("y", "delete", 3), ("y", "update_postimage", 2)]


# ------------------------------------------------------------- views kept from a feed

VIEW = Measures.of(sums={"total": "v"}, least={"low": "v"}, greatest={"high": "v"}, distinct={"kinds": "w"})
IMAGES = "k int, g string, v int, w string, _change_type string"


def plain_view(state):
    out = {}
    for g, v, w in state.values():
        out.setdefault(g, []).append((v, w))
    result = []
    for g, held in out.items():
        numbers = [v for v, _ in held if v is not None]
        result.append((g, len(held), sum(numbers) if numbers else None, min(numbers, default=None), max(numbers, default=None),
                       len({w for _, w in held if w is not None})))
    return sorted(result, key=str)


def test_view_under_random_changes(spark, tmp_path):
    pick = random.Random(4)
    view = IncrementalView(spark, str(tmp_path / "view"), ["g"], VIEW, buckets=4)
    state, asked = {}, []

    def source(groups):
        asked.append(sorted(str(r["g"]) for r in groups.collect()))
        rows_ = spark.createDataFrame([(g, v, w) for g, v, w in state.values()] or [("", 0, "")], "g string, v int, w string")
        return rows_of_groups(rows_.where(F.lit(bool(state))), groups, ["g"])

    for step in range(5):
        images = []
        for _ in range(40):
            k = pick.randint(1, 30)
            new = (pick.choice(["a", "b", "c", None]), pick.choice([None, *range(9)]), pick.choice(["x", "y", "z", None]))
            if k in state:
                images.append((k, *state[k], "update_preimage" if (changed := pick.random() < 0.5) else "delete"))
                del state[k]
                if not changed:
                    continue
                images.append((k, *new, "update_postimage"))
            else:
                images.append((k, *new, "insert"))
            state[k] = new
        if step == 4:
            images += [(k, *row, "delete") for k, row in state.items()]
            state.clear()
        view.apply(spark.createDataFrame(images, IMAGES), f"step-{step}", source)
        view.apply(spark.createDataFrame(images, IMAGES), f"step-{step}", source)  # repeated: nothing happens
        found = [tuple(r) for r in view.read().select("g", "rows", "total", "low", "high", "kinds").collect()] if step < 4 else view.read()
        assert (sorted(found, key=str) == plain_view(state)) if step < 4 else (found is None or found.count() == 0)
    assert asked


def test_view_reads_only_touched_groups(spark, tmp_path, monkeypatch):
    view = IncrementalView(spark, str(tmp_path / "view"), ["g"], VIEW, buckets=16)
    image = lambda g, v, op: (1, g, v, "x", op)
    no_search = lambda groups: pytest.fail("no value has gone")
    view.apply(spark.createDataFrame([image(f"g{n}", n, "insert") for n in range(60)], IMAGES), "1", no_search)
    asked = []
    for part in (view.state, view.values["kinds"]):
        plain = part.read
        monkeypatch.setattr(part, "read", lambda buckets=None, plain=plain: (asked.append(buckets), plain(buckets))[1])
    view.apply(spark.createDataFrame([image("g7", 100, "insert")], IMAGES), "2", no_search)
    assert [len(b) for b in asked] == [1, 1]
    wanted = []

    def search(groups):
        wanted.extend(r["g"] for r in groups.collect())
        return spark.createDataFrame([("g7", 7, "x")], "g string, v int, w string")

    view.apply(spark.createDataFrame([image("g7", 100, "delete"), image("g8", 5, "insert")], IMAGES), "3", search)
    assert wanted == ["g7"]
    monkeypatch.undo()
    assert rows(view.read().where("g in ('g7', 'g8')")) == [("g7", 1, 7, 7, 7, 1), ("g8", 2, 13, 5, 8, 1)]


def test_a_view_batch_that_died_between_its_tables(spark, tmp_path, monkeypatch):
    view = IncrementalView(spark, str(tmp_path / "view"), ["g"], VIEW, buckets=4)
    batch = spark.createDataFrame([(1, "a", 1, "x", "insert"), (2, "a", 2, "y", "insert")], IMAGES)
    view.apply(batch, "1", lambda groups: None)
    more = spark.createDataFrame([(3, "a", 3, "z", "insert"), (1, "a", 1, "x", "delete")], IMAGES)
    search = lambda groups: spark.createDataFrame([("a", 2, "y"), ("a", 3, "z")], "g string, v int, w string")

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(view.state, "replace", lost)
    with pytest.raises(RuntimeError):
        view.apply(more, "2", search)
    monkeypatch.undo()
    view.apply(more, "2", search)
    assert rows(view.read()) == [("a", 2, 5, 2, 3, 2)]


# ------------------------------------------------------------- stored vector index

def embeddings(spark, sf="0.01"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").select("vec_id", "embedding")


def build(spark, path, lists=16):
    index = VectorIndex(spark, path)
    index.build(embeddings(spark).where("vec_id % 2 = 0"), lists, id="vec_id", vector="embedding")
    return index


def test_index_recall_and_pruning(spark, tmp_path):
    data = embeddings(spark)
    index = build(spark, str(tmp_path / "index"))
    versions = index._centres.versions()
    index.add(data.where("vec_id % 2 = 1"), id="vec_id", vector="embedding", token="odd")
    index.add(data.where("vec_id % 2 = 1"), id="vec_id", vector="embedding", token="odd")  # once per token
    assert index._centres.versions() == versions and index.members().count() == data.count()
    queries = data.where("vec_id % 100 = 0")
    exact = {(r["q"], r["p"]) for r in knn_vectors(queries, data, 5, id="vec_id", vector="embedding", exact=True).collect()}
    found = {(r["q"], r["p"]) for r in index.search(queries, 5, id="vec_id", vector="embedding").collect()}
    assert len(found & exact) >= 0.9 * len(exact)
    assert {(r["q"], r["p"]) for r in index.search(queries, 5, id="vec_id", vector="embedding", probes=99).collect()} == exact
    one = index.members([3])
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "list#" in scan.split("PartitionFilters: ")[1].split("]")[0]


def test_overfull_lists_are_split(spark, tmp_path):
    index = build(spark, str(tmp_path / "index"), lists=2)
    data = embeddings(spark)
    before = {r["id"] for r in index.members().collect()}
    split = index.rebalance(60)
    sizes = {r["list"]: r["rows"] for r in index.sizes().collect()}
    assert split and max(sizes.values()) <= 60 and not set(split) & set(sizes)
    members = index.members().collect()
    assert len(members) == len(before) and {r["id"] for r in members} == before
    queries = data.where("vec_id % 100 = 0")
    exact = knn_vectors(queries, data.where("vec_id % 2 = 0"), 3, id="vec_id", vector="embedding", exact=True)
    found = index.search(queries, 3, id="vec_id", vector="embedding", probes=99)
    assert rows(found.select("q", "p")) == rows(exact.select("q", "p"))


def test_index_of_equal_and_null_vectors(spark, tmp_path):
    same = spark.createDataFrame([(n, [1.0, 2.0]) for n in range(50)] + [(99, None)], "n long, v array<float>")
    index = VectorIndex(spark, str(tmp_path / "index"))
    index.build(same, 4, id="n", vector="v")
    assert index.members().count() == 50 and index.rebalance(10) == []
    found = index.search(same.where("n in (7, 99)"), 3, id="n", vector="v")
    assert rows(found.select("q", "p", "rank")) == [(7, 0, 1), (7, 1, 2), (7, 2, 3)]
    with pytest.raises(ValueError):
        VectorIndex(spark, str(tmp_path / "none")).build(same.where("n = 99"), 4, id="n", vector="v")


# ------------------------------------------------------------- clustering by several keys

def groups_read(path, column, low, high):
    """Row groups whose statistics allow a value in [low, high], and all."""
    found = total = 0
    for file in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = next(k for k in range(meta.num_columns) if meta.schema.column(k).name == column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            found += stats.min <= high and stats.max >= low
    return found, total


def test_filters_on_each_key_skip_most_row_groups(spark, tmp_path):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_shipdate", "l_partkey", "l_suppkey")
    write_on_curve(lines, str(tmp_path / "t"), ["l_shipdate", "l_partkey", "l_suppkey"], files=256)
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == lines.count() and stored.columns == lines.columns
    for column, low, high in (("l_partkey", 100, 140), ("l_suppkey", 20, 22)):
        found, total = groups_read(tmp_path / "t", column, low, high)
        assert total >= 200 and found < total / 3
        wanted = F.col(column).between(low, high)
        assert sorted(map(tuple, stored.where(wanted).collect())) == sorted(map(tuple, lines.where(wanted).collect()))


def test_the_curve_visits_neighbours(spark):
    """Over a grid of 256 x 256 ranks every place is taken once and each step changes one key by one."""
    place = _curve_function(2)
    x, y = (a.ravel() for a in np.meshgrid(np.arange(256), np.arange(256)))
    order = np.argsort(np.asarray(place(pa.array(x), pa.array(y))))
    assert sorted(np.asarray(place(pa.array(x), pa.array(y))).tolist()) == list(range(65536))
    assert (np.abs(np.diff(x[order])) + np.abs(np.diff(y[order])) == 1).all()
    cube = [a.ravel() for a in np.meshgrid(*[np.arange(0, 256, 8)] * 3)]
    assert len(set(np.asarray(_curve_function(3)(*map(pa.array, cube))).tolist())) == 32**3


def test_curve_of_texts_dates_and_nulls(spark):
    df = spark.createDataFrame([(k % 7 and f"name{k % 50:02d}", k) for k in range(500)], "a string, b int")
    placed = with_curve(df.withColumn("a", F.when(F.col("b") % 7 != 0, F.col("a"))), ["a", "b"])
    found = placed.select("a", "b", "_curve").collect()
    assert len(found) == 500 and len({r["_curve"] for r in found}) > 200
    with pytest.raises(TypeError):
        with_curve(spark.createDataFrame([([1],)], "a array<int>"), ["a"])


def test_only_new_files_are_clustered(spark, tmp_path):
    table = ClusteredTable(spark, str(tmp_path / "t"), ["a", "b"])
    rows_of = lambda low, high: spark.range(low, high).selectExpr("id AS a", "id * 7 % 100 AS b")
    table.append(rows_of(0, 500), "one")
    table.append(rows_of(0, 9), "one")  # a lot is written once
    assert table.read().count() == 500 and table.cluster(4) == ["one"] and table.cluster(4) == []
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "clustered").rglob("*.parquet")}
    table.append(rows_of(500, 600), "two")
    assert table.waiting() == ["two"] and table.read().count() == 600
    assert table.cluster(2) == ["two"] and table.read().count() == 600
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "clustered").rglob("*.parquet")}
    assert before.items() <= after.items() and len(after) > len(before)


# ------------------------------------------------------------- drifting files

def test_nothing_is_lost_to_drift(spark, tmp_path):
    schema = "id long, price double, name string, tags array<string>"
    declared = spark.createDataFrame([], schema).schema
    run = lambda: ingest_drifting(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp"))
    spark.createDataFrame([(1, 1.5, "a", ["x"])], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "one"))
    run()
    spark.createDataFrame([(2, "n/a", {"k": 1}), (3, "2.5", None)], "ID int, price string, extra map<string,int>").coalesce(1).write.parquet(str(tmp_path / "in" / "two"))
    spark.createDataFrame([("4", "not a list")], "id string, tags string").coalesce(1).write.parquet(str(tmp_path / "in" / "three"))
    spark.createDataFrame([(5.5, "c")], "id double, name string").coalesce(1).write.parquet(str(tmp_path / "in" / "four"))
    run()
    run()
    found = {}
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert [f.name for f in declared] == [c for c in stored.columns if c in declared.fieldNames()]
    for r in stored.collect():
        found[r["id"]] = (r["price"], r["name"], r["tags"], r["_rescued_data"] and json.loads(r["_rescued_data"]))
        assert r["_file"].endswith(".parquet")
    assert found == {
        1: (1.5, "a", ["x"], None), 2: (None, None, None, {"price": "n/a", "extra": '{"k":1}'}), 3: (2.5, None, None, None),
        4: (None, None, None, {"tags": "not a list"}), 5: (None, "c", None, {"id": "5.5"}),
    }


def test_drift_of_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,price\n1,2.5\n")
    (tmp_path / "in" / "b.csv").write_text("price,id,note\nfree,2,hello\n")
    ingest_drifting(spark, str(tmp_path / "in"), "id long, price double", str(tmp_path / "out"), str(tmp_path / "cp"), "csv", options={"header": "true"})
    found = rows(spark.read.parquet(str(tmp_path / "out")).select("id", "price", "_rescued_data"))
    assert found == [(1, 2.5, None), (2, None, '{"price":"free","note":"hello"}')]


def test_conformed_keeps_what_fits(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(conformed(df, df.schema)) == [(1, "x", None)]


# ------------------------------------------------------------- dimensions that change under a stream

def test_each_batch_binds_the_newest_dimension(spark, tmp_path):
    dim = VersionedTable(spark, str(tmp_path / "dim"))
    sink = StarSink(spark, str(tmp_path / "star"), {"customer": Dimension(dim.read, ["k"], ["name"])})
    assert sink.waiting() is None

    def arrive(*facts):
        spark.createDataFrame(facts, "f int, k string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sink.run(ingest.file_stream(spark, str(tmp_path / "in"), "f int, k string"), str(tmp_path / "cp"))

    dim.publish(spark.createDataFrame([("a", "first")], "k string, name string"))
    arrive((1, "a"), (2, "b"), (3, None))
    assert rows(sink.facts().select("f", "name")) == [(1, "first")]
    assert rows(sink.waiting().select("f", "missing", "since")) == [(2, ["customer"], 0), (3, ["customer"], 0)]
    dim.publish(spark.createDataFrame([("a", "second"), ("b", "late")], "k string, name string"))
    arrive((4, "a"), (4, "a"), (5, "c"))
    assert rows(sink.facts().select("f", "name")) == [(1, "first"), (2, "late"), (4, "second"), (4, "second")]
    assert rows(sink.waiting().select("f", "since")) == [(3, 0), (5, 1)]
    # A repeated batch changes nothing; one that died before its version was published starts again.
    sink.apply(spark.createDataFrame([(4, "a")], "f int, k string"), 1, "again")
    assert sink.facts().count() == 4


def test_a_star_batch_that_died_is_not_doubled(spark, tmp_path, monkeypatch):
    dim = VersionedTable(spark, str(tmp_path / "dim"))
    dim.publish(spark.createDataFrame([("a", "x")], "k string, name string"))
    sink = StarSink(spark, str(tmp_path / "star"), {"customer": Dimension(dim.read, ["k"], ["name"])})
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "f int, k string")

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(sink._waiting, "publish", lost)
    with pytest.raises(RuntimeError):
        sink.apply(batch, 0, "t0")
    monkeypatch.undo()
    sink.apply(batch, 0, "t0")
    assert rows(sink.facts().select("f")) == [(1,)] and rows(sink.waiting().select("f")) == [(2,)]


# ------------------------------------------------------------- compaction, progress

def test_a_folded_log_reads_the_same(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=3)
    log = BucketedLog(spark, str(tmp_path / "log"), table)
    batch = lambda n: spark.createDataFrame([(f"k{n % 5}", n)], "k string, n int")
    for n in range(20):
        log.append(batch(n), f"b{n}")
        if n % 6 == 5:
            assert log.compact() is not None
        assert len(log._parts()) <= 7  # however many batches there have been
        assert rows(log.read(range(3)).select("n")) == sorted([(m,) for m in range(n + 1)], key=str)
    log.append(batch(3), "b3")  # repeated after it was folded
    assert log.read(range(3)).count() == 20
    assert log.compact(keep=1) is not None and log.compact(keep=1) is None
    assert len(log._parts()) == 2 and log.read(range(3)).count() == 20


def test_a_fold_that_died_changes_nothing(spark, tmp_path, monkeypatch):
    log = BucketedLog(spark, str(tmp_path / "log"), BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=2))
    for n in range(3):
        log.append(spark.createDataFrame([("a", n)], "k string, n int"), f"b{n}")

    def lost(_):
        raise RuntimeError("lost")

    monkeypatch.setattr(log._files, "touch", lost)
    with pytest.raises(RuntimeError):
        log.compact()
    monkeypatch.undo()
    assert log.read(range(2)).count() == 3 and log.compact() == 2 and log.read(range(2)).count() == 3


def test_a_folded_table_reads_one_version(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    for n in range(6):
        put(spark, table, str(n), (f"k{n}", "x", n, "U"), (f"k{n - 1}", "y", n, "U"))
    before = rows(ch.scd1_rows(table.read()))
    assert table.compact("fold") is not None and table.compact("fold") is None
    assert rows(ch.scd1_rows(table.read())) == before
    assert len({f.split("/v=")[1].split("/")[0] for f in table.read().inputFiles()}) == 1


def test_stored_progress_adds_up(spark, tmp_path):
    spark.range(50).repartition(5).write.parquet(str(tmp_path / "in"))
    with ProgressLog(spark, str(tmp_path / "progress")) as log:
        ingest.run_stream(ingest.file_stream(spark, str(tmp_path / "in"), "id long", max_files=2), str(tmp_path / "out"), str(tmp_path / "cp"))
    stored = log.read()
    assert stored.count() == 3 and stored.agg(F.sum("rows")).first()[0] == 50
    total = rates(stored).first()
    assert (total["batches"], total["rows"]) == (3, 50) and abs(total["rows_a_second"] - 50 / max(total["seconds"], 0.001)) < 1e-6
    ingest.run_stream(ingest.file_stream(spark, str(tmp_path / "in"), "id long"), str(tmp_path / "out2"), str(tmp_path / "cp2"))
    assert log.read().count() == 3  # no longer attached


def test_rows_of_few_groups_are_found_without_a_shuffle_of_the_source(spark):
    source = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4), ("a", 5)], "g string, v int")
    groups = spark.createDataFrame([("a",), (None,), ("a",)], "g string")
    found = rows_of_groups(source, groups, ["g"])
    assert sorted(r["v"] for r in found.collect()) == [1, 3, 5]
    assert "strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()

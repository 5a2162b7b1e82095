import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from tests.conftest import rows

SCHEMA = "k string, seq int, v string, note string, op string"


def deleted():
    return F.col("op") == "D"


def changes(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def state_of(df):
    return ch.newest(ch.scd1_changes(df, ["k"], ["seq"], except_columns=["seq", "op", "note"], delete_when=deleted()), ["k"])


def visible(state):
    return rows(ch.scd1_rows(state).select("k", "v"))


def test_scd1_keeps_the_newest_and_ignores_late_rows(spark):
    first = state_of(changes(spark, [("a", 5, "new", "", "U"), ("a", 3, "old", "", "U"), ("b", 1, "x", "", "U")]))
    late = state_of(changes(spark, [("a", 4, "late", "", "U"), ("b", 2, "y", "", "U")]))
    assert visible(ch.scd1(first, late, ["k"])) == [("a", "new"), ("b", "y")]


def test_scd1_tombstone_blocks_late_rows_and_allows_newer_ones(spark):
    gone = state_of(changes(spark, [("a", 5, None, "", "D")]))
    after_late = ch.scd1(gone, state_of(changes(spark, [("a", 4, "late", "", "U")])), ["k"])
    assert visible(after_late) == []
    assert visible(ch.scd1(after_late, state_of(changes(spark, [("a", 6, "back", "", "U")])), ["k"])) == [("a", "back")]


def test_scd1_equal_sequence_is_decided_by_content_not_by_arrival(spark):
    data = [("a", 1, "x", "", "U"), ("a", 1, "y", "", "U")]
    one = visible(state_of(changes(spark, data)))
    two = visible(ch.scd1(state_of(changes(spark, data[1:])), state_of(changes(spark, data[:1])), ["k"]))
    assert one == two and len(one) == 1


def test_null_key_or_sequence_is_set_aside(spark):
    df = changes(spark, [(None, 1, "x", "", "U"), ("a", None, "x", "", "U"), ("a", 1, "x", "", "U")])
    good, bad = ch.split_valid(df, ["k"], ["seq"])
    assert good.count() == 1 and bad.count() == 2
    assert visible(state_of(df)) == [("a", "x")]


def history(spark, data, **options):
    log = ch.scd2_log(changes(spark, data), ["k"], ["seq"], except_columns=["seq", "op"], delete_when=deleted())
    return ch.scd2_history(log, ["k"], **options)


def intervals(versions):
    return rows(versions.select("k", "v", ch.START, ch.END))


def test_scd2_insert_repeat_change_delete_reinsert(spark):
    data = [("a", 1, "x", "", "U"), ("a", 2, "x", "", "U"), ("a", 3, "y", "", "U"), ("a", 4, None, "", "D"),
            ("a", 6, "y", "", "U")]
    assert intervals(history(spark, data)) == [("a", "x", 1, 3), ("a", "y", 3, 4), ("a", "y", 6, None)]


def test_scd2_ignores_preimages_and_leading_deletes(spark):
    feed = spark.createDataFrame(
        [("a", 1, "x", "delete"), ("a", 2, "x", "insert"), ("a", 3, "x", "update_preimage"), ("a", 3, "y", "update_postimage")],
        "k string, seq int, v string, _change_type string",
    )
    log = ch.scd2_log(feed, ["k"], ["seq"], except_columns=["seq"], delete_when=F.col("_change_type") == "delete")
    assert intervals(ch.scd2_history(log, ["k"])) == [("a", "x", 2, 3), ("a", "y", 3, None)]


def test_scd2_untracked_column_is_refreshed_in_place(spark):
    data = [("a", 1, "x", "old", "U"), ("a", 2, "x", "new", "U"), ("a", 3, "y", "last", "U")]
    versions = history(spark, data, track_except=["note"])
    assert rows(versions.select("v", "note", ch.START, ch.END)) == [("x", "new", 1, 3), ("y", "last", 3, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_split_equals_plain_and_order_of_arrival_is_irrelevant(spark, seed):
    source = random.Random(seed)
    data = [("hot" if source.random() < 0.7 else f"k{source.randrange(5)}", source.randrange(60), source.choice("xyz"),
             source.choice("ab"), "D" if source.random() < 0.2 else "U") for _ in range(150)]
    data += data[:20]
    plain = intervals(history(spark, data, split=False))
    source.shuffle(data)
    assert intervals(history(spark, data, split=True)) == plain


def expected_versions(data):
    """Row-by-row model of the type 2 rules for the tracked pair (v, note)."""
    out = []
    for key, group in itertools.groupby(sorted(set(data), key=lambda r: (r[0], r[1])), key=lambda r: r[0]):
        open_row = None
        for _, seq, v, note, op in group:
            if open_row and op == "U" and open_row[:2] == (v, note):
                continue
            if open_row:
                out.append((key, open_row[0], open_row[2], seq))
            open_row = None if op == "D" else (v, note, seq)
        if open_row:
            out.append((key, open_row[0], open_row[2], None))
    return sorted(out, key=lambda t: [(v is not None, str(v)) for v in t])


def test_scd2_matches_a_row_by_row_model(spark):
    source = random.Random(5)
    data = [(f"k{i % 4}", i, source.choice("xy"), source.choice("ab"), "D" if source.random() < 0.25 else "U")
            for i in range(120)]
    assert intervals(history(spark, data)) == expected_versions(data)


def test_scd2_intervals_never_overlap_and_one_row_is_open(spark):
    source = random.Random(3)
    data = [(f"k{source.randrange(6)}", source.randrange(100), source.choice("xyz"), "", "U") for _ in range(200)]
    per_key = {}
    for k, _, start, end in intervals(history(spark, data)):
        per_key.setdefault(k, []).append((start, end))
    for spans in per_key.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] is None


# ------------------------------------------------------------------ snapshots

def at(day):
    return F.lit(dt.datetime(2024, 1, day))


def snap(spark, data):
    return spark.createDataFrame(data, "id int, v string, audit string, sk long")


def apply(spark, target, day, data, **options):
    return ch.scd2_snapshot(target, snap(spark, data), ["id"], at(day), track_except=["audit", "sk"], keep=["sk"], **options)


def shown(target):
    return rows(target.select("id", "v", "audit", "sk", F.dayofmonth(ch.START).alias("s"), F.dayofmonth(ch.END).alias("e")))


def test_snapshot_opens_closes_keeps_and_refreshes(spark):
    one = apply(spark, None, 1, [(1, "a", "t1", 10), (2, "b", "t1", 20), (3, "c", "t1", 30)])
    two = apply(spark, one, 2, [(1, "a", "t2", 11), (2, "B", "t2", 21), (4, "d", "t2", 40)])
    assert shown(two) == [
        (1, "a", "t2", 10, 1, None), (2, "B", "t2", 21, 2, None), (2, "b", "t1", 20, 1, 2),
        (3, "c", "t1", 30, 1, 2), (4, "d", "t2", 40, 2, None),
    ]
    three = apply(spark, two, 3, [(1, "a", "t3", 12), (2, "B", "t3", 22), (3, "c", "t3", 31)])
    assert [r for r in shown(three) if r[0] == 3] == [(3, "c", "t1", 30, 1, 2), (3, "c", "t3", 31, 3, None)]
    assert ch.changed_keys(three, ["id"]).select("id").distinct().count() == 2
    assert ch.current(three).count() == 3


def test_snapshot_refuses_duplicates_empty_input_and_old_times(spark):
    one = apply(spark, None, 5, [(1, "a", "t", 1)])
    with pytest.raises(ValueError, match="more than one row"):
        apply(spark, one, 6, [(1, "a", "t", 1), (1, "b", "t", 1)])
    with pytest.raises(ValueError, match="empty snapshot"):
        apply(spark, one, 6, [])
    with pytest.raises(ValueError, match="later"):
        apply(spark, one, 5, [(1, "a", "t", 1)])
    assert ch.current(apply(spark, one, 6, [], allow_empty=True)).count() == 0


def test_change_feed_between_two_states(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "id int, v string")
    assert rows(ch.changes_between(old, new, ["id"])) == rows(spark.createDataFrame(
        [(2, None, "update_preimage"), (2, "b", "update_postimage"), (3, "c", "delete"), (4, "d", "insert")],
        "id int, v string, t string"))


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(ch.surrogate_key(df, ["id"], "sk")) == rows(ch.surrogate_key(df.repartition(3), ["id"], "sk"))


def test_a_snapshot_leaves_closed_files_alone(spark, tmp_path):
    import datetime as dt

    from ledgerline.operators.history import SnapshotHistory

    history = SnapshotHistory(spark, str(tmp_path / "h"), ["k"])
    days = [[("a", 1), ("b", 1)], [("a", 2), ("b", 1)], [("b", 1)], [("b", 1), ("a", 3)]]
    state, before = None, {}
    for n, rows_ in enumerate(days):
        at = dt.datetime(2024, 1, n + 1)
        snapshot = spark.createDataFrame(rows_, "k string, v int")
        after = ch.scd2_snapshot(state, snapshot, ["k"], F.lit(str(at)).cast("timestamp"))
        state = _stored(spark, tmp_path / f"s{n}", after)
        history.apply(snapshot, at)
        assert rows(history.read()) == rows(state)
        now = {p: p.stat().st_mtime_ns for p in (tmp_path / "h").glob("v=*/state=closed/*.parquet")}
        assert before.items() <= now.items()
        before = now
    with pytest.raises(ValueError, match="later"):
        history.apply(snapshot, dt.datetime(2024, 1, 1))


def _stored(spark, path, df):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_snapshot_rows_without_a_key_are_kept_aside(spark, tmp_path):
    import datetime as dt

    from ledgerline.operators.history import SnapshotHistory

    history = SnapshotHistory(spark, str(tmp_path / "h"), ["k"])
    assert history.quarantined() is None
    history.apply(spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "k string, v int"), dt.datetime(2020, 1, 1))
    history.apply(spark.createDataFrame([("a", 3)], "k string, v int"), dt.datetime(2021, 1, 1))
    history.apply(spark.createDataFrame([("a", 3), (None, 4)], "k string, v int"), dt.datetime(2022, 1, 1))
    assert [(r["v"], r["at"].year) for r in history.quarantined().orderBy("v").collect()] == [(2, 2020), (2, 2020), (4, 2022)]
    assert history.read().count() == 2


def test_unkeyed_rows_are_counted(spark):
    old = spark.createDataFrame([(None, "x"), (None, "x"), ("a", "y")], "k string, v string")
    new = spark.createDataFrame([(None, "x"), (None, "z")], "k string, v string")
    found = sorted((r["v"], r["old_rows"], r["new_rows"]) for r in ch.unkeyed(old, new, ["k"]).collect())
    assert found == [("x", 2, 1), ("z", 0, 1)]

"""Change feed, type 1 and type 2 queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators.history import SnapshotHistory
from ledgerline.sources.tables import BucketedLog, BucketedTable
from ledgerline.streaming import apply
from ledgerline.streaming.ingest import file_stream
from ledgerline.workspace import materialize, new_dir
from workload import stage
from workload.registry import query
from workload.stage import YEARLY_STATES_SQL, table


@query("change_feed", f"""
    WITH n AS ({YEARLY_STATES_SQL}),
    o AS (SELECT snapshot_year + 1 AS snapshot_year, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM n),
    j AS (SELECT coalesce(n.snapshot_year, o.snapshot_year) AS snapshot_year, coalesce(n.o_custkey, o.o_custkey) AS o_custkey,
                 n.o_custkey IS NULL AS gone, o.o_custkey IS NULL AS fresh,
                 (n.o_orderstatus, n.o_orderpriority, n.o_totalprice) IS DISTINCT FROM
                 (o.o_orderstatus, o.o_orderpriority, o.o_totalprice) AS differs,
                 n.o_orderstatus AS ns, n.o_orderpriority AS np, n.o_totalprice AS nt,
                 o.o_orderstatus AS os, o.o_orderpriority AS op, o.o_totalprice AS ot
          FROM n FULL JOIN o ON n.snapshot_year = o.snapshot_year AND n.o_custkey = o.o_custkey)
    SELECT snapshot_year, o_custkey, ns AS o_orderstatus, np AS o_orderpriority, nt AS o_totalprice, 'insert' AS _change_type FROM j WHERE fresh
    UNION ALL SELECT snapshot_year, o_custkey, os, op, ot, 'delete' FROM j WHERE gone
    UNION ALL SELECT snapshot_year, o_custkey, os, op, ot, 'update_preimage' FROM j WHERE NOT gone AND NOT fresh AND differs
    UNION ALL SELECT snapshot_year, o_custkey, ns, np, nt, 'update_postimage' FROM j WHERE NOT gone AND NOT fresh AND differs
""")
def change_feed(spark, sf):
    """What changed from each year's snapshot to the next one's."""
    states = stage.yearly_states(spark, sf)
    before = states.withColumn("snapshot_year", F.col("snapshot_year") + 1)
    return ch.changes_between(before, states, ["snapshot_year", "o_custkey"])


_LATEST_SQL = """
    SELECT user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'
"""


def _event_changes(spark, sf):
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value", "props")


def _landed_in_two_parts(spark, sf):
    """Afternoon events arrive first, the morning events of all days arrive late."""
    events = _event_changes(spark, sf)
    path = new_dir(spark, "event-changes")
    afternoon = F.hour("ts") >= 12
    for lot, rows in (("first", afternoon), ("second", ~afternoon)):
        events.filter(rows).write.option("maxRecordsPerFile", stage.FILE_ROWS).parquet(f"{path}/{lot}")
    return events.schema, path


@query("scd1_upsert", _LATEST_SQL)
def scd1_upsert(spark, sf):
    """Type 1 table kept from a stream; events in several micro-batches, many of them late."""
    schema, path = _landed_in_two_parts(spark, sf)
    home = new_dir(spark, "scd1")
    target = BucketedTable(spark, f"{home}/table", ["user_id"], buckets=8)
    apply.apply_scd1(
        file_stream(spark, path, schema, max_files=1), target, f"{home}/checkpoint", ["ts", "event_id"],
        except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
    )
    return ch.scd1_rows(target.read())


@query("scd1_restart", _LATEST_SQL)
def scd1_restart(spark, sf):
    """The second half of the events comes through a new checkpoint, whose batches are numbered from 0 again."""
    schema, path = _landed_in_two_parts(spark, sf)
    home = new_dir(spark, "scd1-restart")
    target = BucketedTable(spark, f"{home}/table", ["user_id"], buckets=8)
    for lot in ("first", "second"):
        apply.apply_scd1(
            file_stream(spark, f"{path}/{lot}", schema), target, f"{home}/checkpoint-{lot}", ["ts", "event_id"],
            except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
        )
    return ch.scd1_rows(target.read())


@query("scd_quarantine", """
    SELECT event_id, CASE WHEN event_id % 10 = 3 THEN 'user_id' ELSE 'ts' END AS missing, event_type
    FROM events WHERE event_id % 10 IN (3, 4)
""")
def scd_quarantine(spark, sf):
    """Changes without a key or without a sequence are stored beside the table, none is lost."""
    gone = lambda name, last: F.when(F.col("event_id") % 10 != last, F.col(name)).alias(name)
    events = _event_changes(spark, sf).select(gone("user_id", 3), gone("ts", 4), "event_id", "event_type")
    path, home = stage.land(events, spark, "faulty-changes"), new_dir(spark, "scd-quarantine")
    target = BucketedTable(spark, f"{home}/table", ["user_id"], buckets=8)
    apply.apply_scd1(
        file_stream(spark, path, events.schema), target, f"{home}/checkpoint", ["ts", "event_id"],
        except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
    )
    missing = F.when(F.col("user_id").isNull(), "user_id").otherwise("ts")
    return target.quarantined().select("event_id", missing.alias("missing"), "event_type")


@query("scd1_late_rows", _LATEST_SQL)
def scd1_late_rows(spark, sf):
    """The same in batch form: a state from the later rows, then the earlier rows as news."""
    events = _event_changes(spark, sf)
    form = dict(except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error")
    afternoon = F.hour("ts") >= 12
    state = ch.scd1(None, ch.newest(
        ch.scd1_changes(events.filter(afternoon), ["user_id"], ["ts", "event_id"], **form), ["user_id"]), ["user_id"])
    news = ch.scd1_changes(events.filter(~afternoon), ["user_id"], ["ts", "event_id"], **form)
    return ch.scd1_rows(ch.scd1(state, news, ["user_id"]))


_VERSIONS_SQL = """
    WITH c AS (SELECT user_id, ts, event_type, event_type = 'error' AS gone FROM events),
    m AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM c),
    r AS (SELECT user_id, ts, event_type, gone, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
          FROM m WHERE event_type IS DISTINCT FROM before)
    SELECT user_id, event_type, ts AS start_at, until AS end_at FROM r WHERE NOT gone
"""


def _shown(versions):
    return versions.select("user_id", "event_type", F.col(ch.START).alias("start_at"), F.col(ch.END).alias("end_at"))


@query("scd2_changes", _VERSIONS_SQL)
def scd2_changes(spark, sf):
    log = ch.scd2_log(
        table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
        except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
    )
    return _shown(ch.scd2_history(log, ["user_id"]))


@query("scd2_changes_stream", _VERSIONS_SQL)
def scd2_changes_stream(spark, sf):
    """Type 2 table kept from a stream; late rows rebuild the versions of their keys."""
    schema, path = _landed_in_two_parts(spark, sf)
    home = new_dir(spark, "scd2")
    target = BucketedTable(spark, f"{home}/table", ["user_id"], buckets=8)
    log = BucketedLog(spark, f"{home}/log", target)
    apply.apply_scd2(
        file_stream(spark, path, schema, max_files=1), target, log, f"{home}/checkpoint", ["ts", "event_id"],
        except_columns=["ts", "event_id", "value", "props"], delete_when=F.col("event_type") == "error",
    )
    return _shown(target.read())


@query("scd2_track_except", """
    WITH c AS (SELECT user_id, ts, event_type, value, event_type = 'error' AS gone FROM events),
    m AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM c),
    g AS (SELECT *, sum(CASE WHEN event_type IS DISTINCT FROM before THEN 1 ELSE 0 END)
                    OVER (PARTITION BY user_id ORDER BY ts) AS run FROM m),
    r AS (SELECT user_id, run, min(ts) AS start_at, arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value,
                 bool_or(gone) AS gone FROM g GROUP BY 1, 2),
    e AS (SELECT *, lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS end_at FROM r)
    SELECT user_id, event_type, value, start_at, end_at FROM e WHERE NOT gone
""")
def scd2_track_except(spark, sf):
    """A changed value alone opens no version; the open version shows the newest value."""
    log = ch.scd2_log(
        table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"],
        ["ts", "event_id"], except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
    )
    versions = ch.scd2_history(log, ["user_id"], track_except=["value"])
    return versions.select(
        "user_id", "event_type", "value", F.col(ch.START).alias("start_at"), F.col(ch.END).alias("end_at")
    )


_SNAPSHOTS_SQL = f"""
    WITH s AS ({YEARLY_STATES_SQL}),
    m AS (SELECT *, lag(snapshot_year) OVER w AS py, lag(o_orderstatus) OVER w AS ps, lag(o_orderpriority) OVER w AS pp
          FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY snapshot_year)),
    g AS (SELECT *, sum(CASE WHEN py IS NULL OR py < snapshot_year - 1 OR ps <> o_orderstatus OR pp <> o_orderpriority
                        THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY snapshot_year) AS run FROM m),
    v AS (SELECT o_custkey, run, min(snapshot_year) AS first_year, max(snapshot_year) AS last_year,
                 any_value(o_orderstatus) AS o_orderstatus, any_value(o_orderpriority) AS o_orderpriority,
                 arg_max(o_totalprice, snapshot_year) AS o_totalprice FROM g GROUP BY 1, 2)
    SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, first_year AS start_year,
           CASE WHEN last_year < (SELECT max(snapshot_year) FROM s) THEN last_year + 1 END AS end_year FROM v
"""


def _versions_of_years(spark, sf):
    """One full snapshot per year, each applied to the state that the one before left."""
    states = materialize(stage.yearly_states(spark, sf), "yearly")
    first, last = states.agg(F.min("snapshot_year"), F.max("snapshot_year")).first()
    history = SnapshotHistory(spark, new_dir(spark, "snapshot-history"), ["o_custkey"])
    for year in range(first, last + 1):
        snapshot = states.filter(F.col("snapshot_year") == year).drop("snapshot_year")
        history.apply(snapshot, dt.datetime(year, 1, 1), track_except=["o_totalprice"])
    return history.read()


def _years(versions):
    return versions.select(
        "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.year(ch.START).alias("start_year"), F.year(ch.END).alias("end_year"),
    )


@query("scd2_snapshot", _SNAPSHOTS_SQL)
def scd2_snapshot(spark, sf):
    return _years(_versions_of_years(spark, sf))


@query("scd2_current", f"SELECT o_custkey, o_orderstatus, o_orderpriority FROM ({_SNAPSHOTS_SQL}) WHERE end_year IS NULL")
def scd2_current(spark, sf):
    return ch.current(_versions_of_years(spark, sf)).select("o_custkey", "o_orderstatus", "o_orderpriority")


@query("scd2_changed_keys", f"""
    WITH v AS ({_SNAPSHOTS_SQL}) SELECT *, 2 AS versions FROM v
    WHERE o_custkey IN (SELECT o_custkey FROM v GROUP BY 1 HAVING count(*) = 2) ORDER BY o_custkey, start_year
""")
def scd2_changed_keys(spark, sf):
    found = ch.changed_keys(_versions_of_years(spark, sf), ["o_custkey"])
    shown = found.withColumns({"start_year": F.year(ch.START), "end_year": F.year(ch.END)})
    return shown.drop(ch.START, ch.END).orderBy("o_custkey", "start_year")


@query("surrogate_keys", "SELECT count(DISTINCT (user_id, start_at)) AS versions, true AS all_keys_differ FROM "
       f"({_VERSIONS_SQL})")
def surrogate_keys(spark, sf):
    """Stable keys of all versions; counted, as other engines have no such hash."""
    log = ch.scd2_log(
        table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"],
        except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error",
    )
    keyed = ch.surrogate_key(ch.scd2_history(log, ["user_id"]), ["user_id", ch.START], "sk")
    return keyed.agg(
        F.count(F.lit(1)).alias("versions"), (F.countDistinct("sk") == F.count(F.lit(1))).alias("all_keys_differ")
    )


@query("scd2_snapshot_quarantine", f"""
    WITH s AS ({YEARLY_STATES_SQL})
    SELECT snapshot_year, o_orderstatus, o_orderpriority, o_totalprice FROM s WHERE o_custkey % 11 = 5
""")
def scd2_snapshot_quarantine(spark, sf):
    """Every eleventh customer of the yearly snapshots has lost its key: these rows are stored beside the history."""
    states = materialize(stage.yearly_states(spark, sf), "yearly")
    faulty = states.withColumn("o_custkey", F.when(F.col("o_custkey") % 11 != 5, F.col("o_custkey")))
    first, last = states.agg(F.min("snapshot_year"), F.max("snapshot_year")).first()
    history = SnapshotHistory(spark, new_dir(spark, "snapshot-quarantine"), ["o_custkey"])
    for year in range(first, last + 1):
        history.apply(faulty.filter(F.col("snapshot_year") == year).drop("snapshot_year"), dt.datetime(year, 1, 1))
    return history.quarantined().select(F.year("at").alias("snapshot_year"), "o_orderstatus", "o_orderpriority", "o_totalprice")


@query("change_feed_unkeyed", """
    SELECT o_orderstatus, o_orderpriority, count(*) FILTER (o_orderkey % 2 = 0) AS old_rows, count(*) FILTER (o_orderkey % 3 = 0) AS new_rows
    FROM orders WHERE o_orderkey % 7 = 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) GROUP BY 1, 2
""")
def change_feed_unkeyed(spark, sf):
    """Rows without a key of two states: what the change feed between them cannot name, counted."""
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        key.alias("id"), F.when(key % 7 != 0, key).alias("o_orderkey"), "o_orderstatus", "o_orderpriority")
    old, new = (orders.where(F.col("id") % n == 0).drop("id") for n in (2, 3))
    return ch.unkeyed(old, new, ["o_orderkey"]).drop("o_orderkey")

"""Quality, pairing, timeline, geography and neighbour queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import geography
from ledgerline.functions.hashing import hash_index
from ledgerline.operators import nearest, pairing, quality, timeline, vectors
from ledgerline.streaming import expect
from ledgerline.streaming.ingest import file_stream
from ledgerline.workspace import materialize, new_dir
from workload import stage
from workload.registry import hash_sql, query, unit_sql
from workload.stage import table

_ORDER_KEY = ["o_custkey", "o_orderdate"]


@query("duplicate_keys", 'SELECT o_custkey, o_orderdate, count(*) AS "count" FROM orders GROUP BY 1, 2 HAVING count(*) >= 2')
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "orders"), _ORDER_KEY)


@query("quarantine", """
    SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS "count" FROM orders) WHERE "count" >= 2
""")
def quarantine(spark, sf):
    return quality.quarantine(table(spark, sf, "orders"), _ORDER_KEY)


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("expectation_metrics", """
    SELECT 'customer' AS dataset, 'phone_length' AS rule, count(*) FILTER (length(c_name) <= 13) AS passed,
           count(*) - count(*) FILTER (length(c_name) <= 13) AS failed FROM customer
    UNION ALL SELECT 'customer', 'known_segment', count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')),
           count(*) - count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) FROM customer
    UNION ALL SELECT 'orders', 'one_order_per_day', count(*) FILTER (n = 1), count(*) FILTER (n > 1)
    FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)
""")
def expectation_metrics(spark, sf):
    customers = quality.expectation_metrics(
        table(spark, sf, "customer"), "customer",
        {"phone_length": F.length("c_name") <= 13, "known_segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")},
    )
    keys = quality.key_counts(table(spark, sf, "orders"), _ORDER_KEY)
    return customers.unionByName(
        quality.expectation_metrics(keys, "orders", {"one_order_per_day": F.col("count") == 1})
    )


@query("expectation_drop", "SELECT * FROM customer WHERE c_acctbal > 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def expectation_drop(spark, sf):
    rules = {"positive": F.col("c_acctbal") > 0, "segment": F.col("c_mktsegment").isin("BUILDING", "MACHINERY")}
    return quality.expect(table(spark, sf, "customer"), rules, quality.DROP)


@query("expectations_stream", """
    WITH e AS (SELECT event_id, value > 20 AS a, event_type <> 'error' AND event_id % 9 > 0 AS b FROM events)
    SELECT 'high_value' AS name, count(*) FILTER (a) AS passed, count(*) FILTER (NOT a) AS failed FROM e
    UNION ALL SELECT 'usable', count(*) FILTER (b), count(*) FILTER (NOT b) FROM e
    UNION ALL SELECT 'rows', count(*) FILTER (a AND b), count(*) FILTER (NOT (a AND b)) FROM e
    UNION ALL SELECT 'ids', sum(event_id) FILTER (a AND b), sum(event_id) FILTER (NOT (a AND b)) FROM e
""")
def expectations_stream(spark, sf):
    """Rules on a stream: counts per micro-batch, rows that fail stored apart. Shown: the counts, and the rows of either table."""
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    landing, home = stage.land(events, spark, "expected"), new_dir(spark, "expectations")
    checked = expect.ExpectedTable(spark, f"{home}/table")
    usable = F.when(F.col("event_id") % 9 > 0, F.col("event_type") != "error")  # NULL fails
    expect.expect_stream(
        file_stream(spark, landing, events.schema, max_files=1), {"high_value": F.col("value") > 20, "usable": usable},
        checked, f"{home}/checkpoint",
    )
    counts = checked.metrics().groupBy(F.col("rule").alias("name")).agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
    sides = [
        rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids")).select(F.stack(F.lit(2), F.lit("rows"), "rows", F.lit("ids"), "ids").alias("name", side))
        for rows, side in ((checked.accepted(), "passed"), (checked.rejected(), "failed"))
    ]
    return counts.unionByName(sides[0].join(sides[1], "name"))


@query("key_checks", """
    SELECT 'lineitem' AS name, count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
           0 AS null_key_rows, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS unique_key FROM lineitem
    UNION ALL SELECT 'orders', count(*), count(DISTINCT o_orderkey), 0, count(*) = count(DISTINCT o_orderkey) FROM orders
""")
def key_checks(spark, sf):
    lines = quality.check_primary_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = quality.check_primary_key(table(spark, sf, "orders"), ["o_orderkey"])
    return lines.withColumn("name", F.lit("lineitem")).unionByName(orders.withColumn("name", F.lit("orders")))


@query("foreign_keys", """
    SELECT count(*) FILTER (c_custkey IS NULL AND user_id IS NOT NULL) AS orphan_rows,
           count(DISTINCT user_id) FILTER (c_custkey IS NULL) AS missing_keys,
           count(*) FILTER (user_id IS NULL) AS null_rows
    FROM (SELECT CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 50 = 8 THEN -event_id ELSE user_id END AS user_id FROM events)
    LEFT JOIN customer ON c_custkey = user_id
""")
def foreign_keys(spark, sf):
    """Events of no known customer; some ids are blanked or made unknown first, all others exist."""
    user = F.when(F.col("event_id") % 50 == 7, None).when(F.col("event_id") % 50 == 8, -F.col("event_id")).otherwise(F.col("user_id"))
    events = table(spark, sf, "events").withColumn("user_id", user)
    return quality.check_foreign_key(events, table(spark, sf, "customer"), "user_id", "c_custkey")


def _fault_sql(column: str, rate: float, fault: str, value: str) -> str:
    return f"CASE WHEN {unit_sql('event_id', 'fault:' + column)} < {rate} THEN {fault} ELSE {value} END"


@query("inject_faults", f"""
    WITH o AS (SELECT event_id, event_type AS channel, props AS level,
                      {_fault_sql('opened', 0.05, "TIMESTAMP '2024-07-31 00:00:00'", 'ts')} AS opened, ts FROM events)
    SELECT event_id, opened,
           {_fault_sql('due', 0.05, "CAST(CAST(opened AS DATE) - 1 AS TIMESTAMP)", 'ts + INTERVAL 5 HOUR')} AS due,
           {_fault_sql('channel', 0.1, "'BAD'", 'channel')} AS channel,
           {_fault_sql('level', 0.05, "'BAD'", 'level')} AS level,
           {_fault_sql('protocol', 0.05, 'NULL', 'CAST(epoch(ts) - epoch(ts) % 1 AS BIGINT)')} AS protocol FROM o
""")
def inject_faults(spark, sf):
    tickets = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("opened"), (F.col("ts") + F.expr("INTERVAL 5 HOURS")).alias("due"),
        F.col("event_type").alias("channel"), F.col("props").alias("level"),
        F.unix_timestamp("ts").alias("protocol"),
    )
    rules = quality.ticket_fault_rules(
        opened="opened", due="due", channel="channel", level="level", protocol="protocol",
        future=F.lit("2024-07-01").cast("date"),
    )
    return quality.inject_faults(tickets, F.col("event_id"), rules)


@query("cross_join_schedule", "SELECT o_orderkey, r_regionkey, r_name FROM orders, region")
def cross_join_schedule(spark, sf):
    """Every order with every template row; the five regions stand for the templates."""
    templates = table(spark, sf, "region").select("r_regionkey", "r_name")
    return pairing.expand_schedule(table(spark, sf, "orders").select("o_orderkey"), templates)


@query("zip_rows", """
    SELECT p_partkey, o_orderkey, rn AS row_number
    FROM (SELECT p_partkey, row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS rn FROM part)
    JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) USING (rn)
""")
def zip_rows(spark, sf):
    """Parts in random (hash) order against orders in key order."""
    parts = table(spark, sf, "part").select("p_partkey", F.md5(F.col("p_partkey").cast("string")).alias("h"))
    orders = table(spark, sf, "orders").select("o_orderkey")
    return pairing.zip_rows(parts, orders, ["h", "p_partkey"], ["o_orderkey"]).drop("h")


@query("lookup_random_pick", f"""
    WITH s AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn,
                      count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier)
    SELECT c_custkey, s_suppkey, n_name FROM customer JOIN s ON s_nationkey = c_nationkey
           AND rn = {hash_sql('c_custkey', 'pick')} % n + 1 JOIN nation ON n_nationkey = c_nationkey
""")
def lookup_random_pick(spark, sf):
    """A supplier of the own nation for every customer, and the nation's name by its key."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    picked = pairing.pick_one(customers, suppliers, F.col("c_custkey"), ["s_suppkey"], ["nation"])
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return pairing.lookup_join(picked, names, ["nation"]).select("c_custkey", "s_suppkey", "n_name")


@query("session_timeline", f"""
    WITH e AS (SELECT *, CAST(floor(value) AS BIGINT) % 50 + 5 AS d, {hash_sql('event_id', 'gap')} % 8 AS g FROM events)
    SELECT event_id, user_id, d AS duration, d * ({hash_sql('event_id', 'down')} % 1000) AS volume,
           CAST(1727740800 + sum(g) OVER w + sum(d) OVER w - d AS BIGINT) AS start_at,
           CAST(1727740800 + sum(g) OVER w + sum(d) OVER w AS BIGINT) AS end_at
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
""")
def session_timeline(spark, sf):
    key = F.col("event_id")
    sessions = table(spark, sf, "events").select(
        key, "user_id",
        (F.floor("value").cast("bigint") % 50 + 5).alias("duration"),
        hash_index(key, "gap", 8).alias("gap"),
        hash_index(key, "down", 1000).alias("down"),
    )
    timed = timeline.session_times(
        sessions, ["user_id"], ["event_id"], base=F.lit(1727740800), gap="gap", duration="duration"
    )
    return timed.withColumn("volume", F.col("duration") * F.col("down")).drop("gap", "down")


@query("session_arrays", f"""
    WITH s AS (SELECT o_orderkey, unnest(range(1, 21)) AS session FROM orders),
    v AS (SELECT *, {hash_sql("o_orderkey || ':' || session", 'duration')} % 50 + 5 AS d,
                 {hash_sql("o_orderkey || ':' || session", 'gap')} % 8 AS g FROM s)
    SELECT o_orderkey, session, d AS duration, CAST(1727740800 + sum(g) OVER w + sum(d) OVER w - d AS BIGINT) AS start_at,
           CAST(1727740800 + sum(g) OVER w + sum(d) OVER w AS BIGINT) AS end_at
    FROM v WINDOW w AS (PARTITION BY o_orderkey ORDER BY session)
""")
def session_arrays(spark, sf):
    """Twenty sessions per order, held in two parallel arrays, to timed rows."""
    def values(salt, size, least):
        part = lambda i: F.concat_ws(":", F.col("o_orderkey").cast("string"), i.cast("string"))
        return F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: hash_index(part(i), salt, size) + least)

    arrays = stage.spread(table(spark, sf, "orders").select("o_orderkey")).select(
        "o_orderkey", values("gap", 8, 0).alias("gap"), values("duration", 50, 5).alias("duration")
    )
    timed = timeline.expand_sessions(arrays, base=F.lit(1727740800), gaps="gap", durations="duration")
    return timed.drop("gap")


@query("dms_to_decimal", f"""
    WITH p AS (SELECT o_orderkey, {hash_sql('o_orderkey', 'a')} % 34 AS ad, {hash_sql('o_orderkey', 'b')} % 60 AS am,
                      {hash_sql('o_orderkey', 'c')} % 60 AS s, {hash_sql('o_orderkey', 'd')} % 39 + 35 AS od,
                      {hash_sql('o_orderkey', 'north')} % 5 = 0 AS north FROM orders)
    SELECT o_orderkey, round((ad + am / 60.0::DOUBLE + s / 3600.0::DOUBLE) * (CASE WHEN north THEN 1 ELSE -1 END), 9) AS lat_decimal,
           round(-(od + s / 60.0::DOUBLE + am / 3600.0::DOUBLE), 9) AS lon_decimal FROM p
""")
def dms_to_decimal(spark, sf):
    key = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    a, b, c = hash_index(key, "a", 34), hash_index(key, "b", 60), hash_index(key, "c", 60)
    letter = F.when(hash_index(key, "north", 5) == 0, "N").otherwise("S")
    written = table(spark, sf, "orders").select(
        key,
        F.concat(two(a), letter, two(b), two(c)).alias("Latitude"),
        F.concat(two(hash_index(key, "d", 39) + 35), F.lit("W"), two(c), two(b)).alias("Longitude"),
    )
    decimal = geography.decimal_stations(written)
    return decimal.select(
        key, F.round("lat_decimal", 9).alias("lat_decimal"), F.round("lon_decimal", 9).alias("lon_decimal")
    )


_PLACES_SQL = f"""
    SELECT c_custkey, {unit_sql('c_custkey', 'lat')} * 38 - 33 AS lat, {unit_sql('c_custkey', 'lon')} * 38 - 73 AS lon FROM customer
"""


@query("scatter_points", f"""
    SELECT c_custkey, copy, round(lat + ({unit_sql("c_custkey || ':' || copy", 'lat')} * 2 - 1) * (2 / 111.11::DOUBLE), 9) AS lat,
           round(lon + ({unit_sql("c_custkey || ':' || copy", 'lon')} * 2 - 1) * (2 / 111.11::DOUBLE), 9) AS lon
    FROM (SELECT *, unnest(range(1, 41)) AS copy FROM ({_PLACES_SQL}))
""")
def scatter_points(spark, sf):
    places = stage.coordinates(stage.spread(table(spark, sf, "customer").select("c_custkey")), "c_custkey")
    points = geography.scatter(places, F.col("c_custkey"), copies=40, km=2.0, lat="lat", lon="lon")
    return points.select("c_custkey", "copy", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"))


@query("grid_cells", f"""
    WITH p AS ({_PLACES_SQL}), b AS (SELECT *, min(lat) OVER () AS a0, min(lon) OVER () AS o0,
         round((max(lat) OVER () - min(lat) OVER ()) / 100, 1) AS sa, round((max(lon) OVER () - min(lon) OVER ()) / 100, 1) AS so FROM p)
    SELECT c_custkey, CAST(trunc((lat - a0) / sa) AS INTEGER) * 100 + CAST(trunc((lon - o0) / so) AS INTEGER) AS grp FROM b
""")
def grid_cells(spark, sf):
    places = stage.coordinates(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return geography.grid_cells(places, 100).select("c_custkey", "grp")


@query("knn_grid", f"""
    WITH s AS (SELECT s_suppkey, {unit_sql('s_suppkey', 'lat')} * 38 - 33 AS slat, {unit_sql('s_suppkey', 'lon')} * 38 - 73 AS slon FROM supplier),
    d AS (SELECT c_custkey, s_suppkey, (slat - lat) * (slat - lat) + (slon - lon) * (slon - lon) AS distance FROM ({_PLACES_SQL}), s),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY distance, s_suppkey) AS rank FROM d)
    SELECT c_custkey, s_suppkey, round(distance, 9) AS distance, rank FROM r WHERE rank <= 3
""")
def knn_grid(spark, sf):
    """The three nearest suppliers of every customer."""
    suppliers = stage.coordinates(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey")
    customers = stage.coordinates(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    found = nearest.knn_join(customers, suppliers, 3, query_id="c_custkey", point_id="s_suppkey")
    return found.withColumn("distance", F.round("distance", 9))


@query("knn_vectors", """
    WITH d AS (SELECT a.vec_id AS q, b.vec_id AS p,
                      array_distance(CAST(a.embedding AS DOUBLE[64]), CAST(b.embedding AS DOUBLE[64])) ** 2 AS distance
               FROM embeddings a, embeddings b),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY distance, p) AS rank FROM d)
    SELECT q, p, round(distance, 6) AS distance, rank FROM r WHERE rank <= 3
""")
def knn_vectors(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    found = vectors.knn_vectors(embeddings, embeddings, 3, id="vec_id", vector="embedding", exact=True)
    return found.withColumn("distance", F.round("distance", 6))


@query("knn_vectors_approximate", """
    WITH n AS (SELECT count(*) AS n FROM embeddings) SELECT n AS queries, 3 * n AS pairs, true AS recall_reached FROM n
""")
def knn_vectors_approximate(spark, sf):
    """Only the nearest lists are searched. Of all queries and ranks, at least nine in ten pairs are those of the exact search."""
    embeddings = table(spark, sf, "embeddings")
    found = materialize(vectors.knn_vectors(embeddings, embeddings, 3, id="vec_id", vector="embedding"), "approximate")
    exact = vectors.knn_vectors(embeddings, embeddings, 3, id="vec_id", vector="embedding", exact=True)
    hits = exact.join(found.select("q", "p"), ["q", "p"], "left_semi").agg(F.count(F.lit(1)))
    return found.agg(
        F.count_distinct("q").alias("queries"), F.count(F.lit(1)).alias("pairs"),
    ).withColumn("recall_reached", hits.scalar() >= 0.9 * F.col("pairs"))

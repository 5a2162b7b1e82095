"""Identity keys, stored change feeds, views kept from them, and a stored vector index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators.joins import lookup_join
from ledgerline.operators.timeline import traffic_budget
from ledgerline.operators.vector_index import VectorIndex
from ledgerline.operators.views import IncrementalView, Measures, rows_of_groups
from ledgerline.sources.clustering import ClusteredTable
from ledgerline.sources.feed import VERSION, ChangeTable
from ledgerline.sources.identity import IdentityKeys
from ledgerline.sources.tables import BucketedLog, BucketedTable, VersionedTable
from ledgerline.streaming import apply
from ledgerline.streaming.drift import ingest_drifting
from ledgerline.streaming.facts import Dimension, StarSink
from ledgerline.streaming.ingest import file_stream, run_stream
from ledgerline.streaming.progress import ProgressLog
from ledgerline.workspace import new_dir
from workload import stage
from workload.registry import query
from workload.stage import table


@query("identity_keys", """
    WITH y AS (SELECT DISTINCT year(o_orderdate) AS arrival, o_custkey FROM orders),
    f AS (SELECT o_custkey, min(arrival) AS first_arrival FROM y GROUP BY o_custkey)
    SELECT o_custkey, first_arrival, row_number() OVER (ORDER BY first_arrival, o_custkey) AS id FROM f
""")
def identity_keys(spark, sf):
    """Customers get identity keys as the orders of each year arrive; one year arrives a second time."""
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("arrival"), "o_custkey")
    first, last = orders.agg(F.min("arrival"), F.max("arrival")).first()
    numbers = IdentityKeys(spark, new_dir(spark, "identity"), ["o_custkey"], buckets=8)
    for year in [*range(first, last + 1), first + 1]:
        numbers.assign(orders.where(F.col("arrival") == year), token=str(year))
    arrivals = orders.groupBy("o_custkey").agg(F.min("arrival").alias("first_arrival"))
    return arrivals.join(numbers.read(), "o_custkey").select("o_custkey", "first_arrival", "id")


#: Three states of the customers, as changes with the number of the commit that brings them.
def _customer_changes(spark, sf):
    after = stage.customers(spark, sf)
    number = F.col("nu_doct").cast("long")
    before = stage.earlier_customers(after)
    news = after.join(before.select("nu_doct", F.col("CLIENT").alias("was")), "nu_doct", "left").where(
        F.col("was").isNull() | (F.col("was") != F.col("CLIENT"))).drop("was")
    gone = after.where(number % 13 == 0)
    return [rows.withColumns({"at": F.lit(k), "op": F.lit(op)}) for k, (rows, op) in enumerate(
        ((before, "put"), (news, "put"), (gone, "drop")), 1)]


def _customer_table(spark, sf, home):
    target = ChangeTable(spark, f"{home}/customers", ["nu_doct"], buckets=8, visible=ch.scd1_rows)
    for k, changes in enumerate(_customer_changes(spark, sf), 1):
        apply.merge_scd1(changes, target, f"commit-{k}", ["at"], except_columns=["at", "op"], delete_when=F.col("op") == "drop")
    return target


_CUSTOMER_STATES = """
    WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS nu_doct, c_name AS nu_tlfn,
                      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'P' WHEN 'BUILDING' THEN 'S' WHEN 'FURNITURE' THEN 'G'
                                        WHEN 'HOUSEHOLD' THEN 'PL' ELSE 'V' END AS CLIENT FROM customer),
    o AS (SELECT k, nu_doct, nu_tlfn, CASE WHEN k % 7 = 0 THEN 'P' ELSE CLIENT END AS CLIENT FROM c WHERE k % 10 <> 0)
"""


@query("stored_change_feed", _CUSTOMER_STATES + """
    SELECT nu_doct, nu_tlfn, CLIENT, 'insert' AS _change_type, 1 AS _commit_version FROM o
    UNION ALL SELECT nu_doct, nu_tlfn, CLIENT, 'insert', 2 FROM c WHERE k % 10 = 0
    UNION ALL SELECT o.nu_doct, o.nu_tlfn, o.CLIENT, 'update_preimage', 2 FROM o JOIN c USING (k) WHERE o.CLIENT <> c.CLIENT
    UNION ALL SELECT c.nu_doct, c.nu_tlfn, c.CLIENT, 'update_postimage', 2 FROM o JOIN c USING (k) WHERE o.CLIENT <> c.CLIENT
    UNION ALL SELECT nu_doct, nu_tlfn, CLIENT, 'delete', 3 FROM c WHERE k % 13 = 0
""")
def stored_change_feed(spark, sf):
    """The images that three commits of the customer table have stored."""
    feed = _customer_table(spark, sf, new_dir(spark, "feed")).changes()
    return feed.select("nu_doct", "nu_tlfn", "CLIENT", ch.OP, VERSION)


@query("dim_customer_from_stream", _CUSTOMER_STATES + """
    SELECT nu_doct, nu_tlfn, CLIENT, 1 AS start_version,
           CASE WHEN CLIENT <> final THEN 2 WHEN k % 13 = 0 THEN 3 END AS end_version
    FROM (SELECT o.*, c.CLIENT AS final FROM o JOIN c USING (k))
    UNION ALL SELECT c.nu_doct, c.nu_tlfn, c.CLIENT, 2, CASE WHEN k % 13 = 0 THEN 3 END
    FROM c LEFT JOIN o USING (k) WHERE o.k IS NULL OR o.CLIENT <> c.CLIENT
""")
def dim_customer_from_stream(spark, sf):
    """The customer dimension (type 2), fed by nothing but the stored change feed read as a stream."""
    home = new_dir(spark, "dim-feed")
    source = _customer_table(spark, sf, home)
    target = BucketedTable(spark, f"{home}/dim", ["nu_doct"], buckets=8)
    apply.apply_scd2(
        source.change_stream(stage.customers(spark, sf).schema, max_files=8), target, BucketedLog(spark, f"{home}/log", target),
        f"{home}/checkpoint", [VERSION], delete_when=F.col(ch.OP) == "delete",
    )
    return target.read().select(
        "nu_doct", "nu_tlfn", "CLIENT", F.col(ch.START).alias("start_version"), F.col(ch.END).alias("end_version"))


@query("category_performance_incremental", """
    SELECT c_mktsegment AS segment, year(o_orderdate) AS ano, quarter(o_orderdate) AS trimestre, count(*) AS invoices,
           count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(13,2))) AS DOUBLE) AS revenue,
           round(CAST(sum(CAST(o_totalprice AS DECIMAL(13,2))) AS DOUBLE) / count(*), 4) AS mean_invoice,
           CAST(min(CAST(o_totalprice AS DECIMAL(13,2))) AS DOUBLE) AS smallest, CAST(max(CAST(o_totalprice AS DECIMAL(13,2))) AS DOUBLE) AS largest
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderkey % 13 <> 0 GROUP BY ALL
""")
def category_performance_incremental(spark, sf):
    """Revenue by segment and quarter, kept from the change feed of the orders: loaded, corrected and extended, deleted from."""
    home = new_dir(spark, "view")
    key = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("ano"), F.quarter("o_orderdate").alias("trimestre"),
        F.col("o_totalprice").cast("decimal(13,2)").alias("price"),
    )
    wrong = F.when(key % 7 == 0, F.when(key % 2 == 0, F.lit(9999999)).otherwise(F.lit(0))).otherwise(F.col("price")).cast("decimal(13,2)")
    commits = [
        orders.where(key % 10 != 0).withColumn("price", wrong).withColumn("op", F.lit("put")),
        orders.where((key % 7 == 0) | (key % 10 == 0)).withColumn("op", F.lit("put")),
        orders.where(key % 13 == 0).withColumn("op", F.lit("drop")),
    ]
    segments = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    source = ChangeTable(spark, f"{home}/orders", ["o_orderkey"], buckets=8, visible=ch.scd1_rows)
    groups = ["segment", "ano", "trimestre"]
    measures = Measures.of(sums={"revenue": "price"}, least={"smallest": "price"}, greatest={"largest": "price"}, distinct={"customers": "o_custkey"})
    view = IncrementalView(spark, f"{home}/view", groups, measures, buckets=8)

    def shape(rows):
        return lookup_join(rows, segments, ["o_custkey"])

    for k, changes in enumerate(commits, 1):
        apply.merge_scd1(
            changes.withColumn("at", F.lit(k)), source, f"commit-{k}", ["at"], except_columns=["at", "op"], delete_when=F.col("op") == "drop")
        apply.apply_view(
            source.change_stream(orders.schema), view, f"{home}/checkpoint",
            lambda wanted: rows_of_groups(shape(ch.scd1_rows(source.read())), wanted, groups), shape,
        )
    mean = F.round(F.col("revenue").cast("double") / F.col("rows"), 4)
    shown = [F.col(c).cast("double").alias(c) for c in ("revenue", "smallest", "largest")]
    return view.read().select(*groups, F.col("rows").alias("invoices"), "customers", mean.alias("mean_invoice"), *shown)


@query("vector_index_search", """
    WITH q AS (SELECT vec_id AS q, embedding AS a FROM embeddings WHERE vec_id % 100 = 0),
    d AS (SELECT q, vec_id AS p, list_sum([(CAST(a[i] AS DOUBLE) - embedding[i]) * (CAST(a[i] AS DOUBLE) - embedding[i]) for i in range(1, len(a) + 1)]) AS distance
          FROM q, embeddings),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY distance, p) AS rank FROM d)
    SELECT q, rank, p, round(distance, 4) AS distance FROM r WHERE rank <= 5
""")
def vector_index_search(spark, sf):
    """An index built from two thirds of the vectors, to which the others are added and whose large lists are split;
    every list is probed here, so the answers are the exact ones."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    count = vectors.count()
    lists = max(2, int(count ** 0.5) // 2)
    index = VectorIndex(spark, new_dir(spark, "vector-index"))
    index.build(vectors.where("vec_id % 3 <> 0"), lists, id="vec_id", vector="embedding")
    index.add(vectors.where("vec_id % 3 = 0"), id="vec_id", vector="embedding", token="rest")
    index.rebalance(3 * count // lists)
    found = index.search(vectors.where("vec_id % 100 = 0"), 5, id="vec_id", vector="embedding", probes=count)
    return found.select("q", F.col("rank").cast("long").alias("rank"), "p", F.round("distance", 4).alias("distance"))


@query("curve_clustered_read", """
    SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
    WHERE l_suppkey BETWEEN 20 AND 24 OR l_partkey < 30 GROUP BY ALL
""")
def curve_clustered_read(spark, sf):
    """Lines clustered by day, part and supplier along one curve, in two lots; filters on the second and the third key."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"), "l_partkey", "l_suppkey", "l_quantity")
    clustered = ClusteredTable(spark, new_dir(spark, "curve"), ["day", "l_partkey", "l_suppkey"])
    clustered.append(lines.where("l_orderkey % 4 <> 0"), "first")
    clustered.cluster(files=32)
    clustered.append(lines.where("l_orderkey % 4 = 0"), "second")
    clustered.cluster(files=8)
    chosen = clustered.read().where(F.col("l_suppkey").between(20, 24) | (F.col("l_partkey") < 30))
    return chosen.groupBy("l_partkey", "l_suppkey", "day").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("drifting_stream", """
    SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE o_totalprice END AS DOUBLE) AS o_totalprice,
           CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           CASE o_orderkey % 3 WHEN 1 THEN '{"channel":"web' || o_orderkey || '"}' WHEN 2 THEN '{"o_totalprice":"R$ ' || o_orderkey || '"}' END AS _rescued_data
    FROM orders
""")
def drifting_stream(spark, sf):
    """Files of three kinds in one stream: one lacks a column, one has a column more, one has texts where numbers are declared."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    home, key = new_dir(spark, "drift"), F.col("o_orderkey")
    kinds = [
        orders.where(key % 3 == 0).drop("o_orderstatus"),
        orders.where(key % 3 == 1).withColumn("channel", F.concat(F.lit("web"), key)),
        orders.where(key % 3 == 2).withColumn("o_totalprice", F.concat(F.lit("R$ "), key)).withColumn("o_custkey", F.col("o_custkey").cast("int")),
    ]
    for n, rows in enumerate(kinds):
        rows.write.option("maxRecordsPerFile", stage.FILE_ROWS).parquet(f"{home}/landing/kind{n}")
        ingest_drifting(spark, f"{home}/landing", orders.schema, f"{home}/table", f"{home}/checkpoint")
    return spark.read.parquet(f"{home}/table").drop("batch", "_file")


@query("fact_stream_changing_dims", """
    SELECT o_orderkey, o_custkey, c_mktsegment AS segment,
           CASE WHEN o_custkey % 5 = 0 OR o_orderkey % 2 = 1 THEN 'new' ELSE 'old' END AS version
    FROM orders JOIN customer ON c_custkey = o_custkey
""")
def fact_stream_changing_dims(spark, sf):
    """Facts come in two batches. The customers' dimension is replaced between them, and every fifth customer is missing at
    first: facts of these wait, and are joined once when their customer has come."""
    home, key = new_dir(spark, "changing"), F.col("o_orderkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    dimension = VersionedTable(spark, f"{home}/dim")
    sink = StarSink(spark, f"{home}/star", {"customer": Dimension(dimension.read, ["o_custkey"], ["segment", "version"])})
    states = [customers.where("o_custkey % 5 <> 0").withColumn("version", F.lit("old")), customers.withColumn("version", F.lit("new"))]
    for n, state in enumerate(states):
        dimension.publish(state)
        orders.where(key % 2 == n).coalesce(1).write.mode("append").parquet(f"{home}/landing")
        sink.run(file_stream(spark, f"{home}/landing", orders.schema), f"{home}/checkpoint")
    return sink.facts()


@query("scd2_compacted", """
    WITH c AS (SELECT user_id, ts, event_type, event_type = 'error' AS gone FROM events),
    m AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM c),
    r AS (SELECT user_id, ts, event_type, gone, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
          FROM m WHERE event_type IS DISTINCT FROM before)
    SELECT user_id, event_type, ts AS start_at, until AS end_at FROM r WHERE NOT gone
""")
def scd2_compacted(spark, sf):
    """A type 2 table from a stream of many batches whose log and table are folded on the way."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    home = new_dir(spark, "scd2-compact")
    parts = 6
    events.repartition(parts, F.pmod(F.xxhash64("event_id"), F.lit(parts))).write.parquet(f"{home}/landing")
    target = BucketedTable(spark, f"{home}/table", ["user_id"], buckets=4)
    log = BucketedLog(spark, f"{home}/log", target)
    apply.apply_scd2(
        file_stream(spark, f"{home}/landing", events.schema, max_files=2), target, log, f"{home}/checkpoint", ["ts", "event_id"],
        except_columns=["ts", "event_id"], delete_when=F.col("event_type") == "error", compact_every=2,
    )
    return target.read().select("user_id", "event_type", F.col(ch.START).alias("start_at"), F.col(ch.END).alias("end_at"))


@query("stream_progress", """
    SELECT event_id % 4 AS batch, count(*) AS "rows", true AS has_rates FROM events GROUP BY 1
""")
def stream_progress(spark, sf):
    """What a listener has stored of a running stream: the rows of each of its four micro-batches."""
    events, home = table(spark, sf, "events"), new_dir(spark, "progress")
    with ProgressLog(spark, f"{home}/progress") as log:
        for n in range(4):
            events.where(F.col("event_id") % 4 == n).write.mode("append").parquet(f"{home}/landing")
            run_stream(file_stream(spark, f"{home}/landing", events.schema), f"{home}/table", f"{home}/checkpoint")
    shown = log.read().select("batch", "rows", ((F.col("seconds") > 0) & (F.col("rows_done") > 0)).alias("has_rates"))
    return shown


@query("traffic_budget", """
    SELECT c_custkey, begin_hour, end_hour, round(down, 4) AS down, round(0.1 * down, 4) AS up FROM (
        SELECT *, (gib / 30.0) * 0.1 * 1073741824 / ((end_hour - begin_hour) * 100 * 50) AS down FROM (
            SELECT c_custkey, CAST(5 + c_custkey % 40 AS DOUBLE) AS gib, c_custkey % 6 AS begin_hour, 7 + c_custkey % 5 AS end_hour FROM customer))
""")
def traffic_budget_query(spark, sf):
    """What each customer's sessions carry in the morning, from the monthly volume."""
    key = F.col("c_custkey")
    hours = table(spark, sf, "customer").select(
        "c_custkey", (key % 40 + 5).cast("double").alias("gib"), (key % 6).alias("begin_hour"), (key % 5 + 7).alias("end_hour"))
    budget = hours.withColumn("b", traffic_budget(F.col("gib"), F.col("begin_hour"), F.col("end_hour")))
    return budget.select("c_custkey", "begin_hour", "end_hour", F.round("b.down", 4).alias("down"), F.round("b.up", 4).alias("up"))

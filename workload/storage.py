"""Ingestion, stream, storage and message queries."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from ledgerline.operators import packing, pairing
from ledgerline.operators.joins import lookup_join
from ledgerline.operators.metrics import throughput
from ledgerline.plans import star
from ledgerline.sources import files, tables
from ledgerline.streaming import ingest
from ledgerline.workspace import new_dir
from workload import stage
from workload.registry import hash_sql, query
from workload.stage import CATEGORY_SQL, INVOICES_SQL, table


@query("bronze_snapshot_lineage", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           'orders.parquet' AS source_file, true AS stamped FROM orders
""")
def bronze_snapshot_lineage(spark, sf):
    bronze = files.snapshot_scan(spark, f"{sf}/orders.parquet")
    files.with_audit_time(bronze, "silver_ts").createOrReplaceTempView("bronze_orders")
    return spark.sql("""
        SELECT * EXCEPT (bronze_ts, silver_ts, _metadata_file_path),
               regexp_extract(_metadata_file_path, '[^/]+$', 0) AS source_file,
               bronze_ts IS NOT NULL AND silver_ts IS NOT NULL AS stamped
        FROM IDENTIFIER(:name)""", args={"name": "bronze_orders"})


@query("ingest_files_incremental", "SELECT *, true AS has_lineage FROM events")
def ingest_files_incremental(spark, sf):
    """Files arrive in two lots; each run loads only what its checkpoint has not seen."""
    events = table(spark, sf, "events")
    home = new_dir(spark, "ingest")
    landing, target, checkpoint = f"{home}/landing", f"{home}/bronze", f"{home}/checkpoint"
    morning = F.hour("ts") < 12
    for lot in (events.filter(morning), events.filter(~morning)):
        lot.write.option("maxRecordsPerFile", stage.FILE_ROWS).mode("append").parquet(landing)
        ingest.ingest_files(spark, landing, events.schema, target, checkpoint)
    ingest.ingest_files(spark, landing, events.schema, target, checkpoint)
    lineage = ["bronze_ts", "_metadata_file_path", "_metadata_file_modification_time"]
    complete = F.lit(True)
    for name in lineage:
        complete = complete & F.col(name).isNotNull()
    return spark.read.parquet(target).withColumn("has_lineage", complete).drop(*lineage)


_ORDERS_CSV = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, day date"
_CSV_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
              CAST(o_orderdate AS DATE) AS day FROM orders"""


def _orders_csv(spark, sf, compression):
    path = new_dir(spark, "orders-csv")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("day"),
    )
    tables.export_csv(orders, path, compression)
    return path


@query("csv_stream_ingest", _CSV_SQL)
def csv_stream_ingest(spark, sf):
    landing, home = _orders_csv(spark, sf, "snappy"), new_dir(spark, "csv-stream")
    stream = ingest.file_stream(
        spark, landing, _ORDERS_CSV, "csv", max_files=2, options={"header": "true"}
    )
    ingest.run_stream(stream, f"{home}/table", f"{home}/checkpoint", name="orders_csv")
    return spark.read.parquet(f"{home}/table")


@query("csv_export_roundtrip", _CSV_SQL)
def csv_export_roundtrip(spark, sf):
    return files.reference_csv(spark, _orders_csv(spark, sf, "gzip"), _ORDERS_CSV)


@query("rescue_columns", "SELECT page_id, url, html FROM pages")
def rescue_columns(spark, sf):
    """Pages with an unexpected column: it survives whole in the rescue column."""
    rescued = files.rescue_columns(table(spark, sf, "pages"), ["page_id", "url"])
    return rescued.select(
        "page_id", "url", F.from_json(files.RESCUED, "html string")["html"].alias("html")
    )


@query("table_stream_filtered", """
    SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS partition_date FROM events
    WHERE event_type IN ('purchase', 'signup', 'click') AND CAST(ts AS DATE) >= DATE '2024-01-10'
""")
def table_stream_filtered(spark, sf):
    """A table partitioned by date, itself written by a stream, read as a stream from one date on."""
    events = table(spark, sf, "events")
    landing, home = stage.land(events, spark, "event-table"), new_dir(spark, "table-stream")
    dated = ingest.table_stream(spark, landing, events.schema, max_bytes=2**30).select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("partition_date")
    )
    ingest.run_stream(dated, f"{home}/dated", f"{home}/dated-checkpoint", partition_by=["partition_date"])
    wanted = (F.col("partition_date") >= F.lit("2024-01-10").cast("date")) & F.col("event_type").isin("purchase", "signup", "click")
    stream = ingest.table_stream(spark, f"{home}/dated", dated.schema, where=wanted, max_bytes=2**30)
    ingest.run_stream(stream, f"{home}/table", f"{home}/checkpoint", partition_by=["partition_date"])
    return spark.read.parquet(f"{home}/table")


@query("message_pack_unpack", "SELECT *, CAST(ts AS DATE) AS partition_date FROM events")
def message_pack_unpack(spark, sf):
    """Producer: micro-batches become messages. Consumer: a stream of messages becomes rows again."""
    events = table(spark, sf, "events")
    landing, home = stage.land(events, spark, "to-pack"), new_dir(spark, "messages")

    def produce(batch, batch_id):
        packed = packing.pack_batches(batch, events.columns, size=500)
        packed.write.mode("overwrite").parquet(f"{home}/bus/batch={batch_id}")

    producer = ingest.table_stream(spark, landing, events.schema, max_bytes=2**30)
    ingest.run_batches(producer, produce, f"{home}/producer")
    body = spark.read.parquet(f"{home}/bus").drop("batch").schema
    consumer = ingest.file_stream(spark, f"{home}/bus", body).transform(packing.unpack_batches)
    dated = consumer.withColumn("partition_date", F.to_date("ts"))
    ingest.run_stream(dated, f"{home}/table", f"{home}/consumer", partition_by=["partition_date"])
    return spark.read.parquet(f"{home}/table").select(*events.columns, "partition_date")


@query("period_append", """
    WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(min(o_orderdate) OVER () AS DATE) AS first FROM orders)
    SELECT o_orderkey, day, CAST(floor(((year(day) - year(first)) * 12 + month(day) - month(first)
           + (day(day) - day(first)) / 31.0) / 2) AS INTEGER) AS period FROM d
""")
def period_append(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    path = new_dir(spark, "periods")
    tables.append_in_periods(orders, path, "day", months=2)
    return spark.read.parquet(path).select("o_orderkey", "day", "period")


@query("period_list", """
    SELECT DISTINCT CAST(floor(((year(day) - year(first)) * 12 + month(day) - month(first)
           + (day(day) - day(first)) / 31.0) / 2) AS INTEGER) AS period
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(min(o_orderdate) OVER () AS DATE) AS first FROM orders) ORDER BY 1
""")
def period_list(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return tables.with_period(orders, "day").select("period").distinct().orderBy("period")


@query("clustered_write_pruned_read", """
    SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n, min(l_partkey) AS first_part, max(l_partkey) AS last_part,
           sum(l_quantity) AS quantity FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31' GROUP BY 1
""")
def clustered_write_pruned_read(spark, sf):
    """A table written in key order; reading one season skips all other row groups by their statistics."""
    lines = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_partkey", "l_quantity")
    path = new_dir(spark, "clustered")
    tables.write_clustered(lines, path, ["day", "l_partkey"])
    season = F.col("day").between(F.lit("1997-03-01").cast("date"), F.lit("1997-05-31").cast("date"))
    return spark.read.parquet(path).filter(season).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_part"), F.max("l_partkey").alias("last_part"),
        F.sum("l_quantity").alias("quantity"),
    )


@query("refresh_fallback", """
    SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS newest, run, CASE run WHEN 2 THEN 'full' ELSE 'incremental' END AS way
    FROM orders, (SELECT unnest([1, 2, 3]) AS run) WHERE run > 1 OR o_orderkey % 3 > 0 GROUP BY o_custkey, run
""")
def refresh_fallback(spark, sf):
    """A view kept by a stream over its source. Run 1 is incremental. Then the source is rewritten, so that the files of
    the checkpoint are gone; run 2 notices and rebuilds everything. Run 3 goes on incrementally from there."""
    home = new_dir(spark, "refresh")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    source = f"{home}/source"

    def view_of(rows):
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("newest"))

    versions = tables.VersionedTable(spark, f"{home}/view")
    epoch = [0]

    def incremental():
        """Append what is new; a rewritten source has files that the last run did not leave there."""
        marks, grown = f"{home}/seen-{epoch[0]}", f"{home}/grown-{epoch[0]}"
        seen = {r[0] for r in spark.read.parquet(marks).collect()} if tables.path_exists(spark, marks) else set()
        now = {name for name, _, _ in tables.modified(spark, source) if name.startswith("part-")}
        if seen - now:
            raise RuntimeError("source was rewritten")
        stream = ingest.table_stream(spark, source, orders.schema)
        ingest.run_stream(stream, grown, f"{home}/checkpoint-{epoch[0]}")
        spark.createDataFrame([(n,) for n in now], "name string").write.mode("overwrite").parquet(marks)
        versions.publish(view_of(spark.read.parquet(grown)))
        return versions.read()

    def rebuild():
        epoch[0] += 1  # a new checkpoint over the rewritten source
        return view_of(spark.read.parquet(source))

    shown = []
    two_thirds = orders.filter("o_orderkey % 3 > 0")
    for run, change in ((1, two_thirds), (2, orders), (3, None)):
        if change is not None:
            change.write.mode("overwrite").parquet(source)
        rows, way = tables.refresh_with_fallback(incremental, versions, rebuild)
        shown.append(rows.withColumns({"run": F.lit(run), "way": F.lit(way)}))
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("source_throughput", """
    SELECT count(*) AS "rows", CAST(sum(strlen(CAST(doc_id AS VARCHAR)) + strlen(coalesce(text, ''))
           + strlen(coalesce(lang, '')) + strlen(coalesce(source, '')) + strlen(CAST(n_chars AS VARCHAR))) AS BIGINT) AS text_bytes,
           true AS took_time, true AS rates_agree
    FROM documents
""")
def source_throughput(spark, sf):
    """Rates of a real copy of the table, timed; SQL cannot know the time, so the arithmetic of the rates is checked."""
    documents, began = table(spark, sf, "documents"), time.perf_counter()
    copy = new_dir(spark, "copied")
    documents.write.parquet(copy)
    seconds = time.perf_counter() - began
    report = throughput(spark.read.parquet(copy), seconds)
    near = lambda a, b: F.abs(a - b) <= 1e-9 * F.abs(b)
    agree = near(F.col("rows_a_second") * F.col("seconds"), F.col("rows")) & near(
        F.col("gib_a_minute") * 1024 / 60 * F.col("seconds") * 2**20, F.col("text_bytes"))
    return report.select("rows", "text_bytes", (F.col("seconds") > 0).alias("took_time"), agree.alias("rates_agree"))


@query("source_size", "SELECT true AS all_files, true AS all_bytes, count(*) AS \"rows\" FROM orders")
def source_size(spark, sf):
    """Files and bytes of a landed table, from metadata alone, against the file listing; and its rows."""
    landing = stage.land(table(spark, sf, "orders"), spark, "sized")
    sizes = files.source_bytes(spark, f"{landing}/*.parquet")
    listed = [(n, size) for n, _, size in tables.modified(spark, landing) if n.endswith(".parquet")]
    return sizes.select(
        (F.col("files") == len(listed)).alias("all_files"), (F.col("bytes") == sum(s for _, s in listed)).alias("all_bytes")
    ).withColumn("rows", spark.read.parquet(landing).agg(F.count(F.lit(1))).scalar())


@query("replaced_table", """
    SELECT o_orderstatus, count(*) AS orders, 2 AS version FROM orders GROUP BY 1
""")
def replaced_table(spark, sf):
    """A table that exists is left alone unless it is to be replaced; then the new version is complete before it shows."""
    path = f"{new_dir(spark, 'replaced')}/table"
    by_status = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    old = by_status.filter("o_orderstatus = 'F'").withColumn("version", F.lit(1))
    new = by_status.withColumn("version", F.lit(2))
    tables.ensure_table(spark, path, lambda: old)
    kept = tables.ensure_table(spark, path, lambda: new)
    if [r["version"] for r in kept.collect()] != [1]:  # one row: one status
        raise AssertionError("an existing table was rebuilt")
    return tables.ensure_table(spark, path, lambda: new, replace=True)


@query("timed_stream", "SELECT event_id, user_id, event_type FROM events")
def timed_stream(spark, sf):
    """A continuous query that is stopped after a time; a second run over the same checkpoint takes what was left."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    landing, home = stage.land(events, spark, "timed"), new_dir(spark, "timed-stream")
    for last in (False, True):
        stream = ingest.file_stream(spark, landing, events.schema)
        query_ = ingest.run_stream(stream, f"{home}/table", f"{home}/checkpoint", available_now=last)
        if not last:
            ingest.run_for(query_, 1.0)
    return spark.read.parquet(f"{home}/table")


@query("fact_invoicing_stream", f"""
    SELECT l.nu_doct, l.ds_prdt, l.ds_plno, l.dt_ciclo_rcrg, dt_vncmt, dt_pgto, CAST(vl_ftra AS DOUBLE) AS vl_ftra,
           {CATEGORY_SQL} AS categoria_cliente
    FROM ({INVOICES_SQL}) l JOIN customer ON c_custkey = o_custkey
""")
def fact_invoicing_stream(spark, sf):
    """Invoices as a stream, joined to three stored dimensions, with the keys looked up again at the end."""
    from ledgerline.functions.labels import client_category

    invoices = stage.invoices(spark, sf)
    landing, home = stage.land(invoices, spark, "invoices"), new_dir(spark, "fact-stream")
    dates, customers, products = stage.dim_date(spark, sf), stage.dim_customer(spark, sf), stage.dim_product(spark, sf)
    fact = star.invoice_fact(
        ingest.file_stream(spark, landing, invoices.schema), dates, customers, products
    )
    ingest.run_stream(fact, f"{home}/fact", f"{home}/checkpoint")
    stored = spark.read.parquet(f"{home}/fact")
    named = star.join_star(
        stored,
        dates=(dates.select("SK_DIM_DATE", F.col("DATA").alias("dt_ciclo_rcrg")), "SK_DIM_DATE"),
        customers=(customers.select(
            "SK_DIM_CUSTOMER", "nu_doct", client_category(F.col("CLIENT")).alias("categoria_cliente")), "SK_DIM_CUSTOMER"),
        products=(products.select("SK_DIM_PRODUCT", "ds_prdt", "ds_plno"), "SK_DIM_PRODUCT"),
    )
    return named.select(
        "nu_doct", "ds_prdt", "ds_plno", "dt_ciclo_rcrg", F.col("DT_VNCMT").alias("dt_vncmt"),
        F.col("DT_PGTO").alias("dt_pgto"), F.col("VL_FTRA").cast("double").alias("vl_ftra"), "categoria_cliente",
    )


@query("fact_subscription", f"""
    WITH p AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) AS rn, count(*) OVER () AS n FROM part)
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS dt_ini_plno, p_partkey, CAST(o_orderkey % 2 AS INTEGER) AS state
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN p ON rn = {hash_sql('o_orderkey', 'product')} % n + 1
    WHERE o_orderstatus <> 'P'
""")
def fact_subscription(spark, sf):
    """Orders as a stream of subscriptions of a product picked by hash; status P marks closed versions,
    which must not reach the fact. Dimensions hold closed versions too."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("id_prdt"))
    orders = pairing.pick_one(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"),
        parts, F.col("o_orderkey"), ["id_prdt"], salt="product",
    )
    ended = F.when(F.col("o_orderstatus") == "P", F.lit("2002-01-01").cast("timestamp"))
    phones = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("nu_tlfn")
    )
    subscriptions = lookup_join(orders, phones, ["o_custkey"]).select(
        F.col("o_custkey").cast("string").alias("nu_doct"), "nu_tlfn",
        "id_prdt", F.col("o_orderdate").cast("date").alias("dt_ini_plno"),
        (F.col("o_orderkey") % 2).cast("smallint").alias("ID_ESTD_LNHA"),
        F.lit(0).cast("tinyint").alias("FL_DEBT_AUTM"), F.lit(1).cast("tinyint").alias("FL_CNTA_ONLN"),
        F.lit(1).cast("tinyint").alias("FL_PLNO_TTLR"), ended.alias("__END_AT"),
    )
    products = stage.snapshot_dimension(spark, parts, ["id_prdt"], F.col("id_prdt") % 10 != 1, "SK_DIM_PRODUCT")
    dates, customers = stage.dim_date(spark, sf), stage.dim_customer(spark, sf)
    landing, home = stage.land(subscriptions, spark, "subscriptions"), new_dir(spark, "subscription-fact")
    stream = ingest.file_stream(spark, landing, subscriptions.schema)
    ingest.run_stream(star.subscription_fact(stream, dates, customers, products), f"{home}/fact", f"{home}/checkpoint")
    named = star.join_star(
        spark.read.parquet(f"{home}/fact"),
        dates=(dates.select("SK_DIM_DATE", "DATA"), "SK_DIM_DATE"),
        customers=(customers.select("SK_DIM_CUSTOMER", "nu_doct"), "SK_DIM_CUSTOMER"),
        products=(products.select("SK_DIM_PRODUCT", "id_prdt"), "SK_DIM_PRODUCT"),
    )
    return named.select(
        F.col("nu_doct").cast("bigint").alias("o_custkey"), F.col("DATA").alias("dt_ini_plno"),
        F.col("id_prdt").alias("p_partkey"), F.col("ID_ESTD_LNHA").cast("int").alias("state"),
    )

"""Billing tables derived from the given star-schema tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerline.functions.hashing import hash_unit
from ledgerline.operators import changes as ch
from ledgerline.operators.history import SnapshotHistory
from ledgerline.operators.joins import lookup_join, spread_join
from ledgerline.plans import calendar, star
from ledgerline.sources.tables import modified
from ledgerline.workspace import materialize, new_dir

SEGMENT_CODES = {"AUTOMOBILE": "P", "BUILDING": "S", "FURNITURE": "G", "HOUSEHOLD": "PL", "MACHINERY": "V"}
_STORED: dict[tuple, DataFrame] = {}


def stored(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """Write a derived table once per session and state of the inputs; dimensions and facts are stored tables to the reports."""
    inputs = [p for t in ("customer", "orders", "lineitem", "part", "supplier") for p in modified(spark, f"{sf}/{t}.parquet")]
    key = (spark.sparkContext.applicationId, sf, name, hash(tuple(inputs)))
    if key not in _STORED:
        _STORED[key] = materialize(build(), name)
    return _STORED[key]


def forget() -> None:
    """Build derived tables anew when they are next asked for."""
    _STORED.clear()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def client_code(segment: Column) -> Column:
    from ledgerline.functions.labels import decode

    return decode(segment, SEGMENT_CODES)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("nu_doct"),
        F.col("c_name").alias("nu_tlfn"),
        client_code(F.col("c_mktsegment")).alias("CLIENT"),
    )


FIRST_STATE, SECOND_STATE = dt.datetime(1900, 1, 1), dt.datetime(1950, 1, 1)


def earlier_customers(rows: DataFrame) -> DataFrame:
    """An earlier state of the customers: every tenth is not there yet, every seventh is of another class."""
    number = F.col("nu_doct").cast("long")
    client = F.when(number % 7 == 0, F.lit("P")).otherwise(F.col("CLIENT"))
    return rows.filter(number % 10 != 0).withColumn("CLIENT", client)


def customer_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Type 2 versions of the customers from the change feed between two states of their table."""
    after = customers(spark, sf)
    before = earlier_customers(after)
    feeds = [
        ch.changes_between(old, new, ["nu_doct"]).withColumn("_commit_timestamp", F.lit(str(at)).cast("timestamp"))
        for old, new, at in ((before.limit(0), before, FIRST_STATE), (before, after, SECOND_STATE))
    ]
    log = ch.scd2_log(
        feeds[0].unionByName(feeds[1]), ["nu_doct"], ["_commit_timestamp"], delete_when=F.col(ch.OP) == "delete"
    )
    return ch.scd2_history(log, ["nu_doct"])


def dim_customer(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "dim-customer", lambda: star.dimension(
        customer_versions(spark, sf), ["nu_doct"], "SK_DIM_CUSTOMER"))


def snapshot_dimension(spark: SparkSession, rows: DataFrame, keys: list[str], earlier: Column, name: str) -> DataFrame:
    """A dimension from two snapshots: the rows ``earlier`` selects, with one that is withdrawn later, and all rows.

    The surrogate key is made from business key and snapshot time, and kept as first written.
    """
    kinds = dict(rows.dtypes)
    withdrawn = rows.sparkSession.range(1).select(*[
        F.lit("withdrawn" if kinds[k] == "string" else -1).cast(kinds[k]).alias(k) for k in rows.columns])
    history = SnapshotHistory(spark, new_dir(spark, name.lower()), keys)
    for snapshot, at in ((rows.filter(earlier).unionByName(withdrawn), FIRST_STATE), (rows, SECOND_STATE)):
        history.apply(snapshot.withColumn(name, F.xxhash64(*keys, F.lit(str(at)).cast("timestamp"))), at, keep=[name])
    return history.read()


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    """Products of the invoices: one per type and brand."""
    kinds = table(spark, sf, "part").select(F.col("p_type").alias("ds_prdt"), F.col("p_brand").alias("ds_plno")).distinct()
    return stored(spark, sf, "dim-product", lambda: snapshot_dimension(
        spark, kinds, ["ds_prdt", "ds_plno"], ~F.col("ds_plno").endswith("1"), "SK_DIM_PRODUCT"))


def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "dim-date", lambda: calendar.calendar(
        calendar.date_range_of(table(spark, sf, "orders"), "o_orderdate")))


def invoices(spark: SparkSession, sf: str) -> DataFrame:
    """Invoice lines: lines with the document and cycle date of their order and the names of their part."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_extendedprice").cast("decimal(13,2)").alias("vl_ftra"),
        F.col("l_shipdate").cast("date").alias("dt_pgto"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").cast("string").alias("nu_doct"),
        F.col("o_orderdate").cast("date").alias("dt_ciclo_rcrg"),
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("ds_prdt"), F.col("p_brand").alias("ds_plno")
    )
    joined = lookup_join(spread_join(lines, orders, ["l_orderkey"]), parts, ["l_partkey"])
    return joined.select(
        "l_orderkey", "l_linenumber", "nu_doct", "ds_prdt", "ds_plno", "dt_ciclo_rcrg",
        (F.col("l_orderkey") % 28 + 1).cast("tinyint").alias("dt_vncmt"),
        "dt_pgto",
        "vl_ftra",
        F.lit(None).cast("decimal(5,2)").alias("vl_rcrg"),
    )


def fact_invoicing(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "fact-invoicing", lambda: star.invoice_fact(
        invoices(spark, sf), dim_date(spark, sf), dim_customer(spark, sf), dim_product(spark, sf)))


def coordinates(df: DataFrame, key: str) -> DataFrame:
    """A place for every key: latitude in [-33, 5), longitude in [-73, -35)."""
    return df.withColumns(
        {
            "lat": hash_unit(F.col(key), "lat") * 38 - 33,
            "lon": hash_unit(F.col(key), "lon") * 38 - 73,
        }
    )


def spread(df: DataFrame) -> DataFrame:
    """Spread narrow rows evenly before each of them becomes many (the test tables are single files)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Rows in a landed file; the number of files follows from the data.
FILE_ROWS = 1_000_000


def land(df: DataFrame, spark: SparkSession, label: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as files of a landing directory and return its path."""
    path = new_dir(spark, label)
    writer = df.write.option("maxRecordsPerFile", FILE_ROWS)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def yearly_states(spark: SparkSession, sf: str) -> DataFrame:
    """Per year and customer the latest order: a snapshot of the active customers of each year."""
    orders = table(spark, sf, "orders")
    newest = F.max_by(
        F.struct("o_orderstatus", "o_orderpriority", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")
    )
    return (
        orders.groupBy(F.year("o_orderdate").alias("snapshot_year"), "o_custkey")
        .agg(newest.alias("n"))
        .select("snapshot_year", "o_custkey", "n.*")
    )


YEARLY_STATES_SQL = """
    SELECT snapshot_year, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM (
        SELECT *, year(o_orderdate) AS snapshot_year,
               row_number() OVER (PARTITION BY year(o_orderdate), o_custkey
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1
"""

CATEGORY_SQL = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Purpura' WHEN 'BUILDING' THEN 'Silver'
    WHEN 'FURNITURE' THEN 'Gold' WHEN 'HOUSEHOLD' THEN 'Platinum' WHEN 'MACHINERY' THEN 'VIP' END"""

INVOICES_SQL = """
    SELECT l_orderkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS nu_doct, o_custkey,
           p_type AS ds_prdt, p_brand AS ds_plno, CAST(o_orderdate AS DATE) AS dt_ciclo_rcrg,
           CAST(l_orderkey % 28 + 1 AS INTEGER) AS dt_vncmt, CAST(l_shipdate AS DATE) AS dt_pgto,
           CAST(l_extendedprice AS DECIMAL(13,2)) AS vl_ftra
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
"""

STAR_SQL = f"""
    SELECT i.*, {CATEGORY_SQL} AS categoria_cliente, c_name AS nu_tlfn, year(dt_ciclo_rcrg) AS ANO,
           'T' || quarter(dt_ciclo_rcrg) AS TRIMESTRE,
           CAST(date_trunc('month', dt_ciclo_rcrg) AS DATE) AS mes_ano
    FROM ({INVOICES_SQL}) i JOIN customer ON c_custkey = i.o_custkey
"""

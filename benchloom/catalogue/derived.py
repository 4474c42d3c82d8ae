"""Publication facts derived from the given tables, so that their amount follows the data.

* manifest: every line is a file, its return flag names the table, its ship year is the snapshot;
* order files: every order is a file of a table named by the order's priority;
* reports: a customer's orders are the tables of one run, and the lines are the files.

The SQL texts state the same rules for the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.catalogue.base import table

CENTS = "cast(round(l_extendedprice * 100) as bigint)"


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "cast(year(l_shipdate) as bigint) as snapshot_id",
        "concat('run-', year(l_shipdate)) as run_id",
        "concat('lineitem_', lower(l_returnflag)) as table",
        "concat('s3://lake/', l_orderkey, '/', l_linenumber, '.parquet') as uri",
        "cast(l_quantity as bigint) as rows",
        f"{CENTS} as size_bytes",
        "if(l_discount = 0.10, 'equality deletes', 'data') as content",
    )


MANIFEST_SQL = """
    SELECT year(l_shipdate) AS snapshot_id, 'lineitem_' || lower(l_returnflag) AS tbl,
           's3://lake/' || l_orderkey || '/' || l_linenumber || '.parquet' AS uri,
           CAST(l_quantity AS BIGINT) AS rows, CAST(round(l_extendedprice * 100) AS BIGINT) AS size_bytes,
           CASE WHEN l_discount = 0.10 THEN 'equality deletes' ELSE 'data' END AS content
    FROM lineitem"""


def _order_files(spark: SparkSession, folder: str, status: str, until: str, rows) -> DataFrame:
    """One file per order; lines are counted per order before the join with the orders."""
    lines = (
        table(spark, folder, "lineitem")
        .where(F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz"))
        .groupBy("l_orderkey")
        .agg(rows.alias("rows"))
    )
    orders = table(spark, folder, "orders").where(F.col("o_orderstatus").isin(*status))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "concat('orders_', substr(o_orderpriority, 1, 1)) as table",
        "concat('s3://lake/orders/', o_orderkey, '.parquet') as uri",
        "rows",
        "rows * 64 + 12 as size_bytes",
    )


def expected_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What should be published: every order that is not pending, with all its lines."""
    return _order_files(spark, folder, "FO", "9999-01-01", F.count("*"))


def published_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What a publisher wrote that stopped in mid 2001 and kept one line per line number."""
    found = _order_files(spark, folder, "FOP", "2001-06-01", F.count_distinct("l_linenumber"))
    return found.withColumn("snapshot_id", F.lit(1).cast("bigint"))


EXPECTED_SQL = """
    SELECT 'orders_' || substr(o_orderpriority, 1, 1) AS tbl, 's3://lake/orders/' || o_orderkey || '.parquet' AS uri,
           count(*) AS rows, count(*) * 64 + 12 AS size_bytes
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY ALL"""
PUBLISHED_SQL = """
    SELECT 'orders_' || substr(o_orderpriority, 1, 1) AS tbl, 's3://lake/orders/' || o_orderkey || '.parquet' AS uri,
           count(DISTINCT l_linenumber) AS rows, count(DISTINCT l_linenumber) * 64 + 12 AS size_bytes
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate < '2001-06-01' GROUP BY ALL"""
DIFF_SQL = f"""
    SELECT coalesce(e.tbl, p.tbl) AS tbl, coalesce(e.uri, p.uri) AS uri,
           CASE WHEN p.uri IS NULL THEN 'missing' WHEN e.uri IS NULL THEN 'unexpected'
                ELSE 'rows or size differ' END AS difference,
           coalesce(e.rows, -1) AS expected_rows, coalesce(p.rows, -1) AS actual_rows
    FROM ({EXPECTED_SQL}) AS e FULL JOIN ({PUBLISHED_SQL}) AS p ON e.tbl = p.tbl AND e.uri = p.uri
    WHERE e.uri IS NULL OR p.uri IS NULL OR e.rows <> p.rows OR e.size_bytes <> p.size_bytes"""

# Statuses and states the derived reports show, by order priority and by line flags.
STATUS = (
    "case substr(o_orderpriority, 1, 1) when '1' then 'creating' when '2' then 'uploading' "
    "when '3' then 'committing' when '4' then 'succeeded' else 'skipped' end"
)
CREATION = (
    "case o_orderstatus when 'F' then 'created_and_validated' when 'O' then 'unknown_or_unvalidated' end"
)
FILE_STATE = (
    "case when l_returnflag = 'R' then 'commit_unknown' when l_returnflag = 'A' and l_linestatus = 'O' then 'local' "
    "when l_returnflag = 'A' then 'registered' when l_linestatus = 'O' then 'uploaded_unregistered' "
    "else 'upload_started' end"
)


def run_tables(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('run-', o_custkey) as run_id",
        "concat('order_', o_orderkey) as table",
        f"{STATUS} as status",
        f"{CREATION} as table_creation_state",
        "if(o_orderstatus = 'P', null, o_orderkey % 1000 + 1) as row_count",
        "if(o_orderstatus = 'P', null, cast(round(o_totalprice * 100) as bigint)) as size_bytes",
        "if(o_orderstatus = 'P', null, 1 + o_custkey % 3) as file_count",
    )


RUN_TABLES_SQL = f"""
    SELECT 'run-' || o_custkey AS run_id, 'order_' || o_orderkey AS tbl, {STATUS} AS status,
           {CREATION} AS table_creation_state,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderkey % 1000 + 1 END AS row_count,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS size_bytes,
           CASE WHEN o_orderstatus <> 'P' THEN 1 + o_custkey % 3 END AS file_count
    FROM orders"""


def run_files(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return (
        table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "concat('run-', o_custkey) as run_id",
            "concat('order_', o_orderkey) as table",
            f"{STATUS} as status",
            f"if(l_linestatus = 'O' and l_discount = 0, null, "
            "concat('s3://lake/', l_orderkey, '/', l_linenumber, '.parquet')) as uri",
            f"{FILE_STATE} as state",
            "cast(l_quantity as bigint) as row_count",
            f"{CENTS} as size_bytes",
        )
    )


RUN_FILES_SQL = f"""
    SELECT 'run-' || o_custkey AS run_id, 'order_' || o_orderkey AS tbl, {STATUS} AS status,
           CASE WHEN l_linestatus = 'O' AND l_discount = 0 THEN NULL
                ELSE 's3://lake/' || l_orderkey || '/' || l_linenumber || '.parquet' END AS uri,
           {FILE_STATE} AS state, CAST(l_quantity AS BIGINT) AS row_count,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS size_bytes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


# Error class of an attempt by order priority; the state could be read unless the order is pending.
ERROR = (
    "case substr(o_orderpriority, 1, 1) when '1' then 'timeout' when '2' then 'forbidden' "
    "when '3' then 'commit_conflict' when '4' then 'server_error' end"
)


def attempts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(parts, known, outcomes): one attempt per order; files shipped before 1999 were seen in the catalog."""
    # One pass over the lines gives every file once with whether it was seen; all three follow from that.
    marked = (
        table(spark, folder, "lineitem")
        .groupBy(
            F.concat(F.lit("order_"), "l_orderkey").alias("table"),
            F.concat(F.lit("s3://lake/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("uri"),
        )
        .agg(F.bool_or(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")).alias("seen"))
    )
    parts = marked.select("table", "uri")
    known = marked.where("seen").select("table", "uri")
    unverified = marked.where("not seen").groupBy("table").agg(F.lit(True).alias("open"))
    outcomes = (
        table(spark, folder, "orders")
        .selectExpr(
            "concat('order_', o_orderkey) as table",
            f"{ERROR} as error_class",
            "o_orderstatus <> 'P' as state_seen",
            "o_totalprice < 200000 as sizes_equal",
        )
        .join(unverified, "table", "left")
        .selectExpr("table", "error_class", "state_seen", "open is null and state_seen and sizes_equal as verified")
    )
    return parts, known, outcomes


ATTEMPTS_SQL = f"""
    parts AS (SELECT DISTINCT 'order_' || l_orderkey AS tbl, 's3://lake/' || l_orderkey || '/' || l_linenumber AS uri
              FROM lineitem),
    known AS (SELECT DISTINCT 'order_' || l_orderkey AS tbl, 's3://lake/' || l_orderkey || '/' || l_linenumber AS uri
              FROM lineitem WHERE l_shipdate < '1999-01-01'),
    marked AS (SELECT p.tbl, p.uri, k.uri IS NOT NULL AS seen FROM parts p LEFT JOIN known k ON p.uri = k.uri),
    outcomes AS (SELECT 'order_' || o_orderkey AS tbl, {ERROR} AS error_class, o_orderstatus <> 'P' AS state_seen,
                        o_orderstatus <> 'P' AND o_totalprice < 200000 AND NOT EXISTS
                          (SELECT * FROM marked WHERE NOT seen AND marked.tbl = 'order_' || o_orderkey) AS verified,
                        coalesce({ERROR} IN ('bad_request', 'commit_conflict', 'forbidden', 'unauthorized'), false)
                          AS rejected
                 FROM orders)"""

"""Queries over generated tables. Their scale factor is that of the given tables, so they grow with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.catalogue.base import ORACLE_DIR, register, table
from benchloom.catalogue.datasets import BENCH, RULES_SQL, base_name, scale_of
from benchloom.operators import conform
from benchloom.sources import files
from benchloom.sources.drawing import count_sources
from benchloom.sources.tpcds_data import LINEAR_ROWS, ROWS, WHOLE_BELOW_ONE, Tpcds
from benchloom.sources.tpch_data import Tpch

ORDERS_SQL = "(SELECT unnest(range((SELECT count(*) FROM orders))) AS o)"
LINES_SQL = f"(SELECT o, 1 + (3 * o + o // 7) % 7 AS n FROM {ORDERS_SQL} AS r)"
PARTS_SQL = "(SELECT unnest(range(1, 200000 * (SELECT count(*) FROM orders) // 1500000 + 1)) AS p)"
SUPPLIERS_SQL = "(10000 * (SELECT count(*) FROM orders) // 1500000)"


def tpch(spark: SparkSession, folder: str) -> Tpch:
    return Tpch(spark, scale_of(spark, folder))


@register(
    "gen_tpch_counts",
    "table:s generated:i given:i",
    f"""WITH rules AS ({RULES_SQL} UNION ALL SELECT 'lineitem', CAST(sum(n) AS BIGINT) FROM {LINES_SQL} AS l),
        given AS ({' UNION ALL '.join(f"SELECT '{n}' AS tbl, count(*) AS n FROM {n}" for n in BENCH)})
        SELECT rules.tbl AS "table", wanted AS generated, coalesce(n, 0) AS given
        FROM rules LEFT JOIN given ON given.tbl = rules.tbl""",
)
def _(spark, folder):
    given = count_sources({name: table(spark, folder, name) for name in BENCH}).withColumnRenamed("rows", "given")
    made = count_sources(tpch(spark, folder).tables()).withColumnRenamed("rows", "generated")
    return made.join(given, "table", "left").fillna(0, ["given"])


@register(
    "gen_tpch_lines",
    "lines:i orders:i first_key:i last_key:i given_orders:i",
    f"""WITH made AS (SELECT n AS lines, count(*) AS orders, min(o // 8 * 32 + o % 8 + 1) AS first_key,
                             max(o // 8 * 32 + o % 8 + 1) AS last_key FROM {LINES_SQL} AS l GROUP BY n),
             given AS (SELECT lines, count(*) AS given_orders
                       FROM (SELECT count(*) AS lines FROM lineitem GROUP BY l_orderkey) AS g GROUP BY lines)
        SELECT lines, coalesce(orders, 0) AS orders, first_key, last_key, coalesce(given_orders, 0) AS given_orders
        FROM made FULL JOIN given USING (lines)""",
)
def _(spark, folder):
    # How many orders have how many lines, as generated and as given.
    per_order = tpch(spark, folder).lineitem().groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    made = per_order.groupBy("lines").agg(
        F.count("*").alias("orders"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key")
    )
    given = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    given = given.groupBy("lines").agg(F.count("*").alias("given_orders"))
    return made.join(given, "lines", "full_outer").fillna(0, ["orders", "given_orders"])


@register(
    "gen_tpch_offers",
    "ps_suppkey:i offers:i price:d given_balance:d",
    f"""SELECT s_suppkey AS ps_suppkey, coalesce(offers, 0) AS offers, price, s_acctbal AS given_balance
        FROM supplier LEFT JOIN (
            SELECT (p + i * (s // 4 + (p - 1) // s)) % s + 1 AS ps_suppkey, count(*) AS offers,
                   sum(90000 + p // 10 % 20001 + 100 * (p % 1000)) / 100.0 AS price
            FROM {PARTS_SQL} AS r, (SELECT unnest([0, 1, 2, 3]) AS i) AS n, (SELECT {SUPPLIERS_SQL} AS s) AS c
            GROUP BY ALL) AS made ON s_suppkey = ps_suppkey""",
)
def _(spark, folder):
    # What each given supplier would offer.
    made = tpch(spark, folder)
    prices = made.part().select("p_partkey", "p_retailprice")
    offers = (
        made.partsupp()
        .join(prices, F.col("ps_partkey") == F.col("p_partkey"))
        .groupBy("ps_suppkey")
        .agg(F.count("*").alias("offers"), F.sum("p_retailprice").alias("price"))
    )
    given = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("ps_suppkey"), F.col("s_acctbal").alias("given_balance")
    )
    return given.join(offers, "ps_suppkey", "left").fillna(0, ["offers"])


# Keys of the generated parents: whole numbers from 0 or 1 on.
MADE_KEYS_SQL = {
    "region": "0 AND 4",
    "nation": "0 AND 24",
    "supplier": f"1 AND {SUPPLIERS_SQL}",
    "customer": "1 AND 150000 * (SELECT count(*) FROM orders) // 1500000",
    "part": "1 AND 200000 * (SELECT count(*) FROM orders) // 1500000",
}
GIVEN_KEYS = [key for key in conform.TPCH_FOREIGN_KEYS if key[0] != "partsupp" and key[2] in MADE_KEYS_SQL]


@register(
    "gen_tpch_orphans",
    "child:s child_column:s parent:s orphan_keys:i orphan_rows:i",
    " UNION ALL ".join(
        f"SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, "
        f"count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {child} "
        f"WHERE NOT {column} BETWEEN {MADE_KEYS_SQL[parent]}"
        for child, column, parent, _ in GIVEN_KEYS
    ),
)
def _(spark, folder):
    # The given rows against the generated parents: given keys start at 0 where the generator's start at 1.
    made = tpch(spark, folder)
    found = []
    for key in GIVEN_KEYS:
        pair = {key[0]: table(spark, folder, key[0]), key[2]: made.tables()[key[2]]}
        found.append(conform.fk_orphans(pair, (key,)))
    return reduce(DataFrame.unionByName, found)


@register(
    "gen_tpch_order_totals",
    "given_orders:i matched:i wrong_totals:i wrong_statuses:i",
    f"""SELECT count(*) AS given_orders, count(k) AS matched, 0 AS wrong_totals, 0 AS wrong_statuses
        FROM orders LEFT JOIN (SELECT o // 8 * 32 + o % 8 + 1 AS k FROM {ORDERS_SQL} AS r) AS made ON o_orderkey = k""",
)
def _(spark, folder):
    # For the given keys, totals and statuses of generated orders against their lines, which are made by another plan.
    made = tpch(spark, folder)
    cents = F.floor(
        F.col("l_extendedprice") * 100 * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    ) / 100
    lines = made.lineitem().groupBy("l_orderkey").agg(
        F.sum(cents).alias("total"),
        F.count_if(F.col("l_linestatus") == "O").alias("open"),
        F.count("*").alias("lines"),
    )
    status = F.when(F.col("open") == 0, "F").when(F.col("open") == F.col("lines"), "O").otherwise("P")
    given = table(spark, folder, "orders").select(F.col("o_orderkey").alias("given"))
    orders = made.orders().select("o_orderkey", "o_totalprice", "o_orderstatus")
    joined = (
        given.join(orders, F.col("given") == F.col("o_orderkey"), "left")
        .join(lines, F.col("given") == F.col("l_orderkey"), "left")
    )
    met = F.col("o_orderkey").isNotNull()
    return joined.agg(
        F.count("*").alias("given_orders"),
        F.count_if(met).alias("matched"),
        F.count_if(met & ~F.col("o_totalprice").eqNullSafe(F.col("total"))).alias("wrong_totals"),
        F.count_if(met & ~F.col("o_orderstatus").eqNullSafe(status)).alias("wrong_statuses"),
    )


def _tpcds_counts_sql() -> str:
    """Rows below scale 1, at which results are compared."""
    shrunk = "greatest(1, {} * (SELECT count(*) FROM orders) // 1500000)"
    first = {table: listed[0] for table, listed in ROWS.items()} | LINEAR_ROWS
    rows = [f"SELECT '{t}' AS tbl, {n if t in WHOLE_BELOW_ONE else shrunk.format(n)} AS n" for t, n in first.items()]
    item, warehouse = (shrunk.format(first[t]) for t in ("item", "warehouse"))
    rows.append(f"SELECT 'inventory', 261 * greatest(1, {item} // 2) * {warehouse}")
    return " UNION ALL ".join(rows)


GIVEN_ORDERS = "(SELECT count(*) FROM orders)"


def with_given_orders(spark: SparkSession, folder: str, df: DataFrame) -> DataFrame:
    """How many given orders the scale factor stands for, next to what was made of it."""
    return df.withColumn("given_orders", table(spark, folder, "orders").agg(F.count("*")).scalar())


@register(
    "gen_tpcds_counts",
    "table:s rows:i given_orders:i",
    f'SELECT tbl AS "table", n AS rows, {GIVEN_ORDERS} AS given_orders FROM ({_tpcds_counts_sql()}) AS c',
)
def _(spark, folder):
    return with_given_orders(spark, folder, count_sources(Tpcds(spark, scale_of(spark, folder)).tables()))


@register(
    "gen_tpcds_returns",
    "channel:s sales:i distinct_sales:i returns:i matched:i given_orders:i",
    """SELECT channel, sales, sales AS distinct_sales, rets AS returns, rets AS matched, o AS given_orders
       FROM (SELECT channel, s * o // 1500000 AS sales, r * o // 1500000 AS rets, o
             FROM (VALUES ('store', 2880404, 287514), ('catalog', 1441548, 144067), ('web', 719384, 71763))
                  AS v(channel, s, r), (SELECT count(*) AS o FROM orders) AS c) AS n""",
)
def _(spark, folder):
    # A ticket holds an item once, and every return has its sale.
    made = Tpcds(spark, scale_of(spark, folder))
    found = []
    for channel, prefix, back, number in (
        ("store", "ss_", "sr_", "ticket_number"),
        ("catalog", "cs_", "cr_", "order_number"),
        ("web", "ws_", "wr_", "order_number"),
    ):
        keys = [F.col(prefix + "item_sk").alias("item"), F.col(prefix + number).alias("number")]
        sold = made.table(f"{channel}_sales").select(*keys).groupBy("item", "number").agg(F.count("*").alias("n"))
        keys = [F.col(back + "item_sk").alias("item"), F.col(back + number).alias("number"), F.lit(1).alias("r")]
        returned = made.table(f"{channel}_returns").select(*keys)
        found.append(
            sold.join(returned, ["item", "number"], "full_outer").agg(
                F.sum("n").alias("sales"),
                F.count("n").alias("distinct_sales"),
                F.count("r").alias("returns"),
                F.count_if(F.col("n").isNotNull() & F.col("r").isNotNull()).alias("matched"),
            ).withColumn("channel", F.lit(channel))
        )
    return with_given_orders(spark, folder, reduce(DataFrame.unionByName, found))


@register(
    "gen_tpcds_calendar",
    "ts_date:s events:i d_year:i d_moy:i d_dom:i d_qoy:i d_dow:i d_month_seq:i first_dom:i last_dom:i",
    """SELECT CAST(ts AS DATE) AS ts_date, count(*) AS events, year(any_value(ts)) AS d_year,
              month(any_value(ts)) AS d_moy, day(any_value(ts)) AS d_dom, quarter(any_value(ts)) AS d_qoy,
              dayofweek(any_value(ts)) AS d_dow,
              (year(any_value(ts)) - 1900) * 12 + month(any_value(ts)) - 1 AS d_month_seq,
              2415022 + date_diff('day', DATE '1900-01-02', CAST(date_trunc('month', any_value(ts)) AS DATE)) AS first_dom,
              2415022 + date_diff('day', DATE '1900-01-02', last_day(CAST(any_value(ts) AS DATE))) AS last_dom
       FROM events GROUP BY CAST(ts AS DATE)""",
)
def _(spark, folder):
    # The generated calendar joined to the days of the given events.
    days = table(spark, folder, "events").groupBy(F.to_date("ts").alias("ts_date")).agg(F.count("*").alias("events"))
    calendar = Tpcds(spark, scale_of(spark, folder)).table("date_dim")
    return days.join(calendar, F.col("ts_date") == F.col("d_date")).select(
        "ts_date", "events", "d_year", "d_moy", "d_dom", "d_qoy", "d_dow", "d_month_seq",
        F.col("d_first_dom").alias("first_dom"), F.col("d_last_dom").alias("last_dom"),
    )


@register(
    "rowgroup_layout",
    "name:s idx:i rows:i total_bytes:i",
    f"""SELECT DISTINCT regexp_extract(file_name, '[^/]+$') AS name, row_group_id AS idx, row_group_num_rows AS rows,
               row_group_bytes AS total_bytes FROM parquet_metadata('{ORACLE_DIR}/*.parquet')""",
)
def _(spark, folder):
    return files.row_group_layout(files.list_parts(spark, folder)).withColumn("name", base_name())



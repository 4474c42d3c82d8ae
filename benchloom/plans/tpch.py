"""The 22 TPC-H queries as DataFrame plans over full-schema tables.

Each function takes ``t``, a dict of the eight tables, and the query's substitution parameters (defaults:
the validation values). Money is ``decimal(15,2)``, sums stay exact, averages and ratios are doubles.

Choices that matter at scale:

* nested queries are aggregations joined back, never row-wise subqueries; a one-row result is a scalar
  subquery, so there is no cross join;
* Q17 and Q21 read lineitem once: the nested predicate is answered from a small pre-aggregate
  (Q17: at most one row per part and quantity; Q21: one row per order);
* selective filters come before joins, and no side is broadcast by hint: Spark measures the sides.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Tables = dict[str, DataFrame]


def _revenue() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def _ratio(top: Column, bottom: Column) -> Column:
    return top.cast("double") / bottom.cast("double")


def _nations_of(t: Tables, region: str, *columns: str) -> DataFrame:
    regions = t["region"].where(F.col("r_name") == region)
    return t["nation"].join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(*columns)


def q1(t: Tables, until: date = date(1998, 9, 2)) -> DataFrame:
    return (
        t["lineitem"]
        .where(F.col("l_shipdate") <= F.lit(until))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_base_price"),
            F.sum(_revenue()).alias("sum_disc_price"),
            F.sum(_revenue() * (1 + F.col("l_tax"))).alias("sum_charge"),
            F.sum("l_discount").alias("_discount"),
            F.count("*").alias("count_order"),
        )
        .select(
            "l_returnflag",
            "l_linestatus",
            "sum_qty",
            "sum_base_price",
            "sum_disc_price",
            "sum_charge",
            _ratio(F.col("sum_qty"), F.col("count_order")).alias("avg_qty"),
            _ratio(F.col("sum_base_price"), F.col("count_order")).alias("avg_price"),
            _ratio(F.col("_discount"), F.col("count_order")).alias("avg_disc"),
            "count_order",
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def q2(t: Tables, size: int = 15, type_suffix: str = "BRASS", region: str = "EUROPE") -> DataFrame:
    parts = t["part"].where((F.col("p_size") == size) & F.col("p_type").endswith(type_suffix))
    suppliers = t["supplier"].join(
        _nations_of(t, region, "n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    offers = (
        t["partsupp"]
        .join(parts.select("p_partkey", "p_mfgr"), F.col("ps_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("ps_suppkey") == F.col("s_suppkey"))
    )
    # A part has four offers, so a window over its few is cheaper than a second read of all.
    cheapest = F.min("ps_supplycost").over(Window.partitionBy("p_partkey"))
    return (
        offers.withColumn("_least", cheapest)
        .where("ps_supplycost = _least")
        .select("s_acctbal", "s_name", "n_name", "p_partkey", "p_mfgr", "s_address", "s_phone", "s_comment")
        .orderBy(F.desc("s_acctbal"), "n_name", "s_name", "p_partkey")
        .limit(100)
    )


def q3(t: Tables, segment: str = "BUILDING", day: date = date(1995, 3, 15)) -> DataFrame:
    customers = t["customer"].where(F.col("c_mktsegment") == segment).select("c_custkey")
    orders = (
        t["orders"]
        .where(F.col("o_orderdate") < F.lit(day))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .select("o_orderkey", "o_orderdate", "o_shippriority")
    )
    lines = t["lineitem"].where(F.col("l_shipdate") > F.lit(day))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_orderdate", "o_shippriority")
        .agg(F.sum(_revenue()).alias("revenue"))
        .select("l_orderkey", "revenue", "o_orderdate", "o_shippriority")
        .orderBy(F.desc("revenue"), "o_orderdate", "l_orderkey")
        .limit(10)
    )


def q4(t: Tables, start: date = date(1993, 7, 1), end: date = date(1993, 10, 1)) -> DataFrame:
    late = t["lineitem"].where("l_commitdate < l_receiptdate").select("l_orderkey")
    return (
        t["orders"]
        .where((F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end)))
        .join(late, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("order_count"))
        .orderBy("o_orderpriority")
    )


def q5(t: Tables, region: str = "ASIA", start: date = date(1994, 1, 1), end: date = date(1995, 1, 1)) -> DataFrame:
    nations = _nations_of(t, region, "n_nationkey", "n_name")
    suppliers = t["supplier"].join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    orders = t["orders"].where((F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end)))
    orders = orders.join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    return (
        t["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .groupBy("n_name")
        .agg(F.sum(_revenue()).alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def q6(
    t: Tables,
    start: date = date(1994, 1, 1),
    end: date = date(1995, 1, 1),
    low: str = "0.05",
    high: str = "0.07",
    quantity: int = 24,
) -> DataFrame:
    discount = F.col("l_discount").between(F.lit(low).cast("decimal(15,2)"), F.lit(high).cast("decimal(15,2)"))
    return (
        t["lineitem"]
        .where((F.col("l_shipdate") >= F.lit(start)) & (F.col("l_shipdate") < F.lit(end)))
        .where(discount & (F.col("l_quantity") < quantity))
        .agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("revenue"))
    )


def q7(
    t: Tables,
    one: str = "FRANCE",
    other: str = "GERMANY",
    start: date = date(1995, 1, 1),
    end: date = date(1996, 12, 31),
) -> DataFrame:
    pair = t["nation"].where(F.col("n_name").isin(one, other))
    suppliers = t["supplier"].join(
        pair.select(F.col("n_nationkey").alias("sn"), F.col("n_name").alias("supp_nation")), F.col("s_nationkey") == F.col("sn")
    ).select("s_suppkey", "supp_nation")
    customers = t["customer"].join(
        pair.select(F.col("n_nationkey").alias("cn"), F.col("n_name").alias("cust_nation")), F.col("c_nationkey") == F.col("cn")
    ).select("c_custkey", "cust_nation")
    orders = t["orders"].join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "cust_nation")
    return (
        t["lineitem"]
        .where(F.col("l_shipdate").between(F.lit(start), F.lit(end)))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .where("supp_nation <> cust_nation")
        .groupBy("supp_nation", "cust_nation", F.year("l_shipdate").cast("bigint").alias("l_year"))
        .agg(F.sum(_revenue()).alias("revenue"))
        .orderBy("supp_nation", "cust_nation", "l_year")
    )


def q8(
    t: Tables,
    nation: str = "BRAZIL",
    region: str = "AMERICA",
    part_type: str = "ECONOMY ANODIZED STEEL",
    start: date = date(1995, 1, 1),
    end: date = date(1996, 12, 31),
) -> DataFrame:
    parts = t["part"].where(F.col("p_type") == part_type).select("p_partkey")
    customers = t["customer"].join(
        _nations_of(t, region, "n_nationkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    orders = (
        t["orders"]
        .where(F.col("o_orderdate").between(F.lit(start), F.lit(end)))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
        .select("o_orderkey", F.year("o_orderdate").cast("bigint").alias("o_year"))
    )
    suppliers = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    volume = _revenue()
    return (
        t["lineitem"]
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("o_year")
        .agg(F.sum(F.when(F.col("n_name") == nation, volume).otherwise(0)).alias("_one"), F.sum(volume).alias("_all"))
        .select("o_year", _ratio(F.col("_one"), F.col("_all")).alias("mkt_share"))
        .orderBy("o_year")
    )


def q9(t: Tables, word: str = "green") -> DataFrame:
    parts = t["part"].where(F.contains("p_name", F.lit(word))).select("p_partkey")
    # The part filter also cuts partsupp before it meets the lines.
    offers = t["partsupp"].join(parts, F.col("ps_partkey") == F.col("p_partkey"), "left_semi")
    suppliers = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    profit = _revenue() - F.col("ps_supplycost") * F.col("l_quantity")
    return (
        t["lineitem"]
        .join(offers, (F.col("l_partkey") == F.col("ps_partkey")) & (F.col("l_suppkey") == F.col("ps_suppkey")))
        .join(t["orders"].select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("n_name").alias("nation"), F.year("o_orderdate").cast("bigint").alias("o_year"))
        .agg(F.sum(profit).alias("sum_profit"))
        .orderBy("nation", F.desc("o_year"))
    )


def q10(t: Tables, start: date = date(1993, 10, 1), end: date = date(1994, 1, 1)) -> DataFrame:
    orders = t["orders"].where((F.col("o_orderdate") >= F.lit(start)) & (F.col("o_orderdate") < F.lit(end)))
    lost = (
        t["lineitem"]
        .where("l_returnflag = 'R'")
        .join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.sum(_revenue()).alias("revenue"))
    )
    # Revenue is summed per customer key first, so the wide customer columns join only the sums.
    return (
        lost.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name", "c_address", "c_phone", "c_comment")
        .orderBy(F.desc("revenue"), "c_custkey")
        .limit(20)
    )


def q11(t: Tables, nation: str = "GERMANY", fraction: str = "0.0001") -> DataFrame:
    nations = t["nation"].where(F.col("n_name") == nation)
    suppliers = t["supplier"].join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    value = (
        t["partsupp"]
        .join(suppliers, F.col("ps_suppkey") == F.col("s_suppkey"), "left_semi")
        .groupBy("ps_partkey")
        .agg(F.sum(F.col("ps_supplycost") * F.col("ps_availqty")).alias("value"))
    )
    total = value.agg(F.sum("value") * F.lit(fraction).cast("decimal(12,10)")).scalar()
    return value.where(F.col("value") > total).orderBy(F.desc("value"), "ps_partkey")


def q12(
    t: Tables,
    modes: tuple[str, str] = ("MAIL", "SHIP"),
    start: date = date(1994, 1, 1),
    end: date = date(1995, 1, 1),
) -> DataFrame:
    lines = (
        t["lineitem"]
        .where(F.col("l_shipmode").isin(*modes))
        .where("l_commitdate < l_receiptdate and l_shipdate < l_commitdate")
        .where((F.col("l_receiptdate") >= F.lit(start)) & (F.col("l_receiptdate") < F.lit(end)))
    )
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        t["orders"]
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy("l_shipmode")
        .agg(F.count_if(urgent).alias("high_line_count"), F.count_if(~urgent).alias("low_line_count"))
        .orderBy("l_shipmode")
    )


def q13(t: Tables, one: str = "special", other: str = "requests") -> DataFrame:
    orders = t["orders"].where(~F.col("o_comment").like(f"%{one}%{other}%"))
    # Orders are counted per customer key before they meet the customers.
    counts = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return (
        t["customer"]
        .join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
        .groupBy(F.coalesce("n", F.lit(0)).alias("c_count"))
        .agg(F.count("*").alias("custdist"))
        .orderBy(F.desc("custdist"), F.desc("c_count"))
    )


def q14(t: Tables, start: date = date(1995, 9, 1), end: date = date(1995, 10, 1)) -> DataFrame:
    lines = t["lineitem"].where((F.col("l_shipdate") >= F.lit(start)) & (F.col("l_shipdate") < F.lit(end)))
    promo = F.when(F.col("p_type").startswith("PROMO"), _revenue()).otherwise(0)
    return (
        lines.join(t["part"].select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .agg(F.sum(promo).alias("_promo"), F.sum(_revenue()).alias("_all"))
        .select((100 * _ratio(F.col("_promo"), F.col("_all"))).alias("promo_revenue"))
    )


def q15(t: Tables, start: date = date(1996, 1, 1), end: date = date(1996, 4, 1)) -> DataFrame:
    revenue = (
        t["lineitem"]
        .where((F.col("l_shipdate") >= F.lit(start)) & (F.col("l_shipdate") < F.lit(end)))
        .groupBy(F.col("l_suppkey").alias("supplier_no"))
        .agg(F.sum(_revenue()).alias("total_revenue"))
    )
    best = revenue.agg(F.max("total_revenue")).scalar()
    return (
        t["supplier"]
        .join(revenue.where(F.col("total_revenue") == best), F.col("s_suppkey") == F.col("supplier_no"))
        .select("s_suppkey", "s_name", "s_address", "s_phone", "total_revenue")
        .orderBy("s_suppkey")
    )


def q16(
    t: Tables,
    brand: str = "Brand#45",
    type_prefix: str = "MEDIUM POLISHED",
    sizes: tuple[int, ...] = (49, 14, 23, 45, 19, 3, 36, 9),
) -> DataFrame:
    parts = t["part"].where(
        (F.col("p_brand") != brand) & ~F.col("p_type").startswith(type_prefix) & F.col("p_size").isin(*sizes)
    )
    complained = t["supplier"].where(F.col("s_comment").like("%Customer%Complaints%")).select("s_suppkey")
    return (
        t["partsupp"]
        .join(parts.select("p_partkey", "p_brand", "p_type", "p_size"), F.col("ps_partkey") == F.col("p_partkey"))
        .join(complained, F.col("ps_suppkey") == F.col("s_suppkey"), "left_anti")
        .groupBy("p_brand", "p_type", "p_size")
        .agg(F.count_distinct("ps_suppkey").alias("supplier_cnt"))
        .orderBy(F.desc("supplier_cnt"), "p_brand", "p_type", "p_size")
    )


def q17(t: Tables, brand: str = "Brand#23", container: str = "MED BOX") -> DataFrame:
    parts = t["part"].where((F.col("p_brand") == brand) & (F.col("p_container") == container)).select("p_partkey")
    # Only quantity decides, so one row per (part, quantity) carries all there is to know about a part.
    per_quantity = (
        t["lineitem"]
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .groupBy("l_partkey", "l_quantity")
        .agg(F.count("*").alias("n"), F.sum("l_extendedprice").alias("price"))
    )
    part = Window.partitionBy("l_partkey")
    total, lines = F.sum(F.col("l_quantity") * F.col("n")).over(part), F.sum("n").over(part)
    return (
        per_quantity.withColumn("_total", total)
        .withColumn("_lines", lines)
        # quantity < 0.2 * average, without a division
        .where(5 * F.col("l_quantity") * F.col("_lines") < F.col("_total"))
        .agg(_ratio(F.sum("price"), F.lit(7)).alias("avg_yearly"))
    )


def q18(t: Tables, quantity: int = 300) -> DataFrame:
    large = (
        t["lineitem"]
        .groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("sum_qty"))
        .where(F.col("sum_qty") > quantity)
    )
    # The sum per order is the result column itself, so the lines are not joined a second time.
    return (
        t["orders"]
        .join(large, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t["customer"].select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "sum_qty")
        .orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey")
        .limit(100)
    )


# The three container families and part size limits of Q19.
Q19_FAMILIES = (
    (("SM CASE", "SM BOX", "SM PACK", "SM PKG"), 5),
    (("MED BAG", "MED BOX", "MED PKG", "MED PACK"), 10),
    (("LG CASE", "LG BOX", "LG PACK", "LG PKG"), 15),
)


def q19(
    t: Tables,
    brands: tuple[str, str, str] = ("Brand#12", "Brand#23", "Brand#34"),
    quantities: tuple[int, int, int] = (1, 10, 20),
) -> DataFrame:
    # The part side of each branch is decided on part alone; the lines then need an equi-join only.
    low = F.lit(None).cast("int")
    for brand, least, (containers, size) in zip(brands, quantities, Q19_FAMILIES):
        fits = (
            (F.col("p_brand") == brand) & F.col("p_container").isin(*containers) & F.col("p_size").between(1, size)
        )
        low = F.when(fits, F.lit(least)).otherwise(low)
    parts = t["part"].withColumn("_low", low).where("_low is not null").select("p_partkey", "_low")
    lines = t["lineitem"].where(
        F.col("l_shipmode").isin("AIR", "REG AIR") & (F.col("l_shipinstruct") == "DELIVER IN PERSON")
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .where("l_quantity between _low and _low + 10")
        .agg(F.sum(_revenue()).alias("revenue"))
    )


def q20(
    t: Tables,
    word: str = "forest",
    start: date = date(1994, 1, 1),
    end: date = date(1995, 1, 1),
    nation: str = "CANADA",
) -> DataFrame:
    parts = t["part"].where(F.col("p_name").startswith(word)).select("p_partkey")
    offers = t["partsupp"].join(parts, F.col("ps_partkey") == F.col("p_partkey"), "left_semi")
    shipped = (
        t["lineitem"]
        .where((F.col("l_shipdate") >= F.lit(start)) & (F.col("l_shipdate") < F.lit(end)))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.sum("l_quantity").alias("_shipped"))
    )
    surplus = offers.join(
        shipped, (F.col("ps_partkey") == F.col("l_partkey")) & (F.col("ps_suppkey") == F.col("l_suppkey"))
    ).where("2 * ps_availqty > _shipped")
    nations = t["nation"].where(F.col("n_name") == nation)
    return (
        t["supplier"]
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
        .join(surplus.select("ps_suppkey"), F.col("s_suppkey") == F.col("ps_suppkey"), "left_semi")
        .select("s_name", "s_address")
        .orderBy("s_name")
    )


def q21(t: Tables, nation: str = "SAUDI ARABIA") -> DataFrame:
    late = F.col("l_receiptdate") > F.col("l_commitdate")
    # "Another supplier took part" and "no other supplier was late" follow from the smallest and largest
    # supplier key per order, over all lines and over the late ones: one pass instead of two self-joins.
    per_order = (
        t["lineitem"]
        .groupBy("l_orderkey")
        .agg(
            F.min("l_suppkey").alias("_low"),
            F.max("l_suppkey").alias("_high"),
            F.min(F.when(late, F.col("l_suppkey"))).alias("_late_low"),
            F.max(F.when(late, F.col("l_suppkey"))).alias("_late_high"),
            F.count_if(late).alias("_late_lines"),
        )
        .where("_low <> _high and _late_low = _late_high")
    )
    failed = t["orders"].where("o_orderstatus = 'F'").select("o_orderkey")
    nations = t["nation"].where(F.col("n_name") == nation)
    suppliers = t["supplier"].join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    return (
        per_order.join(suppliers.select("s_suppkey", "s_name"), F.col("_late_low") == F.col("s_suppkey"))
        .join(failed, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .groupBy("s_name")
        .agg(F.sum("_late_lines").alias("numwait"))
        .orderBy(F.desc("numwait"), "s_name")
        .limit(100)
    )


def q22(
    t: Tables,
    codes: tuple[str, ...] = ("13", "31", "23", "29", "30", "18", "17"),
    since: date = date(1900, 1, 1),
) -> DataFrame:
    orders = t["orders"].where(F.col("o_orderdate") >= F.lit(since))
    candidates = (
        t["customer"]
        .withColumn("cntrycode", F.substring("c_phone", 1, 2))
        .where(F.col("cntrycode").isin(*codes))
        .select("c_custkey", "cntrycode", "c_acctbal")
    )
    # Compare n * balance with the sum, so that no rounded average is involved.
    positive = candidates.where("c_acctbal > 0").agg(F.sum("c_acctbal").alias("s"), F.count("*").alias("n"))
    average_sum, average_n = positive.select("s").scalar(), positive.select("n").scalar()
    return (
        candidates.where(F.col("c_acctbal") * average_n > average_sum)
        .join(orders.select("o_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")
        .groupBy("cntrycode")
        .agg(F.count("*").alias("numcust"), F.sum("c_acctbal").alias("totacctbal"))
        .orderBy("cntrycode")
    )


TPCH_QUERIES = {f.__name__: f for f in (
    q1, q2, q3, q4, q5, q6, q7, q8, q9, q10, q11, q12, q13, q14, q15, q16, q17, q18, q19, q20, q21, q22,
)}

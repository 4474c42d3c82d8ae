"""The acceptance workload: the 22 queries over the given tables, completed to the full schema."""

from __future__ import annotations

from datetime import date

from benchloom.catalogue.base import register
from benchloom.plans.completion import DERIVED, PARTSUPP, complete_tables
from benchloom.plans.tpch import TPCH_QUERIES
from benchloom.schemas import benchmark


def _sql_table(name: str) -> str:
    cast = {"D": "CAST({0} AS DATE)", "D15_2": "CAST({0} AS DECIMAL(15,2))"}
    picked = []
    for column, kind in benchmark("tpch")[name]:
        derived = DERIVED[name].get(column)
        value = derived.replace(" div ", " // ") if derived else cast.get(kind, "{0}").format(column)
        picked.append(f"{value} AS {column}")
    return f"x_{name} AS (SELECT {', '.join(picked)} FROM {name})"


def completed_sql() -> str:
    """The eight completed tables as common table expressions named ``x_<table>``."""
    tables = [_sql_table(name) for name in benchmark("tpch") if name != "partsupp"]
    offers = ", ".join(f"{sql.replace(' div ', ' // ')} AS {c}" for c, sql in PARTSUPP.items())
    tables.append(
        f"x_partsupp AS (SELECT {offers} FROM part, (SELECT count(*) AS suppliers FROM supplier) AS c, "
        "(SELECT unnest([0, 1, 2, 3]) AS i) AS n)"
    )
    return "WITH " + ",\n".join(tables)


# Parameters that fit the given data (dates 1995 to 2001, nations NATION_<i>, one-word part types).
PARAMETERS: dict[str, dict] = {
    "q1": {"until": date(2001, 8, 1)},
    "q2": {"size": 15, "type_suffix": "ECONOMY", "region": "EUROPE"},
    "q3": {"segment": "BUILDING", "day": date(1998, 3, 15)},
    "q4": {"start": date(1998, 7, 1), "end": date(1998, 10, 1)},
    "q5": {"region": "ASIA", "start": date(1997, 1, 1), "end": date(1998, 1, 1)},
    "q6": {"start": date(1997, 1, 1), "end": date(1998, 1, 1)},
    "q7": {"one": "NATION_6", "other": "NATION_7", "start": date(1996, 1, 1), "end": date(1999, 12, 31)},
    "q8": {
        "nation": "NATION_1",
        "region": "AMERICA",
        "part_type": "ECONOMY",
        "start": date(1996, 1, 1),
        "end": date(1999, 12, 31),
    },
    "q9": {"word": "red"},
    "q10": {"start": date(1997, 10, 1), "end": date(1998, 1, 1)},
    "q11": {"nation": "NATION_7", "fraction": "0.001"},
    "q12": {"modes": ("MAIL", "SHIP"), "start": date(1997, 1, 1), "end": date(1998, 1, 1)},
    "q13": {},
    "q14": {"start": date(1997, 9, 1), "end": date(1997, 10, 1)},
    "q15": {"start": date(1997, 1, 1), "end": date(1997, 4, 1)},
    "q16": {"brand": "Brand#5", "type_prefix": "MEDIUM"},
    "q17": {"brand": "Brand#3", "container": "MED BOX"},
    "q18": {"quantity": 300},
    "q19": {"brands": ("Brand#1", "Brand#2", "Brand#3")},
    "q20": {"word": "red", "start": date(1997, 1, 1), "end": date(1998, 1, 1), "nation": "NATION_9"},
    "q21": {"nation": "NATION_20"},
    "q22": {"since": date(2001, 7, 1)},
}

COLUMNS = {
    "q1": "l_returnflag:s l_linestatus:s sum_qty:d sum_base_price:d sum_disc_price:d sum_charge:d avg_qty:d "
    "avg_price:d avg_disc:d count_order:i",
    "q2": "s_acctbal:d s_name:s n_name:s p_partkey:i p_mfgr:s s_address:s s_phone:s s_comment:s",
    "q3": "l_orderkey:i revenue:d o_orderdate:s o_shippriority:i",
    "q4": "o_orderpriority:s order_count:i",
    "q5": "n_name:s revenue:d",
    "q6": "revenue:d",
    "q7": "supp_nation:s cust_nation:s l_year:i revenue:d",
    "q8": "o_year:i mkt_share:d",
    "q9": "nation:s o_year:i sum_profit:d",
    "q10": "c_custkey:i c_name:s revenue:d c_acctbal:d n_name:s c_address:s c_phone:s c_comment:s",
    "q11": "ps_partkey:i value:d",
    "q12": "l_shipmode:s high_line_count:i low_line_count:i",
    "q13": "c_count:i custdist:i",
    "q14": "promo_revenue:d",
    "q15": "s_suppkey:i s_name:s s_address:s s_phone:s total_revenue:d",
    "q16": "p_brand:s p_type:s p_size:i supplier_cnt:i",
    "q17": "avg_yearly:d",
    "q18": "c_name:s c_custkey:i o_orderkey:i o_orderdate:s o_totalprice:d sum_qty:d",
    "q19": "revenue:d",
    "q20": "s_name:s s_address:s",
    "q21": "s_name:s numwait:i",
    "q22": "cntrycode:s numcust:i totacctbal:d",
}

# The public query texts, with the parameters above.
SQL = {
    "q1": """
        SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_base_price,
               sum(l_extendedprice * (1 - l_discount)) AS sum_disc_price,
               sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS sum_charge,
               CAST(sum(l_quantity) AS DOUBLE) / count(*) AS avg_qty,
               CAST(sum(l_extendedprice) AS DOUBLE) / count(*) AS avg_price,
               CAST(sum(l_discount) AS DOUBLE) / count(*) AS avg_disc, count(*) AS count_order
        FROM x_lineitem WHERE l_shipdate <= DATE '2001-08-01' GROUP BY l_returnflag, l_linestatus""",
    "q2": """
        SELECT s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment
        FROM x_part, x_supplier, x_partsupp, x_nation, x_region
        WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey AND p_size = 15 AND p_type LIKE '%ECONOMY'
          AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name = 'EUROPE'
          AND ps_supplycost = (SELECT min(ps_supplycost) FROM x_partsupp, x_supplier, x_nation, x_region
                               WHERE p_partkey = ps_partkey AND s_suppkey = ps_suppkey
                                 AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND r_name = 'EUROPE')
        ORDER BY s_acctbal DESC, n_name, s_name, p_partkey LIMIT 100""",
    "q3": """
        SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS revenue, o_orderdate, o_shippriority
        FROM x_customer, x_orders, x_lineitem
        WHERE c_mktsegment = 'BUILDING' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
          AND o_orderdate < DATE '1998-03-15' AND l_shipdate > DATE '1998-03-15'
        GROUP BY l_orderkey, o_orderdate, o_shippriority
        ORDER BY revenue DESC, o_orderdate, l_orderkey LIMIT 10""",
    "q4": """
        SELECT o_orderpriority, count(*) AS order_count FROM x_orders
        WHERE o_orderdate >= DATE '1998-07-01' AND o_orderdate < DATE '1998-10-01'
          AND EXISTS (SELECT * FROM x_lineitem WHERE l_orderkey = o_orderkey AND l_commitdate < l_receiptdate)
        GROUP BY o_orderpriority""",
    "q5": """
        SELECT n_name, sum(l_extendedprice * (1 - l_discount)) AS revenue
        FROM x_customer, x_orders, x_lineitem, x_supplier, x_nation, x_region
        WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
          AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
          AND r_name = 'ASIA' AND o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1998-01-01'
        GROUP BY n_name""",
    "q6": """
        SELECT sum(l_extendedprice * l_discount) AS revenue FROM x_lineitem
        WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01'
          AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""",
    "q7": """
        SELECT supp_nation, cust_nation, l_year, sum(volume) AS revenue
        FROM (SELECT n1.n_name AS supp_nation, n2.n_name AS cust_nation, year(l_shipdate) AS l_year,
                     l_extendedprice * (1 - l_discount) AS volume
              FROM x_supplier, x_lineitem, x_orders, x_customer, x_nation n1, x_nation n2
              WHERE s_suppkey = l_suppkey AND o_orderkey = l_orderkey AND c_custkey = o_custkey
                AND s_nationkey = n1.n_nationkey AND c_nationkey = n2.n_nationkey
                AND ((n1.n_name = 'NATION_6' AND n2.n_name = 'NATION_7')
                  OR (n1.n_name = 'NATION_7' AND n2.n_name = 'NATION_6'))
                AND l_shipdate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31') AS shipping
        GROUP BY supp_nation, cust_nation, l_year""",
    "q8": """
        SELECT o_year, CAST(sum(CASE WHEN nation = 'NATION_1' THEN volume ELSE 0 END) AS DOUBLE)
                       / CAST(sum(volume) AS DOUBLE) AS mkt_share
        FROM (SELECT year(o_orderdate) AS o_year, l_extendedprice * (1 - l_discount) AS volume, n2.n_name AS nation
              FROM x_part, x_supplier, x_lineitem, x_orders, x_customer, x_nation n1, x_nation n2, x_region
              WHERE p_partkey = l_partkey AND s_suppkey = l_suppkey AND l_orderkey = o_orderkey
                AND o_custkey = c_custkey AND c_nationkey = n1.n_nationkey AND n1.n_regionkey = r_regionkey
                AND r_name = 'AMERICA' AND s_nationkey = n2.n_nationkey
                AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' AND p_type = 'ECONOMY') AS all_nations
        GROUP BY o_year""",
    "q9": """
        SELECT nation, o_year, sum(amount) AS sum_profit
        FROM (SELECT n_name AS nation, year(o_orderdate) AS o_year,
                     l_extendedprice * (1 - l_discount) - ps_supplycost * l_quantity AS amount
              FROM x_part, x_supplier, x_lineitem, x_partsupp, x_orders, x_nation
              WHERE s_suppkey = l_suppkey AND ps_suppkey = l_suppkey AND ps_partkey = l_partkey
                AND p_partkey = l_partkey AND o_orderkey = l_orderkey AND s_nationkey = n_nationkey
                AND p_name LIKE '%red%') AS profit
        GROUP BY nation, o_year""",
    "q10": """
        SELECT c_custkey, c_name, sum(l_extendedprice * (1 - l_discount)) AS revenue, c_acctbal, n_name, c_address,
               c_phone, c_comment
        FROM x_customer, x_orders, x_lineitem, x_nation
        WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND o_orderdate >= DATE '1997-10-01'
          AND o_orderdate < DATE '1998-01-01' AND l_returnflag = 'R' AND c_nationkey = n_nationkey
        GROUP BY c_custkey, c_name, c_acctbal, c_phone, n_name, c_address, c_comment
        ORDER BY revenue DESC, c_custkey LIMIT 20""",
    "q11": """
        SELECT ps_partkey, sum(ps_supplycost * ps_availqty) AS value FROM x_partsupp, x_supplier, x_nation
        WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7'
        GROUP BY ps_partkey
        HAVING sum(ps_supplycost * ps_availqty) >
               (SELECT sum(ps_supplycost * ps_availqty) * 0.001 FROM x_partsupp, x_supplier, x_nation
                WHERE ps_suppkey = s_suppkey AND s_nationkey = n_nationkey AND n_name = 'NATION_7')""",
    "q12": """
        SELECT l_shipmode,
               sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS high_line_count,
               sum(CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS low_line_count
        FROM x_orders, x_lineitem
        WHERE o_orderkey = l_orderkey AND l_shipmode IN ('MAIL', 'SHIP') AND l_commitdate < l_receiptdate
          AND l_shipdate < l_commitdate AND l_receiptdate >= DATE '1997-01-01' AND l_receiptdate < DATE '1998-01-01'
        GROUP BY l_shipmode""",
    "q13": """
        SELECT c_count, count(*) AS custdist
        FROM (SELECT c_custkey, count(o_orderkey) AS c_count
              FROM x_customer LEFT JOIN x_orders
                ON c_custkey = o_custkey AND o_comment NOT LIKE '%special%requests%'
              GROUP BY c_custkey) AS c_orders
        GROUP BY c_count""",
    "q14": """
        SELECT 100 * (CAST(sum(CASE WHEN p_type LIKE 'PROMO%' THEN l_extendedprice * (1 - l_discount) ELSE 0 END)
                           AS DOUBLE) / CAST(sum(l_extendedprice * (1 - l_discount)) AS DOUBLE)) AS promo_revenue
        FROM x_lineitem, x_part
        WHERE l_partkey = p_partkey AND l_shipdate >= DATE '1997-09-01' AND l_shipdate < DATE '1997-10-01'""",
    "q15": """
        SELECT s_suppkey, s_name, s_address, s_phone, total_revenue
        FROM x_supplier, (SELECT l_suppkey AS supplier_no, sum(l_extendedprice * (1 - l_discount)) AS total_revenue
                          FROM x_lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-04-01'
                          GROUP BY l_suppkey) AS revenue
        WHERE s_suppkey = supplier_no
          AND total_revenue = (SELECT max(r) FROM (SELECT sum(l_extendedprice * (1 - l_discount)) AS r
                               FROM x_lineitem WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-04-01'
                               GROUP BY l_suppkey) AS m)""",
    "q16": """
        SELECT p_brand, p_type, p_size, count(DISTINCT ps_suppkey) AS supplier_cnt FROM x_partsupp, x_part
        WHERE p_partkey = ps_partkey AND p_brand <> 'Brand#5' AND p_type NOT LIKE 'MEDIUM%'
          AND p_size IN (49, 14, 23, 45, 19, 3, 36, 9)
          AND ps_suppkey NOT IN (SELECT s_suppkey FROM x_supplier WHERE s_comment LIKE '%Customer%Complaints%')
        GROUP BY p_brand, p_type, p_size""",
    "q17": """
        SELECT CAST(sum(l_extendedprice) AS DOUBLE) / 7 AS avg_yearly FROM x_lineitem, x_part
        WHERE p_partkey = l_partkey AND p_brand = 'Brand#3' AND p_container = 'MED BOX'
          AND l_quantity * 5 < (SELECT avg(l_quantity) FROM x_lineitem WHERE l_partkey = p_partkey)""",
    "q18": """
        SELECT c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, sum(l_quantity) AS sum_qty
        FROM x_customer, x_orders, x_lineitem
        WHERE o_orderkey IN (SELECT l_orderkey FROM x_lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 300)
          AND c_custkey = o_custkey AND o_orderkey = l_orderkey
        GROUP BY c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice
        ORDER BY o_totalprice DESC, o_orderdate, o_orderkey LIMIT 100""",
    "q19": """
        SELECT sum(l_extendedprice * (1 - l_discount)) AS revenue FROM x_lineitem, x_part
        WHERE p_partkey = l_partkey AND l_shipmode IN ('AIR', 'REG AIR') AND l_shipinstruct = 'DELIVER IN PERSON'
          AND ((p_brand = 'Brand#1' AND p_container IN ('SM CASE', 'SM BOX', 'SM PACK', 'SM PKG')
                AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 5)
            OR (p_brand = 'Brand#2' AND p_container IN ('MED BAG', 'MED BOX', 'MED PKG', 'MED PACK')
                AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 10)
            OR (p_brand = 'Brand#3' AND p_container IN ('LG CASE', 'LG BOX', 'LG PACK', 'LG PKG')
                AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 15))""",
    "q20": """
        SELECT s_name, s_address FROM x_supplier, x_nation
        WHERE s_suppkey IN (SELECT ps_suppkey FROM x_partsupp
                            WHERE ps_partkey IN (SELECT p_partkey FROM x_part WHERE p_name LIKE 'red%')
                              AND ps_availqty * 2 > (SELECT sum(l_quantity) FROM x_lineitem
                                                     WHERE l_partkey = ps_partkey AND l_suppkey = ps_suppkey
                                                       AND l_shipdate >= DATE '1997-01-01'
                                                       AND l_shipdate < DATE '1998-01-01'))
          AND s_nationkey = n_nationkey AND n_name = 'NATION_9'""",
    "q21": """
        SELECT s_name, count(*) AS numwait FROM x_supplier, x_lineitem l1, x_orders, x_nation
        WHERE s_suppkey = l1.l_suppkey AND o_orderkey = l1.l_orderkey AND o_orderstatus = 'F'
          AND l1.l_receiptdate > l1.l_commitdate
          AND EXISTS (SELECT * FROM x_lineitem l2
                      WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
          AND NOT EXISTS (SELECT * FROM x_lineitem l3
                          WHERE l3.l_orderkey = l1.l_orderkey AND l3.l_suppkey <> l1.l_suppkey
                            AND l3.l_receiptdate > l3.l_commitdate)
          AND s_nationkey = n_nationkey AND n_name = 'NATION_20'
        GROUP BY s_name ORDER BY numwait DESC, s_name LIMIT 100""",
    "q22": """
        SELECT cntrycode, count(*) AS numcust, sum(c_acctbal) AS totacctbal
        FROM (SELECT substring(c_phone, 1, 2) AS cntrycode, c_acctbal FROM x_customer
              WHERE substring(c_phone, 1, 2) IN ('13', '31', '23', '29', '30', '18', '17')
                AND c_acctbal > (SELECT avg(c_acctbal) FROM x_customer
                                 WHERE c_acctbal > 0.00
                                   AND substring(c_phone, 1, 2) IN ('13', '31', '23', '29', '30', '18', '17'))
                AND NOT EXISTS (SELECT * FROM x_orders
                                WHERE o_custkey = c_custkey AND o_orderdate >= DATE '2001-07-01')) AS custsale
        GROUP BY cntrycode""",
}


def _add(name: str) -> None:
    @register(f"tpch_{name}", COLUMNS[name], completed_sql() + SQL[name])
    def build(spark, folder):
        return TPCH_QUERIES[name](complete_tables(spark, folder), **PARAMETERS[name])


for _name in TPCH_QUERIES:
    _add(_name)

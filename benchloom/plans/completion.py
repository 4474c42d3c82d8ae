"""Full-schema TPC-H tables from tables that hold only part of the columns.

Given tables keep their values, cast to the benchmark types. Missing columns, and partsupp, follow from the
key columns by plain integer arithmetic, so that any SQL engine can state the same rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.schemas import benchmark, spark_type

# Words that derived columns take, indexed from 1.
CONTAINER_SIZES = "SM,LG,MED,JUMBO,WRAP"
CONTAINER_KINDS = "CASE,BOX,BAG,JAR,PKG,PACK,CAN,DRUM"
SHIP_MODES = "REG AIR,AIR,RAIL,SHIP,TRUCK,MAIL,FOB"
SHIP_INSTRUCTIONS = "DELIVER IN PERSON,COLLECT COD,NONE,TAKE BACK RETURN"


def pick(words: str, number: str) -> str:
    return f"split_part('{words}', ',', cast({number} % {words.count(',') + 1} as int) + 1)"


# SQL text per missing column; ``div`` is integer division.
DERIVED = {
    "region": {"r_comment": "concat('region ', r_regionkey)"},
    "nation": {"n_comment": "concat('nation ', n_nationkey)"},
    "supplier": {
        "s_address": "concat('Dock ', s_suppkey * 7 % 1000)",
        "s_phone": "concat(10 + s_nationkey, '-', 100 + s_suppkey % 900, '-', 1000 + s_suppkey * 13 % 9000)",
        "s_comment": "case when s_suppkey % 20 = 3 then 'the Customer filed Complaints' else 'reliable' end",
    },
    "customer": {
        "c_address": "concat('Street ', c_custkey * 11 % 10000)",
        "c_phone": "concat(10 + c_nationkey, '-', 100 + c_custkey % 900, '-', 1000 + c_custkey * 17 % 9000)",
        "c_comment": "concat('account ', c_custkey % 97)",
    },
    "part": {
        "p_mfgr": "concat('Manufacturer#', 1 + p_partkey % 5)",
        "p_container": f"concat({pick(CONTAINER_SIZES, 'p_partkey * 3')}, ' ', "
        f"{pick(CONTAINER_KINDS, '(p_partkey div 5)')})",
        "p_comment": "concat('part ', p_partkey % 101)",
    },
    "orders": {
        "o_clerk": "concat('Clerk#', 1 + o_orderkey * 31 % 1000)",
        "o_shippriority": "cast(0 as int)",
        "o_comment": "case when o_orderkey % 41 = 5 then 'with special wrapping requests' else 'plain' end",
    },
    "lineitem": {
        "l_commitdate": "cast(l_shipdate as date) + cast((l_orderkey * 3 + l_linenumber * 7) % 61 - 30 as int)",
        "l_receiptdate": "cast(l_shipdate as date) + cast(1 + (l_partkey + l_linenumber) % 30 as int)",
        "l_shipinstruct": pick(SHIP_INSTRUCTIONS, "(l_orderkey + l_linenumber)"),
        "l_shipmode": pick(SHIP_MODES, "(l_partkey + l_suppkey)"),
        "l_comment": "concat('line ', l_orderkey % 89)",
    },
}
PARTSUPP = {
    "ps_partkey": "p_partkey",
    "ps_suppkey": "(p_partkey + i * (suppliers div 4 + p_partkey div suppliers)) % suppliers",
    "ps_availqty": "1 + (p_partkey * 31 + i * 977) % 9999",
    "ps_supplycost": "cast((100 + (p_partkey * 7919 + i * 104729) % 99900) / 100.0 as decimal(15,2))",
    "ps_comment": "concat('offer ', i)",
}


def read_given(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}


def complete_table(name: str, given: DataFrame) -> DataFrame:
    """The table in benchmark column order; given integer widths are kept."""
    columns = []
    for column, kind in benchmark("tpch")[name]:
        if column not in given.columns:
            columns.append(F.expr(DERIVED[name][column]).alias(column))
        elif kind in ("I", "L", "S"):
            columns.append(F.col(column))
        else:
            columns.append(F.col(column).cast(spark_type(kind)).alias(column))
    return given.select(*columns)


def derive_partsupp(part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Four offers per part; the number of suppliers is a scalar subquery over the supplier table."""
    suppliers = supplier.agg(F.count("*")).scalar()
    offers = part.select("p_partkey", F.explode(F.array(*map(F.lit, range(4)))).alias("i"))
    return offers.withColumn("suppliers", suppliers).selectExpr(*[f"{sql} as {c}" for c, sql in PARTSUPP.items()])


def complete_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = [name for name in benchmark("tpch") if name != "partsupp"]
    given = read_given(spark, folder, *names)
    tables = {name: complete_table(name, df) for name, df in given.items()}
    tables["partsupp"] = derive_partsupp(given["part"], given["supplier"])
    return tables

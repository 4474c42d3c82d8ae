"""Exact sets of whole-number keys as bitmaps, which merge: duplicate and missing primary keys, and keys without a parent.

A set is rows ``(key, bucket, rows, bits)``: 32,768 neighbouring values to a bucket of 4 KB. Values stay in their tasks and
only buckets travel, one for each task that meets some of its values, however often a value stands there. That suits keys
that lie roughly in their order in the files, as those of generated or sorted tables do. Keys that lie anywhere would
make each task send every bucket; ``scattered`` first combines equal values and deals them by range.

Any whole number is told apart, negative ones too. Nulls are counted under no bucket. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.operators import conform
from benchloom.session import constant_rows, ensure_checkpoint_dir

# Primary keys of the TPC-H schema that are, or pack into, one number; an order has at most seven lines.
TPCH_KEYS = {
    "region": {"r_regionkey": "r_regionkey"},
    "nation": {"n_nationkey": "n_nationkey"},
    "supplier": {"s_suppkey": "s_suppkey"},
    "customer": {"c_custkey": "c_custkey"},
    "part": {"p_partkey": "p_partkey"},
    "orders": {"o_orderkey": "o_orderkey"},
    "lineitem": {"l_orderkey,l_linenumber": "l_orderkey * 8 + l_linenumber", "l_orderkey": "l_orderkey"},
    "partsupp": {"ps_partkey": "ps_partkey"},
}
# Foreign keys whose table is written in their order.
TPCH_ORDERED_LINKS = (("partsupp", "ps_partkey", "part", "p_partkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"))


def key_set(df: DataFrame, keys: Mapping[str, str], scattered: bool = False) -> DataFrame:
    """The sets of several keys of a table, each a name and an expression, in one pass over it."""
    stacked = ", ".join(f"'{name}', cast({expr} as bigint)" for name, expr in keys.items())
    values = df.selectExpr(f"stack({len(keys)}, {stacked}) as (key, value)")
    if scattered:
        values = values.groupBy("key", "value").agg(F.count("*").alias("n")).repartitionByRange("key", "value")
    else:
        values = values.withColumn("n", F.lit(1).cast("bigint"))
    return values.groupBy("key", F.bitmap_bucket_number("value").alias("bucket")).agg(
        F.sum("n").alias("rows"), F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
    )


def table_key_sets(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Mapping[str, str]], scattered: bool = False
) -> DataFrame:
    """The sets of all keys of several tables: ``(table, key, bucket, rows, bits)``."""
    sets = [key_set(tables[name], keys[name], scattered).withColumn("table", F.lit(name)) for name in keys]
    return reduce(DataFrame.unionByName, sets).select("table", "key", "bucket", "rows", "bits")


def key_facts(sets: DataFrame) -> DataFrame:
    """``(table, key, rows, null_rows, distinct_keys, duplicate_rows)``: duplicates are rows beyond the first of a value."""
    placed = F.col("bucket").isNotNull()
    return (
        sets.groupBy("table", "key")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum(F.when(placed, 0).otherwise(F.col("rows"))).alias("null_rows"),
            F.sum(F.when(placed, F.bitmap_count("bits")).otherwise(0)).alias("distinct_keys"),
        )
        .withColumn("duplicate_rows", F.expr("rows - null_rows - distinct_keys"))
    )


def orphan_keys(sets: DataFrame, links: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Different values of each child key that its parent key lacks: ``(child, child_column, parent, orphan_keys)``.

    Both sides are merged by bucket, without a join: what is in either and not in the parent's is an orphan.
    """
    sides = [
        (number, table, key, is_parent)
        for number, (child, column, parent, parent_key) in enumerate(links)
        for table, key, is_parent in ((child, column, False), (parent, parent_key, True))
    ]
    spark = sets.sparkSession
    side = constant_rows(spark, "link int, table string, key string, is_parent boolean", sides)
    merged = (
        sets.where("bucket is not null")
        .join(F.broadcast(side), ["table", "key"])  # two rows for each link
        .groupBy("link", "bucket")
        .agg(F.expr("bitmap_or_agg(bits)").alias("either"), F.expr("bitmap_or_agg(bits) filter (where is_parent)").alias("known"))
        .groupBy("link")
        .agg(F.sum(F.bitmap_count("either") - F.bitmap_count("known")).alias("orphan_keys"))
    )
    named = constant_rows(
        spark, "link int, child string, child_column string, parent string", [(i, *link[:3]) for i, link in enumerate(links)]
    )
    return named.join(merged, "link", "left").select(
        "child", "child_column", "parent", F.coalesce("orphan_keys", F.lit(0)).alias("orphan_keys")
    )


def tpch_key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Repeated and null primary keys, and foreign keys without a parent, of a TPC-H dataset.

    Keys that lie in order go through bitmaps, one pass over each table. Foreign keys that lie anywhere, and the pairs
    of partsupp, which pack into no short range, are combined by value. With fewer than 80 suppliers (scale 0.008) the
    rule that deals suppliers to parts repeats pairs by itself, and they are reported.
    """
    if absent := set(TPCH_KEYS) - set(tables):
        raise ValueError(f"tables are not given: {', '.join(sorted(absent))}")
    spark = tables["orders"].sparkSession
    ensure_checkpoint_dir(spark)
    # Looked at twice; it has one bit for each number of a key's range.
    sets = table_key_sets(tables, TPCH_KEYS).checkpoint()
    foreign = constant_rows(spark, "table string, key string", [link[:2] for link in TPCH_ORDERED_LINKS])
    facts = key_facts(sets).join(F.broadcast(foreign), ["table", "key"], "left_anti")
    pairs = tables["partsupp"].groupBy("ps_partkey", "ps_suppkey").agg(F.count("*").alias("n"))
    repeated = pairs.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).where("n > 0")
    others = [link for link in conform.TPCH_FOREIGN_KEYS if link not in TPCH_ORDERED_LINKS]
    orphans = orphan_keys(sets, TPCH_ORDERED_LINKS).unionByName(conform.fk_orphans(dict(tables), others).drop("orphan_rows"))
    lone = orphans.where("orphan_keys > 0")
    doubled, empty = facts.where("duplicate_rows > 0"), facts.where("null_rows > 0")
    found = [
        conform.violation(doubled, "duplicate_key", F.col("table"), F.col("key"), 0, F.col("duplicate_rows")),
        conform.violation(empty, "null_key", F.col("table"), F.col("key"), 0, F.col("null_rows")),
        conform.violation(repeated, "duplicate_key", "partsupp", "ps_partkey,ps_suppkey", 0, F.col("n")),
        conform.violation(lone, "orphan_key", F.col("child"), F.col("child_column"), 0, F.col("orphan_keys")),
    ]
    return reduce(DataFrame.unionByName, found)

"""Deterministic pseudo-random column expressions for generated tables.

Every value is a function of the row's key and a tag, so a table is the same for any number of
partitions, lost tasks can be repeated, and no value needs a shuffle or a Python function.
Expressions are SQL text; keys and counts are 64-bit.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.schemas import benchmark

LEAST_ROWS, MOST_ROWS = 50_000, 2_000_000  # rows per generating task: enough work, files of a few 100 MB


def draw(tag: int, key: str, n: int | str) -> str:
    """Uniform number in [0, n)."""
    return f"pmod(xxhash64({tag}, {key}), {n})"


def bits(word: str, shift: int, n: int, width: int = 16) -> str:
    """Number in [0, n) from a slice of an already drawn 64-bit word."""
    return f"((shiftrightunsigned({word}, {shift}) & {(1 << width) - 1}) % {n})"


def choose(words: str | list[str], number: str) -> str:
    """Word of a fixed list by a number that starts at 0."""
    items = words.split(",") if isinstance(words, str) else words
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in items)
    return f"element_at(array({listed}), cast({number} as int) + 1)"


def money(cents: str, precision: int = 15) -> str:
    """Exact decimal with two places from whole cents."""
    if precision == 15:
        return f"cast({cents} as decimal(12,0)) * 0.01BD"  # the product is decimal(15,2) already
    return f"cast(cast({cents} as decimal({precision},0)) * 0.01BD as decimal({precision},2))"


def money_choice(number: str, first: int, last: int, step: int = 1) -> str:
    """Exact decimal from a short ladder of amounts in cents: a look-up in a constant, without arithmetic.

    ``number`` counts the rungs from 0. The result is decimal(15,2) already.
    """
    rungs = ", ".join(f"cast({cents // 100}.{cents % 100:02d}BD as decimal(15,2))" for cents in range(first, last + 1, step))
    return f"element_at(array({rungs}), cast({number} as int) + 1)"


def padded(key: str, width: int) -> str:
    return f"lpad(cast({key} as string), {width}, '0')"


def output_parts(sf) -> int:
    """Fewest output files per table: one per ten units of scale."""
    return max(1, math.ceil(sf / 10))


def tasks_for(spark: SparkSession, rows: int, parts: int | None, least: int = 1) -> int:
    """Partitions of a generated table: the wanted number, else by rows and by the cluster's width."""
    if parts:
        return parts
    per_task = min(max(math.ceil(rows / spark.sparkContext.defaultParallelism), LEAST_ROWS), MOST_ROWS)
    return max(least, math.ceil(rows / per_task), 1)


def numbered(spark: SparkSession, rows: int, key: str, parts: int | None, least: int = 1, start: int = 1) -> DataFrame:
    """Keys ``start`` … ``start + rows - 1``."""
    return spark.range(start, start + rows, 1, tasks_for(spark, rows, parts, least)).withColumnRenamed("id", key)


def finish(df: DataFrame, bench: str, table: str, values: dict[str, str], exact: tuple[str, ...] = ()) -> DataFrame:
    """Select a table's columns in order with its types.

    Decimal columns are given as whole cents, but for those in ``exact``, which have their type already.
    """
    picked = []
    for column, kind in benchmark(bench)[table]:
        value = values[column]
        if kind in ("I", "L"):
            value = f"cast({value} as bigint)"
        elif kind.startswith("D") and "_" in kind and column not in exact:
            value = money(value, int(kind[1:].split("_")[0]))
        picked.append(f"{value} as {column}")
    return df.selectExpr(*picked)


def count_sources(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table before export: ``(table, rows)``."""
    from functools import reduce

    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)

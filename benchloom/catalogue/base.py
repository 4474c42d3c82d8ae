"""Registry of runnable queries over a folder of tables, each with the SQL that must give the same rows.

``columns`` lists the result as ``name:type`` with ``s`` text, ``i`` bigint, ``d`` double, ``b`` boolean.
Both sides are cast to it, so decimals and dates compare by value.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# SQL that reads files names the folder of the scale at which results are compared.
ORACLE_DIR = "/root/testdata/sf0.01"

SPARK_TYPES = {"s": "string", "i": "bigint", "d": "double", "b": "boolean"}
SQL_TYPES = {"s": "VARCHAR", "i": "BIGINT", "d": "DOUBLE", "b": "BOOLEAN"}


class Entry(NamedTuple):
    build: Callable[[SparkSession, str], DataFrame]
    columns: list[tuple[str, str]]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def register(name: str, columns: str, sql: str | None = None):
    """Decorator: add a query under a name."""
    shape = [tuple(part.split(":")) for part in columns.split()]

    def add(build: Callable[[SparkSession, str], DataFrame]):
        ENTRIES[name] = Entry(build, shape, sql)
        return build

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    entry = ENTRIES[name]
    df = entry.build(spark, folder)
    return df.select(*[F.col(c).cast(SPARK_TYPES[t]).alias(c) for c, t in entry.columns])


def oracle(name: str) -> str | None:
    entry = ENTRIES[name]
    if entry.sql is None:
        return None
    picked = ", ".join(f'CAST("{c}" AS {SQL_TYPES[t]}) AS "{c}"' for c, t in entry.columns)
    return f"SELECT {picked} FROM ({entry.sql.strip()}) AS q"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

"""Publication of a dataset to the session catalog, with a manifest of the published files.

The table format is Parquet in the session catalog. The manifest is an ordinary table, one row per
published file. A catalog with its own file metadata could serve :func:`register` and
``inventory.current_inventory`` instead; nothing else here knows where the manifest lives.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchloom.operators.verify import content_sums
from benchloom.schemas import SALE_TABLES, benchmark
from benchloom.session import constant_rows

MANIFEST_TABLE = "manifest"
PROPERTY = "benchloom."


class TablesExist(ValueError):
    """Target tables exist and the caller did not ask to skip them."""


# --- writing --------------------------------------------------------------------------------------


# Columns whose values hardly repeat: a dictionary would be built in vain for every row group.
PLAIN_TPCH = (
    "s_suppkey s_name s_address s_phone c_custkey c_name c_address c_phone p_partkey ps_partkey o_orderkey o_custkey "
    "o_totalprice l_orderkey l_partkey l_extendedprice"
).split()


def plain_columns(bench: str, table: str) -> list[str]:
    if bench == "tpch":
        return [c for c, _ in benchmark(bench).get(table, ()) if c in PLAIN_TPCH]
    if table in SALE_TABLES:
        return [c for c, kind in benchmark(bench)[table] if kind in ("L", "D7_2") or c.endswith("_sk")]
    return []


def writer_options(bench: str, table: str = "") -> dict[str, str]:
    """Codec and row-group layout per benchmark: groups of 16 MiB (tpch) or of 122,880 rows (tpcds)."""
    layout = {"parquet.block.size": str(16 << 20)} if bench == "tpch" else {"parquet.block.row.count.limit": "122880"}
    plain = {f"parquet.enable.dictionary#{column}": "false" for column in plain_columns(bench, table)}
    return {"compression": "zstd", **layout, **plain}


def write_table(df: DataFrame, path: str, bench: str, table: str = "") -> dict[str, int]:
    """Write one table's files; an existing folder is an error, never overwritten.

    Returns the rows and the content sums of what was written, observed while it was.
    """
    seen = Observation()
    observed = df.observe(seen, F.count("*").alias("rows"), *content_sums(df))
    _write(observed, path, bench, table)
    return {name: value or 0 for name, value in seen.get.items()}


def _write(df: DataFrame, path: str, bench: str, table: str) -> None:
    df.write.mode("errorifexists").options(**writer_options(bench, table)).parquet(path)


# --- catalog --------------------------------------------------------------------------------------


def namespace_name(levels: list[str] | tuple[str, ...] | str) -> str:
    """The session catalog has one level, so deeper namespaces are joined."""
    return levels if isinstance(levels, str) else "_".join(levels)


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")


def existing_tables(spark: SparkSession, namespace: str, names: list[str]) -> list[str]:
    """Which of the names are tables of the namespace; a missing namespace has none."""
    if not spark.catalog.databaseExists(namespace):
        return []
    return sorted({t.name for t in spark.catalog.listTables(namespace)} & set(names))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession, namespace: str, table: str, schema: T.StructType, path: str, properties: dict[str, str]
) -> str:
    """Create an unpartitioned table over a folder and return its identity; an existing table is an error."""
    identity = str(uuid.uuid4())
    all_properties = {**properties, "table-uuid": identity}
    listed = ", ".join(f"{_text(PROPERTY + key)} = {_text(value)}" for key, value in all_properties.items())
    spark.sql(
        f"CREATE TABLE `{namespace}`.`{table}` ({_ddl(schema)}) USING parquet "
        f"TBLPROPERTIES ({listed}) LOCATION {_text(path)}"
    )
    return identity


def table_identities(spark: SparkSession, namespace: str, names: list[str]) -> DataFrame:
    """``(table, table_uuid)`` of published tables, at most one benchmark's worth of names."""
    rows = []
    for name in existing_tables(spark, namespace, names):
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES `{namespace}`.`{name}`").collect()}
        rows.append((name, found.get(f"{PROPERTY}table-uuid")))
    return constant_rows(spark, "table string, table_uuid string", rows)


# --- manifest -------------------------------------------------------------------------------------


def manifest_rows(parts: DataFrame, digests: DataFrame | None, run_id: str, snapshot_id: int) -> DataFrame:
    """Manifest rows of one snapshot from listed parts with footers (``table, path, rows, size_bytes``)."""
    rows = parts.select("table", "path", "rows", "size_bytes")
    if digests is not None:
        rows = rows.join(digests.select("path", F.col("digest").alias("md5")), "path")
    else:
        rows = rows.withColumn("md5", F.lit(None).cast("string"))
    return rows.select(
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        F.lit(run_id).alias("run_id"),
        "table",
        F.col("path").alias("uri"),
        "rows",
        "size_bytes",
        "md5",
        F.lit("data").alias("content"),
    )


MANIFEST_SCHEMA = (
    "snapshot_id bigint, uri string, rows bigint, size_bytes bigint, md5 string, content string, `table` string, "
    "run_id string"
)


def manifest_folder(spark: SparkSession, namespace: str) -> str:
    return f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{MANIFEST_TABLE}"


def read_manifest(spark: SparkSession, namespace: str) -> DataFrame:
    name = f"{namespace}.{MANIFEST_TABLE}"
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def ensure_manifest(spark: SparkSession, namespace: str) -> None:
    """The manifest has a folder for each table and run, so runs and tables never write to the same place."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{MANIFEST_TABLE}` ({MANIFEST_SCHEMA}) USING parquet "
        f"PARTITIONED BY (`table`, run_id) LOCATION {_text(manifest_folder(spark, namespace))}"
    )


def register(spark: SparkSession, namespace: str, table: str, run_id: str, rows: DataFrame) -> None:
    """Add the files of one table and run. A second attempt is an error, never a second copy."""
    folder = f"{manifest_folder(spark, namespace)}/table={table}/run_id={run_id}"
    rows.drop("table", "run_id").write.mode("errorifexists").parquet(folder)
    spark.sql(
        f"ALTER TABLE `{namespace}`.`{MANIFEST_TABLE}` ADD PARTITION (`table` = {_text(table)}, run_id = {_text(run_id)}) "
        f"LOCATION {_text(folder)}"
    )


def new_snapshot() -> int:
    """Number of a new snapshot; numbers grow with time, so the newest is the largest."""
    return time.time_ns() // 1000

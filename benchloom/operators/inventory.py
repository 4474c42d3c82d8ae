"""Comparison of published files with expected files. A manifest row is one published file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.schemas import benchmark
from benchloom.session import constant_rows

MANIFEST = (
    "snapshot_id bigint, run_id string, table string, uri string, rows bigint, size_bytes bigint, "
    "content string, table_uuid string"
)


def newest_snapshots(manifest: DataFrame) -> DataFrame:
    """Newest snapshot per table."""
    return manifest.groupBy("table").agg(F.max("snapshot_id").alias("snapshot_id"))


def current_inventory(manifest: DataFrame) -> DataFrame:
    """Live files of each table's newest snapshot, with the number of times each URI is listed.

    ``problem`` names rows that make the inventory unusable: a URI listed twice or a file that does not
    hold data. Rows are aggregated by URI, which also removes repeats before they travel.
    """
    live = manifest.join(newest_snapshots(manifest), ["table", "snapshot_id"], "left_semi")
    problem = F.when(F.col("listed") > 1, "duplicate uri").when(F.col("not_data") > 0, "not a data file")
    return (
        live.groupBy("table", "snapshot_id", "uri")
        .agg(
            F.min("rows").alias("rows"),
            F.min("size_bytes").alias("size_bytes"),
            F.count("*").alias("listed"),
            F.count_if(F.col("content") != "data").alias("not_data"),
        )
        .select("table", "snapshot_id", "uri", "rows", "size_bytes", problem.alias("problem"))
    )


def inventory_diff(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every URI that is not as expected: ``(table, uri, difference, …)``.

    Per table the checks have an order: file sets first, then the presence of a snapshot, then rows and
    sizes. A URI belongs to one table only, so one full outer join on (table, uri) finds all of them.
    """
    left = expected.select(
        "table", "uri", F.col("rows").alias("expected_rows"), F.col("size_bytes").alias("expected_bytes")
    ).withColumn("in_expected", F.lit(True))
    right = actual.select(
        "table", "uri", "snapshot_id", F.col("rows").alias("actual_rows"), F.col("size_bytes").alias("actual_bytes")
    ).withColumn("in_actual", F.lit(True))
    same = F.col("expected_rows").eqNullSafe(F.col("actual_rows")) & F.col("expected_bytes").eqNullSafe(
        F.col("actual_bytes")
    )
    difference = (
        F.when(F.col("in_actual").isNull(), "missing")
        .when(F.col("in_expected").isNull(), "unexpected")
        .when(F.col("snapshot_id").isNull(), "no snapshot")
        .when(~same, "rows or size differ")
    )
    return (
        left.join(right, ["table", "uri"], "full_outer")
        .withColumn("difference", difference)
        .where("difference is not null")
        .select("table", "uri", "difference", "expected_rows", "actual_rows", "expected_bytes", "actual_bytes")
    )


def inventory_verdicts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row per expected table: counts of differences and the first check that fails (``ok`` if none does)."""
    diff = inventory_diff(expected, actual)
    per_table = diff.groupBy("table").agg(
        F.count_if(F.col("difference") == "missing").alias("missing"),
        F.count_if(F.col("difference") == "unexpected").alias("unexpected"),
        F.count_if(F.col("difference") == "no snapshot").alias("no_snapshot"),
        F.count_if(F.col("difference") == "rows or size differ").alias("changed"),
    )
    counts = ["missing", "unexpected", "no_snapshot", "changed"]
    tables = expected.select("table").union(actual.select("table")).distinct()
    verdict = (
        F.when((F.col("missing") > 0) | (F.col("unexpected") > 0), "file set")
        .when(F.col("no_snapshot") > 0, "snapshot")
        .when(F.col("changed") > 0, "rows or size")
        .otherwise("ok")
    )
    return (
        tables.join(per_table, "table", "left")
        .select("table", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
        .withColumn("verdict", verdict)
    )


def replaced_tables(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Tables whose identity changed: both sides have ``(table, table_uuid)``."""
    return (
        expected.select("table", F.col("table_uuid").alias("expected_uuid"))
        .join(actual.select("table", F.col("table_uuid").alias("actual_uuid")), "table")
        .where(~F.col("expected_uuid").eqNullSafe(F.col("actual_uuid")))
    )


def tables_without_snapshot(tables: DataFrame, manifest: DataFrame) -> DataFrame:
    """Tables that have nothing registered yet; a new table must be one of them."""
    return tables.join(manifest.select("table").distinct(), "table", "left_anti")


def report_gaps(succeeded: DataFrame, bench: str) -> DataFrame:
    """Set difference both ways between the succeeded tables and the benchmark; empty means complete."""
    wanted = constant_rows(succeeded.sparkSession, "table string", [(t,) for t in benchmark(bench)])
    found = succeeded.select("table").distinct()
    return (
        wanted.exceptAll(found)
        .withColumn("gap", F.lit("missing"))
        .unionByName(found.exceptAll(wanted).withColumn("gap", F.lit("unexpected")))
    )


def size_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files whose size is no longer the validated one, or that are gone: columns of ``before`` and ``size_after``."""
    later = after.select("path", F.col("size_bytes").alias("size_after"))
    return (
        before.withColumnRenamed("size_bytes", "size_before")
        .join(later, "path", "left")
        .where(~F.col("size_before").eqNullSafe(F.col("size_after")))
    )

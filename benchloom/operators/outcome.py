"""What a publication attempt came to, per file and per table, and the summary of runs.

Inputs are rows, because an unclear commit is a fact to be classified after the event:

* ``parts``: ``(table, uri, …)`` files a table was to register;
* ``known``: ``(table, uri)`` files seen in the last state that could be read;
* ``outcomes``: one row per table, ``(table, error_class, state_seen, verified)``.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Error classes that prove a commit was refused; any other error leaves it open.
DEFINITE_REJECTIONS = ("bad_request", "commit_conflict", "forbidden", "unauthorized")
# SQL state classes and states that Spark's errors carry.
REJECTED_STATES = {
    "28": "unauthorized",
    "42501": "forbidden",
    "42K04": "commit_conflict",
    "42710": "commit_conflict",
    "42P07": "commit_conflict",
    "428FT": "commit_conflict",
    "22": "bad_request",
    "42": "bad_request",
}
FINAL_STATUSES = ("succeeded", "skipped", "failed", "uncertain")


def is_definite_rejection(error_class: Column) -> Column:
    return F.coalesce(error_class.isin(*DEFINITE_REJECTIONS), F.lit(False))


def error_class(error: Exception) -> str:
    """The kind of a failed commit: a definite rejection where the error proves one, else the name of its class."""
    if isinstance(error, PermissionError):
        return "forbidden"
    if isinstance(error, FileExistsError):
        return "commit_conflict"
    state = error.getSqlState() if isinstance(error, PySparkException) and hasattr(error, "getSqlState") else None
    for length in (5, 2):
        if state and state[:length] in REJECTED_STATES:
            return REJECTED_STATES[state[:length]]
    return type(error).__name__


def classify_parts(parts: DataFrame, known: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Add ``state`` to every file of an attempt; without an outcome of its table nothing is known of its commit.

    The join with ``outcomes`` is on the table and may be hot when one table owns most files; that side
    has one row per table, so Spark broadcasts it while it is small and AQE splits the hot key when not.
    """
    seen = known.select("table", "uri").distinct().withColumn("_known", F.lit(True))
    facts = outcomes.select(
        "table", is_definite_rejection(F.col("error_class")).alias("_rejected"), F.col("state_seen").alias("_seen"),
        F.col("verified").alias("_verified"),
    )
    state = (
        F.when(F.coalesce("_known", F.lit(False)) | F.coalesce("_verified", F.lit(False)), "registered")
        .when(F.col("_rejected") & F.col("_seen"), "uploaded_unregistered")
        .otherwise("commit_unknown")
    )
    return (
        parts.join(seen, ["table", "uri"], "left")
        .join(facts, "table", "left")
        .withColumn("state", state)
        .drop("_known", "_rejected", "_seen", "_verified")
    )


def classify_tables(parts: DataFrame, known: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Status per table with an outcome: ``(table, status, files, known_files)``; a table without files has 0 of both.

    A verified table succeeded whatever the answer was. If all files are there but the check failed, or
    the commit was refused for certain, it failed. Everything else stays uncertain.
    """
    seen = known.select("table", "uri").distinct().withColumn("_known", F.lit(1))
    counted = (
        parts.select("table", "uri")
        .join(seen, ["table", "uri"], "left")
        .groupBy("table")
        .agg(F.count("*").alias("files"), F.coalesce(F.sum("_known"), F.lit(0)).alias("known_files"))
    )
    status = (
        F.when(F.col("verified"), "succeeded")
        .when(F.col("state_seen") & (F.col("files") > 0) & (F.col("known_files") == F.col("files")), "failed")
        .when(is_definite_rejection(F.col("error_class")) & F.col("state_seen"), "failed")
        .otherwise("uncertain")
    )
    counts = outcomes.join(counted, "table", "left").fillna(0, ["files", "known_files"])
    return counts.withColumn("status", status).select("table", "status", "files", "known_files")


def after_interrupt(tables: DataFrame) -> DataFrame:
    """Statuses once a run was interrupted: a commit in flight is uncertain, earlier steps failed."""
    status = (
        F.when(F.col("status") == "committing", "uncertain")
        .when(F.col("status").isin("creating", "uploading"), "failed")
        .otherwise(F.col("status"))
    )
    return tables.withColumn("status", status)


def status_list_name(status: Column) -> Column:
    return F.when(status.isin(*FINAL_STATUSES), status).otherwise("not_loaded")


def status_lists(tables: DataFrame) -> DataFrame:
    """Members of each status list of a run, one row per table, so that no list is gathered in one place."""
    return tables.select("run_id", status_list_name(F.col("status")).alias("list"), "table")


def status_counts(tables: DataFrame) -> DataFrame:
    """Size of every status list per run."""
    return (
        tables.groupBy("run_id", status_list_name(F.col("status")).alias("list"))
        .agg(F.count("*").alias("tables"))
    )


def needs_inspection(tables: DataFrame) -> DataFrame:
    """Tables whose creation was at least begun and that neither succeeded nor were skipped."""
    return tables.where(
        "table_creation_state is not null and table_creation_state <> '' and status not in ('succeeded', 'skipped')"
    ).select("run_id", "table", "table_creation_state", "status")


def generated_totals(tables: DataFrame) -> DataFrame:
    """Generated rows and bytes per run over all tables, skipped ones too; unknown counts are zero."""
    return tables.groupBy("run_id").agg(
        F.sum(F.coalesce("row_count", F.lit(0))).alias("generated_rows"),
        F.sum(F.coalesce("size_bytes", F.lit(0))).alias("generated_bytes"),
    )


def upload_candidates(files: DataFrame) -> DataFrame:
    """Files that may lie in the store without being registered, and in which list they belong."""
    kind = F.when(F.col("state") == "commit_unknown", "uncertain_uploads").otherwise("unregistered_uploads")
    return files.where("uri is not null and uri <> '' and state not in ('registered', 'local')").select(
        "run_id", kind.alias("list"), "table", "uri", "state"
    )


def run_summary(tables: DataFrame) -> DataFrame:
    """Printable rows of a run: table, status, rows, files, size; a dash where nothing is known."""
    from benchloom.functions.sizes import format_bytes

    dash = F.lit("-")
    return tables.select(
        "run_id",
        "table",
        "status",
        F.coalesce(F.format_number("row_count", 0), dash).alias("rows"),
        F.coalesce(F.col("file_count").cast("string"), dash).alias("files"),
        F.coalesce(format_bytes(F.col("size_bytes")), dash).alias("size"),
    )


SLOT = 64  # slots per second for the coarse pass of the median


def median_seconds(durations: DataFrame) -> DataFrame:
    """Exact median per run, ``(run_id, files, median_seconds)``, without gathering a run in one task.

    Values are counted in slots of 1/64 second, which tells the slot that holds the middle rank. Only the
    distinct values of that slot are then ranked; recorded times have six decimals, so these are few.
    """
    values = durations.groupBy("run_id", "seconds").agg(F.count("*").alias("n"))
    slot = F.floor(F.col("seconds") * SLOT)
    slots = values.groupBy("run_id", slot.alias("slot")).agg(F.sum("n").alias("n"))
    by_slot = Window.partitionBy("run_id").orderBy("slot")
    ranked = slots.select(
        "run_id",
        "slot",
        F.coalesce(F.sum("n").over(by_slot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(by_slot.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("n").over(Window.partitionBy("run_id")).alias("files"),
    )
    # Ranks (from 0) of the one or two middle values.
    low, high = F.expr("(files - 1) div 2"), F.expr("files div 2")
    middle = ranked.where(
        ((low >= F.col("before")) & (low < F.col("upto"))) | ((high >= F.col("before")) & (high < F.col("upto")))
    )
    inside = values.withColumn("slot", slot).join(middle.drop("upto"), ["run_id", "slot"])
    by_value = Window.partitionBy("run_id", "slot").orderBy("seconds")
    start = F.col("before") + F.sum("n").over(by_value) - F.col("n")
    hits = (low >= F.col("start")).cast("int") * (low < F.col("start") + F.col("n")).cast("int") + (
        high >= F.col("start")
    ).cast("int") * (high < F.col("start") + F.col("n")).cast("int")
    return (
        inside.withColumn("start", start)
        .groupBy("run_id")
        .agg(F.max("files").alias("files"), (F.sum(hits * F.col("seconds")) / 2).alias("median_seconds"))
    )


def timing_rollup(durations: DataFrame, baseline_run: str) -> DataFrame:
    """Median seconds per run and the baseline's median over it: ``(run_id, files, median_seconds, speedup)``."""
    medians = median_seconds(durations)
    base = medians.where(F.col("run_id") == baseline_run).select("median_seconds")
    return medians.withColumn("speedup", base.scalar() / F.col("median_seconds"))


def file_speedups(durations: DataFrame, baseline_run: str) -> DataFrame:
    """Per file, the baseline's seconds over every other run's: ``(run_id, file, seconds, speedup)``."""
    base = durations.where(F.col("run_id") == baseline_run).select("file", F.col("seconds").alias("base_seconds"))
    return (
        durations.where(F.col("run_id") != baseline_run)
        .join(base, "file")
        .select("run_id", "file", "seconds", (F.col("base_seconds") / F.col("seconds")).alias("speedup"))
    )

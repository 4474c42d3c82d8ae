"""Session settings. On a cluster the submitter's own settings win; nothing here overrides them."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, name: str = "benchloom", memory: str = "12g") -> SparkSession:
    """Session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        # No call sites per expression: building plans takes half the time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; a scratch one only where it is unset."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="benchloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def file_tasks(spark: SparkSession, requested: int | None = None) -> int:
    """Tasks for a job over a list of files: the rows are tiny, so AQE must not merge them by bytes."""
    return requested or max(2 * spark.sparkContext.defaultParallelism, 8)


FILES_PER_TASK = 64
BYTES_PER_TASK = 256 << 20


def opening_tasks(parts: DataFrame, requested: int | None = None, whole: bool = False) -> int:
    """Tasks for a job that opens the files ``parts``: so many that each has few files, and, where files are read as a
    whole, few bytes. It follows from the listing, not from the executors that happen to be there when a plan is built."""
    if requested:
        return requested
    sized = whole and "size_bytes" in parts.columns
    size = F.sum("size_bytes") if sized else F.lit(0)
    found = parts.agg(F.count("*").alias("files"), F.coalesce(size, F.lit(0)).alias("size")).first()
    return max(file_tasks(parts.sparkSession), -(-found.files // FILES_PER_TASK), 2 * -(-found.size // BYTES_PER_TASK))


def constant_rows(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small fixed table as constants of the plan, ``columns`` being ``name type, …``.

    Unlike rows shipped from Python it has a known size, so joins with it are planned as broadcasts, and
    scanning it needs no job.
    """

    def literal(value) -> str:
        if value is None:
            return "null"
        if isinstance(value, bool):
            return str(value).lower()
        if isinstance(value, (list, tuple)):
            return f"array({', '.join(map(literal, value))})"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    named = [part.strip().split(" ", 1) for part in columns.split(",")]
    if not rows:
        return spark.createDataFrame([], columns)
    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    picked = ", ".join(f"cast({name} as {kind}) as {name}" for name, kind in named)
    return spark.sql(f"SELECT {picked} FROM VALUES {values} AS t({', '.join(n for n, _ in named)})")

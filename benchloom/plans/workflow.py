"""The three runs a user starts: generate a dataset, load it into a namespace, verify a load from its report.

Driver code only decides and submits: tables are at most 8 or 24, everything per file or per row is a
Spark job. Table jobs run side by side from a small thread pool; with the FAIR scheduler they share the
cluster.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import UTC, datetime
from decimal import Decimal
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from benchloom.functions.text import redact_text, uri_problem
from benchloom.operators import conform, inventory, keysets, outcome, verify
from benchloom.schemas import benchmark, table_schema
from benchloom.session import constant_rows, ensure_checkpoint_dir
from benchloom.sinks import publish
from benchloom.sources import files, scan
from benchloom.sources.tpcds_data import Tpcds
from benchloom.sources.tpch_data import Tpch

WORKERS = 8
FILES_PER_LINE = 1_000  # files in one line of a report, so that no table's files meet in one row


class DatasetInvalid(ValueError):
    """The gate is closed; ``findings`` has the number of violations per check."""

    def __init__(self, findings: dict[str, int]):
        super().__init__(", ".join(f"{check}: {count}" for check, count in sorted(findings.items())))
        self.findings = findings


class LoadFailed(RuntimeError):
    """At least one table was not published; the others stay."""


@dataclass
class Dataset:
    """A written dataset and what is known about it; ``parts`` has one row per file with its footer."""

    bench: str
    sf: Decimal
    root: str
    parts: DataFrame
    sources: DataFrame | None = None


@dataclass
class Load:
    """Outcome of a load: one row per table and per file."""

    run_id: str
    namespace: str
    root: str | None
    tables: DataFrame
    files: DataFrame | None
    skipped: list[str] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    sources: DataFrame | None = None
    schemas: dict[str, StructType] = field(default_factory=dict)
    snapshot_id: int | None = None
    started_at: str | None = None


def timestamp() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def generator(spark: SparkSession, bench: str, sf, parts: int | None = None) -> dict[str, DataFrame]:
    """Lazy tables of a benchmark at a positive scale factor."""
    makers = {"tpch": Tpch, "tpcds": Tpcds}
    if bench not in makers:
        raise ValueError(f"unknown benchmark {bench!r}")
    return makers[bench](spark, sf, parts).tables()


def for_each_table(
    spark: SparkSession, names: list[str], work: Callable[[str], None], workers: int = WORKERS, seconds: float | None = None
) -> dict[str, Exception]:
    """Run one job per table side by side. A failing table does not stop the others; its error is returned.

    Each table's jobs have a pool of their own, so with the FAIR scheduler none waits for all stages of another, and a
    tag, by which a table that takes longer than ``seconds`` is interrupted without touching the others.
    """
    failed: dict[str, Exception] = {}
    batch = uuid.uuid4().hex

    def guarded(name: str) -> None:
        tag, context = f"{batch}-{name}", spark.sparkContext
        timer = threading.Timer(seconds, lambda: context.cancelJobsWithTag(tag)) if seconds else None
        context.setLocalProperty("spark.scheduler.pool", f"benchloom-{name}")
        context.addJobTag(tag)
        try:
            if timer:
                timer.start()
            work(name)
        except Exception as exc:
            failed[name] = exc
        finally:
            if timer:
                timer.cancel()
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(names) or 1))) as pool:
        # A target of its own for each table: it holds a copy of the caller's local properties.
        started = [pool.submit(inheritable_thread_target(spark)(guarded), name) for name in names]
        wait(started)
    return failed


def write_dataset(
    spark: SparkSession, bench: str, sf, root: str, parts: int | None = None, workers: int = WORKERS
) -> DataFrame:
    """Generate all tables into one folder each and return ``(table, rows, content)`` as seen while they were written."""
    tables = generator(spark, bench, sf, parts)
    seen: dict[str, dict[str, int]] = {}

    def write(name: str) -> None:
        seen[name] = publish.write_table(tables[name], f"{root}/{name}", bench, name)

    # Longest first, so that the big tables do not start when the others are done.
    order = sorted(tables, key=lambda name: name not in ("lineitem", "orders") and not name.endswith("_sales"))
    failed = for_each_table(spark, order, write, workers)
    if failed:
        name, error = sorted(failed.items())[0]
        raise RuntimeError(f"table {name} could not be generated: {error}") from error
    rows = [(name, found["rows"], *(found[x] for x in verify.SUMS)) for name, found in seen.items()]
    shape = ", ".join(["table string, rows bigint", *(f"{x} bigint" for x in verify.SUMS)])
    return constant_rows(spark, shape, rows).select("table", "rows", verify.content_text(*verify.SUMS).alias("content"))


def inspect(spark: SparkSession, bench: str, sf, root: str, sources: DataFrame | None = None) -> Dataset:
    """List a dataset and read every footer once.

    The result is what the run validates and publishes, so it is fixed by a checkpoint: a lost executor
    must not make a later step see files as they are then.
    """
    ensure_checkpoint_dir(spark)
    footers = files.assign_table(scan.footers(spark, root), bench).checkpoint()
    return Dataset(bench, Decimal(str(sf)), root, footers, sources)


def violations(dataset: Dataset) -> DataFrame:
    """All findings about a dataset."""
    return conform.dataset_violations(
        dataset.parts,
        dataset.parts,
        dataset.bench,
        dataset.sf,
        files.missing_tables(dataset.parts, dataset.bench),
        files.duplicate_parts(dataset.parts),
        dataset.sources,
    )


def require_valid(dataset: Dataset) -> None:
    """The gate: nothing may be published while one check of one table has a finding."""
    found = {r["check"]: r["findings"] for r in conform.gate(violations(dataset)).collect()}
    if found:
        raise DatasetInvalid(found)


def generate(
    spark: SparkSession, bench: str, sf, root: str, parts: int | None = None, workers: int = WORKERS
) -> Dataset:
    """Write a dataset and check it."""
    sources = write_dataset(spark, bench, sf, root, parts, workers)
    dataset = inspect(spark, bench, sf, root, sources)
    require_valid(dataset)
    return dataset


def load(
    spark: SparkSession,
    bench: str,
    sf,
    namespace: str | tuple[str, ...],
    location: str,
    on_exists: str = "error",
    checksum: bool = True,
    parts: int | None = None,
    workers: int = WORKERS,
    run_id: str | None = None,
    allow_local: bool = False,
) -> Load:
    """Generate, check and publish a benchmark.

    Files are written once, to a folder of this run below ``location``; tables and manifest rows are made
    only after the whole dataset passed. Existing tables stop the run before anything is generated, or are
    left alone with ``on_exists="skip"``. A location that others cannot read later is refused; ``allow_local``
    admits a local one. Each step of a run is recorded before it begins, see :func:`read_record`.
    """
    if on_exists not in ("error", "skip"):
        raise ValueError("on_exists is 'error' or 'skip'")
    run_id, namespace, started_at = run_id or uuid.uuid4().hex, publish.namespace_name(namespace), timestamp()
    require_durable(spark, f"{location.rstrip('/')}/{run_id}", allow_local)
    names = list(benchmark(bench))
    present = publish.existing_tables(spark, namespace, names)
    if present and on_exists == "error":
        raise publish.TablesExist(f"tables exist already: {', '.join(present)}")
    if len(present) == len(names):
        rows = [(run_id, name, "skipped", None, 0, 0, 0, None) for name in names]
        return Load(run_id, namespace, None, constant_rows(spark, TABLE_ROW, rows), None, present, started_at=started_at)

    root = f"{location.rstrip('/')}/{run_id}"
    record(spark, root, run_id, 0, {name: "skipped" if name in present else "generating" for name in names}, present)
    dataset = generate(spark, bench, sf, root, parts, workers)
    result = _publish(spark, dataset, namespace, run_id, present, checksum, workers)
    result.started_at = started_at
    return result


def file_schemas(parts: DataFrame) -> dict[str, StructType]:
    """The schema of each table by its first part's footer; files say of no column that it can't be null."""
    first = parts.where("table is not null and error is null").groupBy("table").agg(F.min_by("columns", "path").alias("columns"))
    return {
        row["table"]: StructType([StructField(c["name"], StructType.fromDDL(f"x {c['type']}")[0].dataType) for c in row["columns"]])
        for row in first.collect()  # 8 or 24
    }


def require_durable(spark: SparkSession, uri: str, allow_local: bool = False) -> None:
    """Refuse a location that is not one for good; a local one only if it is not allowed."""
    found = spark.range(1).select(uri_problem(F.lit(uri)).alias("problem")).first().problem
    if found and not (allow_local and found == "local"):
        raise ValueError(f"the location is {found}")


# --- record of a run ------------------------------------------------------------------------------


def record(
    spark: SparkSession, root: str, run_id: str, step: int, statuses: dict[str, str], created: Iterable[str] = ()
) -> None:
    """Note what a run is about to do with each table, in a folder of the step's own beside the data."""
    rows = [(run_id, step, n, s, "begun" if step or n in created else None) for n, s in statuses.items()]
    frame = constant_rows(spark, RECORD_ROW, rows)
    frame.coalesce(1).write.mode("errorifexists").json(f"{root}_record/step-{step}")


RECORD_ROW = "run_id string, step int, table string, status string, table_creation_state string"


def read_record(spark: SparkSession, root: str) -> DataFrame:
    """Last known status of every table of a run, also of one that was cut off: what was in flight is uncertain."""
    steps = spark.read.schema(RECORD_ROW).json(f"{root}_record/step-*")
    last = steps.groupBy("run_id", "table").agg(
        F.max_by("status", "step").alias("status"), F.max("table_creation_state").alias("table_creation_state")
    )
    return outcome.after_interrupt(last)


TABLE_ROW = (
    "run_id string, table string, status string, table_creation_state string, row_count bigint, size_bytes bigint, "
    "file_count bigint, table_uuid string"
)


def _publish(
    spark: SparkSession,
    dataset: Dataset,
    namespace: str,
    run_id: str,
    skipped: list[str],
    checksum: bool,
    workers: int,
) -> Load:
    bench, active = dataset.bench, [n for n in benchmark(dataset.bench) if n not in skipped]
    publish.ensure_namespace(spark, namespace)
    properties = {
        "run-id": run_id,
        "benchmark": bench,
        "scale-factor": str(dataset.sf),
        "generator": "benchloom",
        "generator-version": "1",
    }
    identities: dict[str, str] = {}
    record(spark, dataset.root, run_id, 1, dict.fromkeys(active, "creating"))
    publish.ensure_manifest(spark, namespace)
    before = publish.read_manifest(spark, namespace)

    schemas = file_schemas(dataset.parts)

    def create(name: str) -> None:
        identities[name] = publish.create_table(spark, namespace, name, schemas[name], f"{dataset.root}/{name}", properties)

    errors = {name: masked(exc) for name, exc in for_each_table(spark, active, create, workers).items()}
    odd = conform.published_schemas_violations(spark, {f"{namespace}.{name}": schemas[name] for name in identities})
    for full_name in {r["table"] for r in odd.collect()}:
        errors[full_name.split(".", 1)[1]] = "the catalog has another schema than the files"
    for name in {r["table"] for r in before.select("table").distinct().collect()} & set(identities):
        errors[name] = "a new table has registered files already"
    identities = {name: identity for name, identity in identities.items() if name not in errors}
    created = [name for name in active if name in identities]

    # The bytes must still be the validated ones when they are registered. Hashing reads them all and
    # so knows their number; without hashing the files are listed again.
    digests, warnings = None, []
    if checksum:
        digests = scan.composite_digests(spark, dataset.root).checkpoint()
        after = digests.select("path", F.col("read_bytes").alias("size_bytes"))
        copies = files.equal_content(dataset.parts.join(digests, "path"), "digest").count()
        if copies:
            warnings.append(f"files of equal content under several names: {copies}")
    else:
        after = scan.scan(spark, dataset.root, "listing")
    changed = inventory.size_changes(dataset.parts.select("path", "table", "size_bytes"), after)
    unstable = {r["table"] for r in changed.select("table").distinct().collect()}
    errors.update({name: "a file changed its size after validation" for name in unstable if name in created})
    ready = [name for name in created if name not in unstable]

    attempt = dataset.parts.where(F.col("table").isin(ready))
    snapshot_id = publish.new_snapshot()
    rows = publish.manifest_rows(attempt, digests, run_id, snapshot_id)
    record(spark, dataset.root, run_id, 2, {n: "committing" if n in ready else "failed" for n in active})
    # Each table on its own: one that fails does not take the others along. Whether a commit whose answer is an
    # error arrived is read back below, never assumed.
    refused = for_each_table(
        spark, ready, lambda n: publish.register(spark, namespace, n, run_id, rows.where(F.col("table") == n)), workers
    )
    errors.update({name: masked(exc) for name, exc in refused.items()})

    expected = attempt.select("table", F.col("path").alias("uri"), "rows", "size_bytes")
    registered, live = read_back(spark, namespace, run_id)
    state_seen = registered is not None
    if not state_seen:
        registered = spark.createDataFrame([], publish.MANIFEST_SCHEMA)
        live = inventory.current_inventory(registered)
        errors.update({name: errors.get(name, "the manifest could not be read back") for name in ready})
    verdicts = inventory.inventory_verdicts(expected, live.where("problem is null"))
    classes = constant_rows(
        spark, "table string, error_class string", [(n, outcome.error_class(exc)) for n, exc in refused.items()]
    )
    outcomes = verdicts.join(classes, "table", "left").select(
        "table",
        "error_class",
        F.lit(state_seen).alias("state_seen"),
        (F.lit(state_seen) & (F.col("verdict") == "ok")).alias("verified"),
    )
    states = outcome.classify_parts(expected, live, outcomes)

    # One row per table from here on: at most 24.
    totals = files.table_totals(dataset.parts).join(verdicts.select("table", "verdict"), "table", "left")
    found = {r["table"]: r for r in totals.collect()}
    status = {name: "succeeded" for name in ready if state_seen and found[name]["verdict"] == "ok"}
    if len(status) < len(ready):
        status = {r["table"]: r["status"] for r in outcome.classify_tables(expected, live, outcomes).collect()}
    table_rows = []
    for name in benchmark(bench):
        total = found[name]
        final = "skipped" if name in skipped else status.get(name, "failed")
        state = (
            "existing_skipped"
            if name in skipped
            else ("created_and_validated" if name in identities else "unknown_or_unvalidated")
        )
        table_rows.append(
            (run_id, name, final, state, total["rows"], total["size_bytes"], total["files"], identities.get(name))
        )
    recorded = registered.select("uri", "md5")
    file_rows = states.join(recorded, "uri", "left").withColumn("run_id", F.lit(run_id))
    tables = constant_rows(spark, TABLE_ROW, table_rows)
    record(spark, dataset.root, run_id, 3, {row[1]: row[2] for row in table_rows})
    return Load(
        run_id, namespace, dataset.root, tables, file_rows, skipped, errors, warnings, dataset.sources, schemas, snapshot_id
    )


def masked(error: Exception) -> str:
    """The text of an error without secrets, links with credentials and control characters."""
    spark = SparkSession.getActiveSession()
    return spark.range(1).select(redact_text(F.lit(str(error))).alias("text")).first().text


def read_back(spark: SparkSession, namespace: str, run_id: str, tries: int = 3) -> tuple[DataFrame | None, DataFrame | None]:
    """(manifest rows of a run, its live files) as they are now, or nothing if no try could read them."""
    for _ in range(tries):
        try:
            registered = publish.read_manifest(spark, namespace).where(F.col("run_id") == run_id)
            # The state as it was read back, for the tables' statuses and the files' states alike.
            return registered, inventory.current_inventory(registered).checkpoint()
        except Exception:
            spark.catalog.refreshTable(f"{namespace}.{publish.MANIFEST_TABLE}")
    return None, None


def require_loaded(result: Load) -> Load:
    """Raise if a table failed or its outcome is open; tables that were published stay as they are."""
    bad = [r["table"] for r in result.tables.where("status not in ('succeeded', 'skipped')").collect()]
    if bad:
        shown = "; ".join(f"{name}: {result.errors.get(name, 'outcome open')}" for name in bad)
        raise LoadFailed(shown)
    return result


# --- report ---------------------------------------------------------------------------------------


RUN_SUMMARY = (
    "succeeded array<string>, skipped array<string>, failed array<string>, uncertain array<string>, "
    "not_loaded array<string>, tables_requiring_inspection array<struct<table: string, identifier: array<string>, "
    "creation_state: string, status: string>>, generated_rows bigint, generated_bytes bigint"
)


def run_summary(namespace: str, tables: list) -> dict:
    """What a report says of all tables of a run, at most 24: names by status, those to look at, and totals."""
    lists = {name: [] for name in (*outcome.FINAL_STATUSES, "not_loaded")}
    for r in tables:
        lists[r["status"] if r["status"] in lists else "not_loaded"].append(r["table"])
    open_tables = [
        {"table": r["table"], "identifier": [namespace, r["table"]], "creation_state": r["table_creation_state"], "status": r["status"]}
        for r in tables
        if r["table_creation_state"] and r["status"] not in ("succeeded", "skipped")
    ]
    totals = {f"generated_{name}": sum(r[column] or 0 for r in tables) for name, column in (("rows", "row_count"), ("bytes", "size_bytes"))}
    return lists | {"tables_requiring_inspection": open_tables} | totals


def write_report(result: Load, bench: str, sf, path: str) -> None:
    """Save a load as report lines.

    Each line is a report of its own with one table and at most ``FILES_PER_LINE`` of its files, so the
    writing is spread and nothing grows with the number of files in one place. The summary of a line has the tables of the
    whole run, and of files that are not registered those of the line.
    """
    spark = result.tables.sparkSession
    known_tables = result.tables.collect()  # 8 or 24
    none = F.lit(None).cast("array<struct<local_path: string, row_count: bigint, size_bytes: bigint, remote_uri: string, state: string, md5: string>>")
    tables = result.tables
    if result.sources is not None:
        tables = tables.join(result.sources.select("table", "content"), "table", "left")
    else:
        tables = tables.withColumn("content", F.lit(None).cast("string"))
    shape = "array<struct<name: string, type: string, nullable: boolean>>"
    shapes = [
        (name, json.dumps([{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schema.fields]))
        for name, schema in result.schemas.items()
    ]
    tables = tables.join(constant_rows(spark, "table string, shape string", shapes), "table", "left").withColumn(
        "shape", F.from_json("shape", shape)
    )
    bare = tables.withColumn("files", none)
    if result.files is not None:
        file = F.struct(
            F.col("uri").alias("local_path"),
            F.col("rows").alias("row_count"),
            "size_bytes",
            F.col("uri").alias("remote_uri"),
            "state",
            "md5",
        )
        lines = F.greatest(F.lit(1), F.ceil(F.col("file_count") / FILES_PER_LINE))
        # At most 24 rows, so the files stay where they are.
        small = F.broadcast(tables)
        sized = result.files.join(F.broadcast(result.tables.select("table", "file_count")), "table")
        parts = (
            sized.withColumn("line", F.pmod(F.xxhash64("uri"), lines))
            .groupBy("table", "line")
            .agg(F.collect_list(file).alias("files"))
        )
        with_files = parts.join(small, "table").select(*bare.columns)
        present = [r["table"] for r in result.files.select("table").distinct().collect()]
        bare = with_files.unionByName(bare.where(~F.col("table").isin(present)))
    row = F.struct(
        "status",
        F.array(F.lit(result.namespace), "table").alias("table_identifier"),
        "table_uuid",
        "table_creation_state",
        F.when(F.col("status") == "succeeded", F.lit(result.snapshot_id).cast("bigint")).alias("snapshot_id"),
        "row_count",
        "size_bytes",
        "file_count",
        "content",
        F.col("shape").alias("schema"),
        "files",
    )
    run = F.from_json(F.lit(json.dumps(run_summary(result.namespace, known_tables))), RUN_SUMMARY)

    def uploads(kind):
        chosen = F.filter(F.coalesce("files", F.array()), lambda f: f["remote_uri"].isNotNull() & kind(f["state"]))
        return F.transform(
            chosen, lambda f: F.struct(F.col("table").alias("table"), f["remote_uri"].alias("uri"), f["state"].alias("state"))
        )

    summary = F.struct(
        *(run[name].alias(name) for name in StructType.fromDDL(RUN_SUMMARY).names),
        uploads(lambda state: ~state.isin("registered", "local", "commit_unknown")).alias("unregistered_uploads"),
        uploads(lambda state: state == "commit_unknown").alias("uncertain_uploads"),
        F.array().alias("probe_cleanup_candidates"),  # files are written once, without probes
    )
    finished_at = F.lit(timestamp())
    failed = any(r["status"] not in ("succeeded", "skipped") for r in known_tables)
    counts = F.lit(None).cast("map<string, bigint>")
    if result.sources is not None:
        found = [x for r in result.sources.collect() for x in (F.lit(r["table"]), F.lit(r["rows"]))]  # 24 tables
        counts = F.create_map(*found).cast("map<string, bigint>")
    document = F.struct(
        F.lit(verify.REPORT_VERSION).alias("report_format_version"),
        "run_id",
        F.lit("load").alias("command"),
        F.lit(bench).alias("benchmark"),
        F.lit(str(sf)).alias("scale_factor"),
        F.array(F.lit(result.namespace)).alias("namespace"),
        F.lit("failed" if failed else "succeeded").alias("status"),
        F.lit(result.started_at).cast("string").alias("started_at"),
        finished_at.alias("updated_at"),
        finished_at.alias("finished_at"),
        F.struct(
            F.lit("benchloom").alias("implementation"), F.lit("1").alias("version"), counts.alias("source_row_counts")
        ).alias("generator"),
        F.array(*map(F.lit, result.warnings)).cast("array<string>").alias("warnings"),
        F.array(*(F.lit(f"{name}: {text}") for name, text in sorted(result.errors.items()))).cast("array<string>").alias("errors"),
        F.create_map("table", row).alias("tables"),
        summary.alias("summary"),
    )
    bare.select(F.to_json(document).alias("value")).write.mode("errorifexists").text(path)


# --- verification ---------------------------------------------------------------------------------


def verify_load(
    spark: SparkSession,
    report: str,
    root: str,
    full_read: bool = False,
    checksum: bool = False,
    sample: bool = False,
    require_complete: bool = False,
    allow_local: bool = False,
    keys: bool = False,
) -> DataFrame:
    """Findings about a published load, from its saved report: ``(check, table, subject, expected, actual)``.

    An empty result means the load is intact. Nothing is changed. ``keys`` looks for repeated primary keys and rows without
    a parent in a complete TPC-H load; other loads have no key rules and refuse it.
    """
    reports = verify.read_reports(spark, report, lines=True)
    if not reports.join(verify.rejected_reports(reports), "run_id", "left_semi").isEmpty():
        raise ValueError("expected a load report of format version 1")
    tables = verify.report_tables(reports)
    loads = tables.select("run_id", "benchmark", F.element_at("table_identifier", 1).alias("namespace")).distinct()
    found = loads.limit(2).collect()
    if len(found) != 1:
        raise ValueError("the report must be of one run of one benchmark in one namespace")
    bench, namespace = found[0]["benchmark"], found[0]["namespace"]
    succeeded = tables.where("status = 'succeeded'")
    ensure_checkpoint_dir(spark)
    wanted = verify.report_files(tables).checkpoint()
    names = [r["table"] for r in succeeded.select("table").distinct().collect()]  # at most 24
    if not names:
        raise ValueError("the report has no table to verify")
    if keys and (bench != "tpch" or set(names) != set(benchmark(bench))):
        raise ValueError("keys can be checked for a complete load of tpch only")
    require_durable(spark, root, allow_local)
    there = set(publish.existing_tables(spark, namespace, names))

    checks = [
        conform.violation(
            verify.report_file_problems(wanted), "report_file", F.col("table"), F.col("uri"), "registered", F.col("problem")
        )
    ]
    if require_complete:
        gaps = inventory.report_gaps(succeeded, bench)
        checks.append(conform.violation(gaps, "complete", F.col("table"), F.col("table"), "succeeded", F.col("gap")))
    replaced = inventory.replaced_tables(
        succeeded.select("table", "table_uuid").distinct(), publish.table_identities(spark, namespace, names)
    )
    checks.append(
        conform.violation(
            replaced, "identity", F.col("table"), F.col("table"), F.col("expected_uuid"), F.col("actual_uuid")
        )
    )
    unfit = wanted.select("table", "uri", uri_problem(F.col("uri")).alias("problem")).where("problem is not null")
    if allow_local:
        unfit = unfit.where("problem <> 'local'")
    checks.append(conform.violation(unfit, "uri", F.col("table"), F.col("uri"), F.lit("durable"), F.col("problem")))
    wanted_schemas = {f"{namespace}.{name}": table_schema(bench, name) for name in sorted(there)}
    checks.append(conform.published_schemas_violations(spark, wanted_schemas))
    live = inventory.current_inventory(publish.read_manifest(spark, namespace))
    listed = wanted.select("table", "uri", F.col("row_count").alias("rows"), "size_bytes")
    diff = inventory.inventory_diff(listed, live.where(F.col("table").isin(names)))
    checks.append(
        conform.violation(diff, "manifest", F.col("table"), F.col("uri"), F.col("expected_rows"), F.col("difference"))
    )
    stored = scan.footers(spark, root).withColumn("uri", F.col("path"))
    parity = verify.stored_parity(wanted, stored).where("finding <> 'ok'")
    checks.append(
        conform.violation(parity, "stored", F.col("table"), F.col("uri"), F.col("size_bytes"), F.col("finding"))
    )
    if full_read:
        decoded = reduce(
            DataFrame.unionByName,
            [verify.full_decode(spark, f"{root}/{name}").withColumn("table", F.lit(name)) for name in names],
        ).checkpoint()
        recorded = succeeded.select("table", "content").distinct()
        other = verify.content_differences(recorded, decoded)
        checks.append(
            conform.violation(other, "content", F.col("table"), F.col("table"), F.col("content"), F.col("found"))
        )
        # Spark writes file paths as URIs here and as plain paths in listings; the file names are unique.
        left = wanted.where("row_count > 0").withColumn("file", F.substring_index("uri", "/", -1))
        right = decoded.withColumn("file", F.substring_index("path", "/", -1)).drop("path")
        read = left.join(right, ["table", "file"], "left").where("not decoded_rows <=> row_count")
        checks.append(
            conform.violation(read, "decode", F.col("table"), F.col("uri"), F.col("row_count"), F.col("decoded_rows"))
        )
    if checksum:
        # Large files have a digest of their ranges' digests; other writers record a plain one of the whole file.
        joined = F.col("md5").contains("-") | (F.col("size_bytes") < files.RANGED_FROM)
        kinds = wanted.select(
            "table", "uri", "size_bytes", F.coalesce("md5", "sha256").alias("digest"),
            F.when(F.col("md5").isNull(), "sha256").when(joined, "composite").otherwise("md5").alias("kind"),
        ).where("digest is not null")
        met = {r["kind"] for r in kinds.select("kind").distinct().collect()}
        for kind in sorted(met):
            recorded = kinds.where(F.col("kind") == kind)
            if kind == "composite":
                read = scan.composite_digests(spark, root)
            else:
                read = files.file_digest(recorded.select(F.col("uri").alias("path"), "size_bytes"), kind)
            found = verify.digest_findings(recorded, read).join(recorded.select("table", "uri"), "uri")
            checks.append(
                conform.violation(
                    found, "checksum", F.col("table"), F.col("uri"), F.col("digest"), F.col("read_digest")
                )
            )
        bare = wanted.where("md5 is null and sha256 is null")
        checks.append(
            conform.violation(
                bare, "no_checksum", F.col("table"), F.col("uri"), F.lit("a checksum"), F.lit("none recorded")
            )
        )
    if sample:
        scanned = verify.sample_scan({name: spark.table(f"{namespace}.{name}") for name in names}).where("not ok")
        checks.append(
            conform.violation(scanned, "sample", F.col("table"), F.col("table"), F.col("rows"), F.col("sampled"))
        )
    if keys:
        checks.append(keysets.tpch_key_violations({name: spark.table(f"{namespace}.{name}") for name in names}))
    # As seen now, in one job: the checks of a union run side by side, and a later look at it reads nothing again.
    return reduce(DataFrame.unionByName, checks).checkpoint()


def run_sql_files(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Plans of caller-supplied query files (``*.sql``, one query each) over the tables as views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    texts = spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.sql$", 1).alias("name"), "value"
    )
    # Query texts, not data: each one becomes a plan on the driver anyway.
    return {r["name"]: spark.sql(r["value"].strip().rstrip(";")) for r in texts.where("name <> ''").collect()}

"""Generate, load and verify as a user runs them, with the failures a run can meet."""

from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from benchloom.operators import outcome, verify
from benchloom.plans import workflow
from benchloom.schemas import benchmark
from benchloom.sinks import publish
from benchloom.sources import files

SF = "0.001"


def statuses(result):
    return {r["table"]: r["status"] for r in result.tables.collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("load"))
    result = workflow.require_loaded(workflow.load(spark, "tpch", SF, ("bench", "one"), folder, run_id="run1", allow_local=True))
    workflow.write_report(result, "tpch", SF, f"{folder}/report")
    return result, folder


def test_load_publishes_everything(spark, loaded):
    result, folder = loaded
    assert set(statuses(result).values()) == {"succeeded"} and len(statuses(result)) == 8
    assert result.namespace == "bench_one" and result.root == f"{folder}/run1"
    assert spark.table("bench_one.orders").count() == 1500
    assert {r["state"] for r in result.files.collect()} == {"registered"}
    found = {r["key"]: r["value"] for r in spark.sql("show tblproperties bench_one.part").collect()}
    assert found["benchloom.run-id"] == "run1" and found["benchloom.scale-factor"] == SF
    manifest = publish.read_manifest(spark, "bench_one")
    assert manifest.select("snapshot_id").distinct().count() == 1
    assert manifest.where("md5 is null or rows is null").isEmpty()


def test_verification_passes(spark, loaded):
    _, folder = loaded
    found = workflow.verify_load(
        spark, f"{folder}/report", f"{folder}/run1", full_read=True, checksum=True, sample=True, require_complete=True,
        allow_local=True,
    )
    assert found.isEmpty()


def test_report_round_trip(spark, loaded):
    result, folder = loaded
    tables = verify.report_tables(verify.read_reports(spark, f"{folder}/report", lines=True))
    listed = verify.report_files(tables)
    assert listed.count() == result.files.count()
    assert verify.report_file_problems(listed).isEmpty()


def test_report_is_complete(spark, loaded):
    result, folder = loaded
    lines = verify.read_reports(spark, f"{folder}/report", lines=True)
    for line in lines.collect():
        assert line.started_at <= line.updated_at == line.finished_at and line.status == "succeeded"
        ((name, facts),) = line.tables.items()
        assert [c.name for c in facts.schema] == spark.table(f"bench_one.{name}").columns
        assert facts.snapshot_id == result.snapshot_id and facts.content
        summary = line.summary.asDict(recursive=True)
        assert sorted(summary.pop("succeeded")) == sorted(benchmark("tpch"))
        totals = result.tables.agg(F.sum("row_count").alias("rows"), F.sum("size_bytes").alias("size")).first()
        assert (summary.pop("generated_rows"), summary.pop("generated_bytes")) == tuple(totals)
        assert set(map(str, summary.values())) == {"[]"}


def test_summary_of_open_tables(spark, loaded, tmp_path):
    result, _ = loaded
    failing = replace(
        result,
        tables=result.tables.withColumn("status", F.expr("case table when 'part' then 'uncertain' when 'region' then 'x' else status end")),
        files=result.files.withColumn("state", F.when(F.col("table") == "part", "commit_unknown").otherwise("uploaded")),
    )
    workflow.write_report(failing, "tpch", SF, str(tmp_path / "r"))
    lines = verify.read_reports(spark, str(tmp_path / "r"), lines=True).collect()
    for line in lines:
        (name,) = line.tables
        s = line.summary
        assert line.status == "failed" and s.uncertain == ["part"] and s.not_loaded == ["region"] and len(s.succeeded) == 6
        assert sorted((t.table, t.status) for t in s.tables_requiring_inspection) == [("part", "uncertain"), ("region", "x")]
        listed = s.uncertain_uploads if name == "part" else s.unregistered_uploads
        other = s.unregistered_uploads if name == "part" else s.uncertain_uploads
        assert {f.table for f in listed} == {name} and other == []
        assert (line.tables[name].snapshot_id is None) == (name in ("part", "region"))


def test_variants_keep_unknown_fields(spark, loaded, tmp_path):
    _, folder = loaded
    ours = verify.variant_tables(verify.read_variants(spark, f"{folder}/report", lines=True))
    fixed = verify.report_files(verify.report_tables(verify.read_reports(spark, f"{folder}/report", lines=True)))
    columns = ["run_id", "table", "uri", "row_count", "size_bytes", "state", "md5"]
    assert verify.variant_files(ours).select(columns).exceptAll(fixed.select(columns)).isEmpty()
    assert verify.variant_files(ours).count() == fixed.count() and verify.unknown_fields(ours).isEmpty()
    (tmp_path / "r.json").write_text(
        '{"run_id": "r", "tables": {"a": {"status": "succeeded", "owner": {"id": 7},\n'
        ' "files": [{"remote_uri": "s3://b/a", "row_count": "many", "zone": "x"}]}, "b": {"status": "failed", "files": 3}}}'
    )
    (tmp_path / "none.json").write_text('{"run_id": "none"}')
    nested = verify.variant_tables(verify.read_variants(spark, str(tmp_path)))
    assert sorted((r.table, r.status) for r in nested.collect()) == [("a", "succeeded"), ("b", "failed")]
    (file,) = verify.variant_files(nested).collect()
    assert file.uri == "s3://b/a" and file.row_count is None and "zone" in str(file.entry.toPython())
    assert [tuple(r) for r in verify.unknown_fields(nested).collect()] == [("r", "a", "owner", "OBJECT<id: BIGINT>")]


def test_key_checks(spark, loaded):
    _, folder = loaded
    found = workflow.verify_load(spark, f"{folder}/report", f"{folder}/run1", allow_local=True, keys=True).collect()
    # Ten suppliers are too few for different offers of every part; nothing else is found.
    assert [(r.check, r.table) for r in found] == [("duplicate_key", "partsupp")]


def test_nested_report(spark, tmp_path):
    """One document with all tables, as other writers save it."""
    (tmp_path / "r.json").write_text(
        '{"report_format_version": 1, "run_id": "r", "command": "load", "benchmark": "tpch", "namespace": ["n"],\n'
        ' "tables": {"region": {"status": "succeeded", "files": [\n'
        '   {"row_count": 5, "size_bytes": 9, "remote_uri": "s3://b/a", "state": "registered"},\n'
        '   {"row_count": 5, "size_bytes": 9, "remote_uri": "s3://b/a", "state": "registered"},\n'
        '   {"row_count": 1, "size_bytes": 2, "remote_uri": "s3://b/c", "state": "commit_unknown"}]},\n'
        '  "nation": {"status": "failed", "files": []}}}'
    )
    (tmp_path / "bad.json").write_text('{"report_format_version": 2, "run_id": "x", "command": "load", "tables": {}}')
    reports = verify.read_reports(spark, str(tmp_path))
    assert [r["run_id"] for r in verify.rejected_reports(reports).collect()] == ["x"]
    listed = verify.report_files(verify.report_tables(reports))
    problems = {r["uri"]: r["problem"] for r in verify.report_file_problems(listed).collect()}
    assert problems == {"s3://b/a": "duplicate", "s3://b/c": "unverified"}


def test_existing_tables_stop_a_load(spark, loaded, tmp_path):
    with pytest.raises(publish.TablesExist):
        workflow.load(spark, "tpch", SF, "bench_one", str(tmp_path), allow_local=True)
    assert list(tmp_path.iterdir()) == []  # nothing was generated


def test_skip_all(spark, loaded, tmp_path):
    result = workflow.load(spark, "tpch", SF, "bench_one", str(tmp_path), on_exists="skip", allow_local=True)
    assert set(statuses(result).values()) == {"skipped"} and result.root is None
    assert list(tmp_path.iterdir()) == []


def test_skip_some(spark, tmp_path):
    spark.sql("create database if not exists some_there")
    spark.sql("create table some_there.region (x int) using parquet")
    result = workflow.require_loaded(
        workflow.load(spark, "tpch", SF, "some_there", str(tmp_path), on_exists="skip", checksum=False, allow_local=True)
    )
    found = statuses(result)
    assert found.pop("region") == "skipped" and set(found.values()) == {"succeeded"}
    assert spark.table("some_there.region").columns == ["x"]
    # The whole dataset is generated and checked all the same, and the totals count it.
    totals = result.tables.agg(F.sum("row_count")).first()[0]
    assert totals == spark.table("some_there.lineitem").count() + 5 + 25 + 10 + 150 + 200 + 800 + 1500


def test_one_failing_table_leaves_the_others(spark, tmp_path, monkeypatch):
    real = publish.create_table

    def failing(spark_, namespace, table, *rest):
        if table == "orders":
            raise RuntimeError("no permission")
        return real(spark_, namespace, table, *rest)

    monkeypatch.setattr(publish, "create_table", failing)
    result = workflow.load(spark, "tpch", SF, "one_fails", str(tmp_path), allow_local=True)
    found = statuses(result)
    assert found.pop("orders") == "failed" and set(found.values()) == {"succeeded"}
    with pytest.raises(workflow.LoadFailed, match="no permission"):
        workflow.require_loaded(result)


def test_lost_answer(spark, tmp_path, monkeypatch):
    """The commit arrived but its answer did not: the files are found again, nothing is appended twice."""
    real = publish.register

    def lossy(*given):
        real(*given)
        raise TimeoutError("answer lost")

    monkeypatch.setattr(publish, "register", lossy)
    result = workflow.load(spark, "tpch", SF, "lost_answer", str(tmp_path), allow_local=True)
    assert set(statuses(result).values()) == {"succeeded"}
    manifest = publish.read_manifest(spark, "lost_answer")
    assert manifest.count() == manifest.select("uri").distinct().count()


def test_lost_commit(spark, tmp_path, monkeypatch):
    def silent(*_):
        raise TimeoutError("no answer")

    monkeypatch.setattr(publish, "register", silent)
    result = workflow.load(spark, "tpch", SF, "lost_commit", str(tmp_path), allow_local=True)
    assert set(statuses(result).values()) == {"uncertain"}
    assert {r["state"] for r in result.files.collect()} == {"commit_unknown"}


def test_refused_commit(spark, tmp_path, monkeypatch):
    def refused(*_):
        spark.sql("create table refused.region (x int) using parquet")  # exists by then

    monkeypatch.setattr(publish, "register", refused)
    result = workflow.load(spark, "tpch", SF, "refused", str(tmp_path), allow_local=True)
    assert set(statuses(result).values()) == {"failed"}
    assert {r["state"] for r in result.files.collect()} == {"uploaded_unregistered"}


def test_unreadable_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workflow, "read_back", lambda *_: (None, None))
    result = workflow.load(spark, "tpch", SF, "unreadable", str(tmp_path), allow_local=True)
    assert set(statuses(result).values()) == {"uncertain"}
    assert {r["state"] for r in result.files.collect()} == {"commit_unknown"}


def test_one_failing_registration(spark, tmp_path, monkeypatch):
    real = publish.register

    def failing(spark_, namespace, table, *rest):
        if table == "orders":
            raise PermissionError("password=hunter2 refused")
        real(spark_, namespace, table, *rest)

    monkeypatch.setattr(publish, "register", failing)
    result = workflow.load(spark, "tpch", SF, "one_refused", str(tmp_path), allow_local=True)
    found = statuses(result)
    assert found.pop("orders") == "failed" and set(found.values()) == {"succeeded"}
    assert "hunter2" not in result.errors["orders"]


def test_interrupted_load_leaves_a_record(spark, tmp_path, monkeypatch):
    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(workflow, "read_back", killed)
    with pytest.raises(KeyboardInterrupt):
        workflow.load(spark, "tpch", SF, "killed", str(tmp_path), run_id="k", allow_local=True)
    left = workflow.read_record(spark, f"{tmp_path}/k")
    assert {r["status"] for r in left.collect()} == {"uncertain"}
    assert outcome.needs_inspection(left).count() == 8


def test_registering_twice_is_an_error(spark, loaded):
    rows = publish.read_manifest(spark, "bench_one").where("`table` = 'part'")
    with pytest.raises(AnalysisException) as error:
        publish.register(spark, "bench_one", "part", "run1", rows)
    assert outcome.error_class(error.value) == "commit_conflict"
    publish.register(spark, "bench_one", "other", "run2", rows)  # another run beside it
    assert publish.read_manifest(spark, "bench_one").where("run_id = 'run2'").count() == rows.where("run_id = 'run1'").count()


def test_leftover_registrations_stop_a_table(spark, tmp_path):
    spark.sql("create database if not exists leftover")
    publish.ensure_manifest(spark, "leftover")
    rows = spark.createDataFrame([(1, "s3://b/k", 1, 1, None, "data", "nation", "old")], publish.MANIFEST_SCHEMA)
    publish.register(spark, "leftover", "nation", "old", rows)
    found = statuses(workflow.load(spark, "tpch", SF, "leftover", str(tmp_path), allow_local=True))
    assert found.pop("nation") == "failed" and set(found.values()) == {"succeeded"}


def test_locations_must_be_durable(spark, tmp_path):
    with pytest.raises(ValueError, match="local"):
        workflow.load(spark, "tpch", SF, "nowhere_at_all", str(tmp_path))
    with pytest.raises(ValueError, match="unstable"):
        workflow.load(spark, "tpch", SF, "nowhere_at_all", "s3://bucket/a?x=1", allow_local=True)


def test_report_of_two_runs_is_refused(spark, loaded, tmp_path):
    result, folder = loaded
    workflow.write_report(result, "tpch", SF, f"{tmp_path}/a")
    result.namespace, kept = "elsewhere", result.namespace
    try:
        workflow.write_report(result, "tpch", SF, f"{tmp_path}/b")
    finally:
        result.namespace = kept
    with pytest.raises(ValueError, match="one run"):
        workflow.verify_load(spark, f"{tmp_path}/*", f"{folder}/run1", allow_local=True)


def test_checksums_by_what_is_recorded(spark, loaded, tmp_path):
    import hashlib
    import json

    _, folder = loaded
    lines = [line.value for line in spark.read.text(f"{folder}/report").collect()]
    reports = [json.loads(line) for line in lines]
    for report in reports:
        for table, facts in report["tables"].items():
            for file in facts["files"]:
                md5 = file.pop("md5")
                if table == "part":
                    with open(file["remote_uri"].removeprefix("file:"), "rb") as data:
                        file["sha256"] = hashlib.sha256(data.read()).hexdigest()
                elif table == "nation":
                    file["sha256"] = "0" * 64
                elif table != "region":
                    file["md5"] = md5
    (tmp_path / "report.json").write_text("\n".join(map(json.dumps, reports)))
    found = workflow.verify_load(spark, f"{tmp_path}/report.json", f"{folder}/run1", checksum=True, allow_local=True)
    assert {(r["check"], r["table"]) for r in found.collect()} == {("no_checksum", "region"), ("checksum", "nation")}


def test_gate_blocks_a_bad_dataset(spark, tmp_path):
    workflow.generate(spark, "tpch", SF, str(tmp_path / "d"))
    file = next((tmp_path / "d" / "region").glob("part-*.parquet"))
    pq.write_table(pq.read_table(file).slice(0, 4), file)
    dataset = workflow.inspect(spark, "tpch", SF, str(tmp_path / "d"))
    with pytest.raises(workflow.DatasetInvalid) as error:
        workflow.require_valid(dataset)
    assert error.value.findings == {"row_count": 1}


def test_tampering_is_found(spark, tmp_path):
    result = workflow.load(spark, "tpch", SF, "tampered", str(tmp_path), run_id="r", allow_local=True)
    workflow.write_report(result, "tpch", SF, str(tmp_path / "report"))
    file = next((tmp_path / "r" / "nation").glob("part-*.parquet"))
    pq.write_table(pq.read_table(file).slice(0, 20), file)
    next((tmp_path / "r" / "customer").glob("part-*.parquet")).unlink()
    spark.sql("drop table tampered.part")
    found = workflow.verify_load(spark, str(tmp_path / "report"), str(tmp_path / "r"), allow_local=True).collect()
    assert {(r["check"], r["table"]) for r in found} >= {("stored", "nation"), ("stored", "customer")}


def test_replaced_table_is_found(spark, tmp_path):
    result = workflow.load(spark, "tpch", SF, "replaced", str(tmp_path), run_id="r", allow_local=True)
    workflow.write_report(result, "tpch", SF, str(tmp_path / "report"))
    schema = spark.table("replaced.part").schema
    spark.sql("drop table replaced.part")
    publish.create_table(spark, "replaced", "part", schema, f"{tmp_path}/r/part", {})
    found = workflow.verify_load(spark, str(tmp_path / "report"), str(tmp_path / "r"), allow_local=True).collect()
    assert [(r["check"], r["table"]) for r in found] == [("identity", "part")]


def test_tpcds_load_and_query_files(spark, tmp_path):
    result = workflow.require_loaded(workflow.load(spark, "tpcds", SF, "ds", str(tmp_path / "data"), allow_local=True))
    assert len(statuses(result)) == 24
    (tmp_path / "sql").mkdir()
    (tmp_path / "sql" / "q1.sql").write_text(
        "select d_year, sum(ss_net_paid) as paid from store_sales join date_dim on ss_sold_date_sk = d_date_sk\n"
        "group by d_year;\n"
    )
    direct = {n: spark.read.parquet(f"{result.root}/{n}") for n in statuses(result)}
    published = {n: spark.table(f"ds.{n}") for n in statuses(result)}
    left = workflow.run_sql_files(spark, str(tmp_path / "sql"), published)["q1"]
    rows = left.collect()
    right = workflow.run_sql_files(spark, str(tmp_path / "sql"), direct)["q1"]
    assert len(rows) >= 5
    assert verify.result_parity(left, right).isEmpty()


def test_parity_finds_differences(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "x int, y string")
    found = {(r["x"], r["side"], r["copies"]) for r in verify.result_parity(left, right).collect()}
    assert found == {(1, "left", 1), (3, "right", 1)}


def test_existing_is_empty_without_namespace(spark):
    assert publish.existing_tables(spark, "nowhere", ["region"]) == []


def test_size_check_uses_the_listing(spark, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"1234")
    before = files.list_parts(spark, str(tmp_path)).cache()
    before.count()
    (tmp_path / "a.parquet").write_bytes(b"12345")
    from benchloom.operators.inventory import size_changes

    row = size_changes(before, files.list_parts(spark, str(tmp_path))).first()
    assert (row["size_before"], row["size_after"]) == (4, 5)
    before.unpersist()


def test_changed_content_is_found(spark, tmp_path):
    """Rows, sizes and names may all be right: the sums of the rows tell."""
    result = workflow.require_loaded(workflow.load(spark, "tpch", SF, "content", str(tmp_path), run_id="r", allow_local=True))
    workflow.write_report(result, "tpch", SF, f"{tmp_path}/report")
    tables = verify.report_tables(verify.read_reports(spark, f"{tmp_path}/report", lines=True))
    assert tables.where("content is null").isEmpty()

    def content_findings():
        found = workflow.verify_load(spark, f"{tmp_path}/report", f"{tmp_path}/r", full_read=True, allow_local=True)
        return {r["table"] for r in found.where("check = 'content'").collect()}

    assert content_findings() == set()
    part = next((tmp_path / "r" / "nation").glob("*.parquet"))
    table = pq.read_table(part)
    keys = table["n_regionkey"].to_pylist()
    keys[0] += 1
    pq.write_table(table.set_column(2, "n_regionkey", [keys]).cast(table.schema), part)
    (part.parent / f".{part.name}.crc").unlink()
    spark.catalog.clearCache()
    assert content_findings() == {"nation"}


def test_rows_are_counted_while_written(spark, tmp_path):
    seen = workflow.write_dataset(spark, "tpcds", "0.001", str(tmp_path))
    found = {r["table"]: r for r in seen.collect()}
    for name in ("store_sales", "date_dim", "reason"):
        again = spark.read.parquet(f"{tmp_path}/{name}")
        assert again.count() == found[name]["rows"]
        content = again.agg(*verify.content_sums(again)).select(verify.content_text(*verify.SUMS)).first()[0]
        assert content == found[name]["content"]


def test_tables_have_pools_and_can_be_cut_off(spark):
    import time

    pools = {}

    def work(name):
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        seconds = {"slow": 25, "fast": 1}[name]
        spark.range(0, 1, 1, 1).selectExpr(f"java_method('java.lang.Thread', 'sleep', id + {seconds}000L)").collect()

    started = time.time()
    failed = workflow.for_each_table(spark, ["slow", "fast"], work, seconds=6)
    assert set(failed) == {"slow"} and time.time() - started < 20
    assert pools == {"slow": "benchloom-slow", "fast": "benchloom-fast"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None and not spark.sparkContext.getJobTags()

import pytest

from benchloom.operators import inventory, outcome

EXPECTED = [("region", "s3://b/a", 5, 100)]
FILE = "table string, uri string, rows bigint, size_bytes bigint"
LIVE = "table string, snapshot_id bigint, uri string, rows bigint, size_bytes bigint"


@pytest.mark.parametrize(
    "actual, verdict",
    [
        ([], "file set"),
        ([("region", None, "s3://b/a", 5, 100)], "snapshot"),
        ([("region", 1, "s3://b/a", 4, 100)], "rows or size"),
        ([("region", 1, "s3://b/a", 5, 99)], "rows or size"),
        ([("region", 1, "s3://b/a", 5, 100), ("region", 1, "s3://b/extra", 1, 10)], "file set"),
        ([("region", 1, "s3://b/a", 5, 100)], "ok"),
    ],
)
def test_verdicts(spark, actual, verdict):
    found = inventory.inventory_verdicts(spark.createDataFrame(EXPECTED, FILE), spark.createDataFrame(actual, LIVE))
    assert [r["verdict"] for r in found.collect()] == [verdict]


def test_empty_file_is_a_file(spark):
    expected = spark.createDataFrame([("region", "s3://b/a", 0, 120)], FILE)
    actual = spark.createDataFrame([("region", 1, "s3://b/a", 0, 120)], LIVE)
    assert inventory.inventory_diff(expected, actual).isEmpty()


def test_current_inventory(spark):
    rows = [
        (1, "r", "region", "u1", 5, 10, "x", "data"),
        (2, "r", "region", "u2", 5, 10, "x", "data"),
        (2, "r", "region", "u3", 5, 10, "x", "data"),
        (2, "r", "region", "u3", 5, 10, "x", "data"),
        (7, "r", "nation", "u4", 5, 10, "x", "position deletes"),
    ]
    manifest = spark.createDataFrame(
        rows, "snapshot_id bigint, run_id string, table string, uri string, rows bigint, size_bytes bigint, md5 string, content string"
    )
    found = {r["uri"]: r["problem"] for r in inventory.current_inventory(manifest).collect()}
    assert found == {"u2": None, "u3": "duplicate uri", "u4": "not a data file"}


@pytest.mark.parametrize(
    "error, visible, readable, verified, status, state",
    [
        (None, True, True, True, "succeeded", "registered"),
        ("timeout", True, True, True, "succeeded", "registered"),
        ("timeout", False, True, False, "uncertain", "commit_unknown"),
        ("forbidden", False, True, False, "failed", "uploaded_unregistered"),
        (None, False, False, False, "uncertain", "commit_unknown"),
        ("forbidden", False, False, False, "uncertain", "commit_unknown"),
        (None, True, True, False, "failed", "registered"),
        ("server_error", True, True, False, "failed", "registered"),
    ],
)
def test_outcomes(spark, error, visible, readable, verified, status, state):
    parts = spark.createDataFrame([("region", "u")], "table string, uri string")
    known = parts if visible else parts.limit(0)
    facts = spark.createDataFrame(
        [("region", error, readable, verified)],
        "table string, error_class string, state_seen boolean, verified boolean",
    )
    assert outcome.classify_parts(parts, known, facts).first()["state"] == state
    assert outcome.classify_tables(parts, known, facts).first()["status"] == status


def test_partly_known_attempt(spark):
    parts = spark.createDataFrame([("t", "a"), ("t", "b")], "table string, uri string")
    facts = spark.createDataFrame(
        [("t", "bad_request", True, False)], "table string, error_class string, state_seen boolean, verified boolean"
    )
    states = {r["uri"]: r["state"] for r in outcome.classify_parts(parts, parts.where("uri = 'a'"), facts).collect()}
    assert states == {"a": "registered", "b": "uploaded_unregistered"}


def test_upload_lists(spark):
    files = spark.createDataFrame(
        [
            ("r", "region", "s3://b/a", "commit_unknown"),
            ("r", "nation", "s3://b/b", "upload_started"),
            ("r", "part", None, "upload_started"),
            ("r", "orders", "s3://b/c", "registered"),
            ("r", "orders", "s3://b/d", "local"),
        ],
        "run_id string, table string, uri string, state string",
    )
    found = {(r["list"], r["uri"]) for r in outcome.upload_candidates(files).collect()}
    assert found == {("uncertain_uploads", "s3://b/a"), ("unregistered_uploads", "s3://b/b")}


def test_interrupt_and_lists(spark):
    tables = spark.createDataFrame(
        [("r", s, s) for s in ("pending", "generated", "creating", "uploading", "committing", "succeeded", "skipped")],
        "run_id string, table string, status string",
    )
    after = {r["table"]: r["status"] for r in outcome.after_interrupt(tables).collect()}
    assert after["committing"] == "uncertain" and after["creating"] == after["uploading"] == "failed"
    assert after["pending"] == "pending"
    lists = {r["table"]: r["list"] for r in outcome.status_lists(outcome.after_interrupt(tables)).collect()}
    assert lists["pending"] == lists["generated"] == "not_loaded" and lists["skipped"] == "skipped"


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 1.0, 1.0, 1.0], [0.5, 0.25, 0.125, 7.0, 7.0], [2.0, 2.0, 2.001, 9.0]])
def test_median(spark, values):
    from statistics import median

    df = spark.createDataFrame([("a", v) for v in values], "run_id string, seconds double")
    row = outcome.median_seconds(df).first()
    assert row["files"] == len(values) and row["median_seconds"] == pytest.approx(median(values), abs=1e-12)


def test_report_gaps(spark):
    found = spark.createDataFrame([("region",), ("extra",)], "table string")
    gaps = inventory.report_gaps(found, "tpch").groupBy("gap").count().collect()
    assert {r["gap"]: r["count"] for r in gaps} == {"missing": 7, "unexpected": 1}


def test_identity(spark):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "table string, table_uuid string")
    new = spark.createDataFrame([("a", "1"), ("b", None)], "table string, table_uuid string")
    assert [r["table"] for r in inventory.replaced_tables(old, new).collect()] == ["b"]

"""Files as a data source: one listing, packed partitions, digests that combine, storage settings."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from benchloom.sources import files, scan


@pytest.fixture
def root(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "big.parquet").write_bytes(bytes(range(256)) * 1000)
    (tmp_path / "none.parquet").write_bytes(b"")
    (tmp_path / "_x.PARQUET").write_bytes(b"xyz")
    (tmp_path / "other.txt").write_bytes(b"x")
    return tmp_path


def test_one_listing_for_a_plan(spark, root, tmp_path_factory, monkeypatch):
    calls = tmp_path_factory.mktemp("calls")
    real = scan.walk

    def counted(place, settings):
        import uuid

        (calls / uuid.uuid4().hex).touch()
        return real(place, settings)

    monkeypatch.setattr(scan, "walk", counted)
    monkeypatch.setattr(scan, "_registered", {})
    for read in scan.READS:
        found = scan.scan(spark, str(root), read).collect()
        assert {r.relative for r in found} == {"a/big.parquet", "none.parquet", "_x.PARQUET"}
        assert len(list(calls.iterdir())) == 1
        next(calls.iterdir()).unlink()
    monkeypatch.undo()
    scan._registered.clear()


def test_each_session_of_an_application_has_the_source(spark, root):
    for session in (spark, spark.newSession(), spark):
        assert scan.footers(session, str(root)).count() == 3


def test_digests_combine(spark, root):
    data = bytes(range(256)) * 1000
    whole = {r.name: r.digest for r in scan.digests(spark, str(root), "sha256").collect()}
    assert whole["big.parquet"] == hashlib.sha256(data).hexdigest()
    found = {r.path.rsplit("/", 1)[1]: r for r in scan.composite_digests(spark, str(root), 100_000, 200_000).collect()}
    parts = [hashlib.md5(data[i : i + 100_000]).digest() for i in range(0, len(data), 100_000)]
    assert found["big.parquet"].digest == hashlib.md5(b"".join(parts)).hexdigest() + "-3"
    assert (found["big.parquet"].parts, found["big.parquet"].read_bytes) == (3, len(data))
    assert found["_x.PARQUET"].digest == hashlib.md5(b"xyz").hexdigest()
    assert found["none.parquet"].digest == hashlib.md5(b"").hexdigest()
    # Below the size from which files are read in ranges a file has its plain digest.
    plain = scan.composite_digests(spark, str(root)).where(F.col("path").endswith("big.parquet")).first()
    assert plain.digest == hashlib.md5(data).hexdigest()


def test_ranges_are_those_of_the_older_reader(spark, root):
    old = files.range_digests(files.list_parts(spark, str(root)), 100_000, 1).withColumnRenamed("md5", "digest")
    new = scan.ranges(spark, str(root), 100_000, 1).where("length > 0").select(*old.columns)
    assert sorted(map(tuple, old.collect())) == sorted(map(tuple, new.collect()))


def test_footers_and_broken_files(spark, root):
    spark.range(7).coalesce(1).write.parquet(str(root / "good"))
    found = {r.relative: r for r in scan.footers(spark, str(root)).collect()}
    assert found["none.parquet"].error and found["none.parquet"].rows is None
    assert [r.rows for path, r in found.items() if path.startswith("good/")] == [7]


def test_packs_follow_the_bytes():
    packs = scan.packed(list(range(6)), [5, 5, 5, 20, 1, 1], 10)
    assert [p.items for p in packs] == [[0, 1], [2], [3], [4, 5]]
    assert [p.items for p in scan.packed([], [], 10)] == [[]]


def test_links_and_second_names_are_refused(spark, root):
    os.link(root / "a" / "big.parquet", root / "outside.bin")  # a second name that is no part
    assert scan.scan(spark, str(root), "listing").count() == 3
    os.link(root / "a" / "big.parquet", root / "a" / "again.parquet")
    with pytest.raises(Exception, match="second name"):
        scan.footers(spark, str(root)).collect()
    with pytest.raises(Exception, match="FileNotFoundError"):
        scan.footers(spark, str(root / "nowhere")).collect()


def test_links_are_refused(spark, root):
    (root / "b.parquet").symlink_to(root / "a" / "big.parquet")
    with pytest.raises(Exception, match="is a link"):
        scan.scan(spark, str(root), "listing").collect()


def test_storage_settings(spark):
    settings = {
        "fs.s3a.access.key": "all", "fs.s3a.secret.key": "s", "fs.s3a.endpoint": "http://store:9000",
        "fs.s3a.bucket.mine.access.key": "own", "fs.s3a.bucket.mine.secret.key": "t", "fs.s3a.bucket.mine.endpoint.region": "r",
        "fs.azure.account.key.acc.dfs.core.windows.net": "k",
    }
    assert scan.s3_arguments("mine", settings) == {
        "access_key": "own", "secret_key": "t", "region": "r", "endpoint_override": "store:9000", "scheme": "http"
    }
    assert scan.s3_arguments("other", settings)["access_key"] == "all"
    assert scan.s3_arguments("other", {"fs.s3a.endpoint": "store"}) == {"endpoint_override": "store", "scheme": "https"}
    assert scan.azure_arguments("acc.dfs.core.windows.net", settings) == {"account_name": "acc", "account_key": "k"}
    assert scan.full_path("abfss://c@acc/x/", "c/x", None, "c/x/y.parquet") == "abfss://c@acc/x/y.parquet"
    # Settings do not show in plans.
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.secret.key", "HIDDEN")
    try:
        plan = scan.scan(spark, "/root/testdata/sf0.001", "listing")
        assert plan.count() > 0 and "HIDDEN" not in plan._jdf.queryExecution().toString()
    finally:
        conf.unset("fs.s3a.secret.key")

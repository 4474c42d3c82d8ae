from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from benchloom.catalogue import run
from benchloom.operators import conform

KINDS = [
    ("int", "I", True),
    ("bigint", "I", True),
    ("int", "L", False),
    ("bigint", "L", True),
    ("string", "S", True),
    ("date", "D", True),
    ("date64[ms]", "D", False),
    ("double", "D15_2", False),
    ("decimal(15,2)", "D15_2", True),
    ("decimal(18,2)", "D15_2", False),
    ("decimal(15,3)", "D15_2", False),
]


def test_kind_matrix(spark):
    df = spark.createDataFrame(KINDS, "type string, kind string, ok boolean")
    assert df.where(conform.kind_matches(F.col("type"), F.col("kind")) != F.col("ok")).isEmpty()


def test_unknown_kind_is_an_error(spark):
    df = spark.createDataFrame([("int", "Q")], "type string, kind string")
    with pytest.raises(Exception, match="unknown kind"):
        df.select(conform.kind_matches(F.col("type"), F.col("kind"))).collect()


def footers_with_an_unknown_column(spark):
    """A file of another table, found as a shard of "part", and one of the table itself with a wrong type."""
    shape = (
        "table string, candidates int, path string, relative string, size_bytes bigint, rows bigint, row_groups int, "
        "columns array<struct<name:string,type:string,nullable:boolean,field_id:int>>, error string"
    )
    other = [("doc_id", "bigint", True, None), ("p_name", "bigint", True, None)]
    own = [("p_partkey", "bigint", True, None), ("p_retailprice", "double", True, None)]
    files = [("documents.parquet/part-0000.parquet", other), ("part.parquet", own)]
    rows = [("part", 1, f"file:/d/{name}", name, 1, 1, 1, columns, None) for name, columns in files]
    return spark.createDataFrame(rows, shape)


def test_unknown_columns_have_no_kind(spark):
    found = conform.kind_violations(footers_with_an_unknown_column(spark), "tpch").collect()
    assert sorted((r["subject"].rpartition("/")[2], r["expected"], r["actual"]) for r in found) == [
        ("part-0000.parquet#p_name", "S", "bigint"),
        ("part.parquet#p_retailprice", "D15_2", "double"),
    ]


def test_gate_with_unknown_columns(spark):
    footers = footers_with_an_unknown_column(spark)
    none = footers.limit(0)
    found = conform.gate(
        conform.dataset_violations(
            footers, footers, "tpch", Decimal("0.01"), none.select("table"), none.selectExpr("path", "1 as listed")
        )
    )
    counts = {r["check"]: r["findings"] for r in found.collect()}
    assert (counts["column_kind"], counts["column_names"]) == (2, 2)


def test_gate_query_in_each_session_of_an_application(spark, tmp_path):
    (tmp_path / "documents.parquet").mkdir()
    pq.write_table(pa.table({"doc_id": [1, 2], "text": ["a", None]}), tmp_path / "documents.parquet" / "part-0000.parquet")
    pq.write_table(pa.table({"o_orderkey": [1, 2, 3], "o_custkey": ["x", "y", None]}), tmp_path / "orders.parquet")
    wanted = {"missing_table": 6, "column_names": 2, "column_kind": 1, "row_count": 3, "lineitem_bounds": 1}
    for session in (spark, spark.newSession(), spark):
        assert dict(map(tuple, run("dataset_gate", session, str(tmp_path)).collect())) == wanted


def totals(spark, **rows):
    return spark.createDataFrame([(t, n, 1, 1) for t, n in rows.items()], "table string, rows bigint, size_bytes bigint, files bigint")


SF1 = dict(
    region=5, nation=25, supplier=10_000, customer=150_000, part=200_000, partsupp=800_000, orders=1_500_000,
    lineitem=6_001_215,
)
SMALL = dict(region=5, nation=25, supplier=100, customer=1_500, part=2_000, partsupp=8_000, orders=15_000, lineitem=60_000)


@pytest.mark.parametrize(
    "sf, base, change, bad",
    [
        ("1", SF1, {}, []),
        ("1", SF1, {"lineitem": 6_001_214}, ["lineitem"]),
        ("0.01", SMALL, {}, []),
        ("0.01", SMALL, {"lineitem": 15_000}, []),
        ("0.01", SMALL, {"lineitem": 105_000}, []),
        ("0.01", SMALL, {"lineitem": 105_001}, ["lineitem"]),
        ("0.01", SMALL, {"lineitem": 14_999}, ["lineitem"]),
        ("0.01", SMALL, {"part": 2_001}, ["part"]),
    ],
)
def test_counts(spark, sf, base, change, bad):
    found = conform.tpch_count_violations(totals(spark, **{**base, **change}), Decimal(sf))
    assert [r["table"] for r in found.collect()] == bad


def test_partsupp_follows_the_cut_part_count():
    assert conform.tpch_row_rules(Decimal("0.000009"))["partsupp"] == 4
    assert conform.tpch_row_rules(Decimal("0.000009"))["part"] == 1


def test_source_rules(spark):
    sources = spark.createDataFrame([("orders", 15_000), ("part", 1)], "table string, rows bigint")
    found = conform.source_violations(totals(spark, **SMALL), sources).collect()
    assert [(r["table"], r["expected"], r["actual"]) for r in found] == [("part", "1", "2000")]
    assert conform.source_set_violations(sources, "tpch").count() == 6


def test_cast_losses(spark):
    df = spark.sql(
        "select * from values (1, 'a', 1.005d), (2, 'b', 1.25d), (null, null, null) as t(r_regionkey, r_name, r_comment)"
    )
    found = {r["column"]: (r["values"], r["lost"]) for r in conform.cast_losses(df, "tpch", "region").collect()}
    assert found["r_regionkey"] == (2, 0) and found["r_name"] == (2, 0)


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "pk bigint")
    row = conform.fk_orphans({"c": child, "p": parent}, (("c", "fk", "p", "pk"),)).first()
    assert (row["orphan_keys"], row["orphan_rows"]) == (1, 2)


def test_published_schema(spark):
    source = spark.createDataFrame([], "a int, b string")
    spark.createDataFrame([], "a int, b string").createOrReplaceTempView("same_schema")
    assert conform.published_schema_violations(spark, "same_schema", source).isEmpty()
    spark.createDataFrame([], "a bigint, c string").createOrReplaceTempView("other_schema")
    assert conform.published_schema_violations(spark, "other_schema", source).count() == 2


def test_published_partitions(spark):
    spark.sql("create database if not exists parted")
    spark.sql("create table parted.t (a int, b string) using parquet partitioned by (b)")
    source = spark.createDataFrame([], "a int, b string")
    found = conform.published_schema_violations(spark, "parted.t", source).collect()
    assert [r["check"] for r in found] == ["partitioned"]


def test_outcomes_lose_no_table_and_no_file(spark):
    from benchloom.operators import outcome

    parts = spark.createDataFrame([("a", "u1"), ("c", "u3")], "`table` string, uri string")
    known = spark.createDataFrame([("a", "u1")], "`table` string, uri string")
    rows = [("a", None, True, True), ("b", "forbidden", True, False)]
    outcomes = spark.createDataFrame(rows, "`table` string, error_class string, state_seen boolean, verified boolean")
    found = {r["table"]: tuple(r)[1:] for r in outcome.classify_tables(parts, known, outcomes).collect()}
    assert found == {"a": ("succeeded", 1, 1), "b": ("failed", 0, 0)}
    states = {r["uri"]: r["state"] for r in outcome.classify_parts(parts, known, outcomes).collect()}
    assert states == {"u1": "registered", "u3": "commit_unknown"}


def test_foreign_keys_are_not_skipped(spark):
    with pytest.raises(ValueError, match="orders"):
        conform.fk_orphans({"lineitem": spark.range(1)}, (("lineitem", "id", "orders", "id"),))

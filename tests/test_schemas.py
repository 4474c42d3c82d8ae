import pytest
from pyspark.sql import types as T

from benchloom import schemas


def test_totals():
    columns = {b: [k for cols in schemas.benchmark(b).values() for _, k in cols] for b in ("tpch", "tpcds")}
    assert {b: len(schemas.benchmark(b)) for b in columns} == {"tpch": 8, "tpcds": 24}
    count = {b: {k: kinds.count(k) for k in set(kinds)} for b, kinds in columns.items()}
    assert count["tpch"] == {"I": 19, "S": 29, "D15_2": 9, "D": 4}
    assert count["tpcds"] == {"I": 183, "L": 6, "S": 145, "D": 11, "D7_2": 71, "D5_2": 8, "D15_2": 1}


@pytest.mark.parametrize(
    "table, width",
    [("call_center", 31), ("store_sales", 23), ("web_sales", 34), ("date_dim", 28), ("web_returns", 24), ("item", 22)],
)
def test_widths(table, width):
    assert len(schemas.benchmark("tpcds")[table]) == width


def test_spark_types():
    schema = schemas.table_schema("tpch", "lineitem")
    assert schema["l_orderkey"].dataType == T.LongType()
    assert schema["l_tax"].dataType == T.DecimalType(15, 2)
    assert schema["l_shipdate"].dataType == T.DateType()
    assert all(f.nullable for f in schema)
    assert schemas.table_schema("tpcds", "store_sales")["ss_ticket_number"].dataType == T.LongType()


def test_unknown_names():
    with pytest.raises(ValueError):
        schemas.benchmark("tpcx")
    with pytest.raises(ValueError):
        schemas.spark_type("X")


def test_expected_columns(spark):
    assert schemas.expected_columns(spark, "tpcds").count() == 425
    assert schemas.expected_columns(spark, "tpch").where("kind = 'D15_2'").count() == 9

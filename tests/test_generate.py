"""Generated tables: schemas, counts, determinism, keys, layout, and the queries against another engine."""

import re
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from compare import same
from pyspark.sql import functions as F

from benchloom.catalogue.acceptance import COLUMNS, SQL
from benchloom.operators import conform
from benchloom.plans import workflow
from benchloom.plans.tpch import TPCH_QUERIES
from benchloom.schemas import benchmark, table_schema
from benchloom.sinks.publish import write_table
from benchloom.sources import drawing, files, tpcds_data, tpch_data


def test_closed_form_counts():
    assert tpch_data.base_lines(1_500_000) == 5_999_999
    assert tpch_data.row_counts(Decimal(1))["lineitem"] == 6_001_215
    assert tpcds_data.row_counts(Decimal(1))["inventory"] == 11_745_000
    assert tpcds_data.row_counts(Decimal(1))["store_sales"] == 2_880_404


def test_lineitem_at_scale_one(spark):
    """The fixed total of scale 1, counted from the generating plan itself."""
    made = tpch_data.Tpch(spark, 1)
    row = made._orders().agg(F.sum("lines").alias("n"), F.min("lines").alias("low"), F.max("lines").alias("high")).first()
    assert (row["n"], row["low"], row["high"]) == (6_001_215, 1, 7)


@pytest.mark.parametrize("bench", ["tpch", "tpcds"])
def test_schemas_and_determinism(spark, bench):
    small = {"tpch": "0.0007", "tpcds": "0.0005"}[bench]
    one, other = (workflow.generator(spark, bench, small, parts) for parts in (1, 7))
    assert list(sorted(one)) == sorted(benchmark(bench))
    fixed = {"customer_demographics", "date_dim", "time_dim", "inventory"}  # large at any scale
    for name, df in one.items():
        wanted = [(f.name, f.dataType) for f in table_schema(bench, name)]
        assert [(f.name, f.dataType) for f in df.schema] == wanted, name
        if name not in fixed:
            assert df.exceptAll(other[name]).isEmpty() and other[name].exceptAll(df).isEmpty(), name


def test_bad_scale(spark):
    for bench in ("tpch", "tpcds"):
        with pytest.raises(ValueError):
            workflow.generator(spark, bench, 0)
    with pytest.raises(ValueError):
        workflow.generator(spark, "tpcx", 1)


def test_parts_rule(spark):
    assert [drawing.output_parts(Decimal(sf)) for sf in ("0.01", "1", "10", "10.1", "100")] == [1, 1, 1, 2, 10]
    assert drawing.tasks_for(spark, 10, None) == 1
    assert drawing.tasks_for(spark, 10, 3) == 3
    assert drawing.tasks_for(spark, 150_000_000_000, None) == 75_000


def test_orders_need_no_shuffle(spark):
    made = tpch_data.Tpch(spark, 1)
    for df in (made.orders(), made.lineitem(), made.partsupp()):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_generated_code_is_compiled(spark):
    """Methods over 8,000 bytes are interpreted by the JVM; the big tables must stay below."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    plans = [tpch_data.Tpch(spark, 100).lineitem()]
    made = tpcds_data.Tpcds(spark, 100)
    plans += [made.table(f"{c}_{k}") for c in ("store", "catalog", "web") for k in ("sales", "returns")]
    for df in [*plans, made.table("inventory"), made.table("customer")]:
        text = df._jdf.queryExecution().explainString(mode)
        assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000, df.columns[0]


def test_tpcds_keys(spark):
    made = tpcds_data.Tpcds(spark, "0.001")
    tables = made.tables()
    keys = tpcds_data.foreign_keys()
    assert len(keys) > 90
    facts = [k for k in keys if k[0] in ("store_sales", "catalog_returns", "web_sales", "customer", "inventory")]
    assert conform.fk_orphans(tables, facts).where("orphan_rows > 0").isEmpty()
    for name in ("item", "customer", "store", "date_dim", "time_dim"):
        key = benchmark("tpcds")[name][0][0]
        assert tables[name].select(key).distinct().count() == made.rows[name]


def test_tpcds_amounts(spark):
    sales = tpcds_data.Tpcds(spark, "0.001").table("web_sales")
    wrong = sales.where(
        "ws_ext_sales_price <> ws_sales_price * ws_quantity or ws_net_paid <> ws_ext_sales_price - ws_coupon_amt "
        "or ws_net_profit <> ws_net_paid - ws_ext_wholesale_cost or ws_net_paid_inc_tax <> ws_net_paid + ws_ext_tax "
        "or ws_net_paid_inc_ship_tax <> ws_net_paid + ws_ext_ship_cost + ws_ext_tax"
    )
    assert wrong.isEmpty()


def test_row_groups(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 1).withColumn("x", F.xxhash64("id"))
    write_table(rows, str(tmp_path / "ds"), "tpcds")
    layout = files.row_group_layout(files.list_parts(spark, str(tmp_path / "ds"))).orderBy("idx").collect()
    assert [r["rows"] for r in layout] == [122_880, 122_880, 122_880, 31_360]
    file = next((tmp_path / "ds").glob("part-*.parquet"))
    assert pq.read_metadata(file).row_group(0).column(0).compression == "ZSTD"
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(rows, str(tmp_path / "ds"), "tpcds")


# Parameters of the registered SQL -> validation parameters, which the plans have as defaults.
VALIDATION = {
    "q1": {"2001-08-01": "1998-09-02"},
    "q2": {"%ECONOMY": "%BRASS"},
    "q3": {"1998-03-15": "1995-03-15"},
    "q4": {"1998-07-01": "1993-07-01", "1998-10-01": "1993-10-01"},
    "q5": {"1998-01-01": "1995-01-01", "1997-01-01": "1994-01-01"},
    "q6": {"1998-01-01": "1995-01-01", "1997-01-01": "1994-01-01"},
    "q7": {"NATION_6": "FRANCE", "NATION_7": "GERMANY", "1996-01-01": "1995-01-01", "1999-12-31": "1996-12-31"},
    "q8": {
        "NATION_1": "BRAZIL", "'ECONOMY'": "'ECONOMY ANODIZED STEEL'", "1996-01-01": "1995-01-01",
        "1999-12-31": "1996-12-31",
    },
    "q9": {"%red%": "%green%"},
    "q10": {"1997-10-01": "1993-10-01", "1998-01-01": "1994-01-01"},
    "q11": {"NATION_7": "GERMANY", "* 0.001 ": "* 0.0001 "},
    "q12": {"1998-01-01": "1995-01-01", "1997-01-01": "1994-01-01"},
    "q13": {},
    "q14": {"1997-09-01": "1995-09-01", "1997-10-01": "1995-10-01"},
    "q15": {"1997-01-01": "1996-01-01", "1997-04-01": "1996-04-01"},
    "q16": {"Brand#5": "Brand#45", "'MEDIUM%'": "'MEDIUM POLISHED%'"},
    "q17": {"Brand#3": "Brand#23"},
    "q18": {"> 300": "> 250"},  # seven lines hardly ever reach 300 at this scale
    "q19": {"'Brand#1'": "'Brand#12'", "'Brand#2'": "'Brand#23'", "'Brand#3'": "'Brand#34'"},
    "q20": {"'red%'": "'forest%'", "1998-01-01": "1995-01-01", "1997-01-01": "1994-01-01", "NATION_9": "CANADA"},
    "q21": {"NATION_20": "SAUDI ARABIA"},
    "q22": {"2001-07-01": "1900-01-01"},
}
OTHER = {"q18": {"quantity": 250}}


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    """The acceptance set-up: one generated dataset on disk, read by both engines."""
    import duckdb

    root = str(tmp_path_factory.mktemp("acceptance"))
    workflow.generate(spark, "tpch", "0.01", root)
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in benchmark("tpch")}
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW x_{name} AS SELECT * FROM read_parquet('{root}/{name}/*.parquet')")
    return tables, con


@pytest.mark.parametrize("name", list(TPCH_QUERIES))
def test_queries_on_generated_tables(generated, name):
    tables, con = generated
    sql = SQL[name]
    for old, new in VALIDATION[name].items():
        assert old in sql
        sql = sql.replace(old, new)
    types = {"s": ("string", "VARCHAR"), "i": ("bigint", "BIGINT"), "d": ("double", "DOUBLE")}
    shape = [part.split(":") for part in COLUMNS[name].split()]
    found = TPCH_QUERIES[name](tables, **OTHER.get(name, {})).select(*[F.col(c).cast(types[t][0]) for c, t in shape])
    picked = ", ".join(f"CAST({c} AS {types[t][1]})" for c, t in shape)
    wanted = con.execute(f"SELECT {picked} FROM ({sql}) AS q").fetchall()
    assert same([tuple(r) for r in found.collect()], wanted) is None
    if name not in ("q2", "q17", "q19", "q20"):  # very selective at this scale
        assert wanted


def test_tpcds_rows_follow_the_listed_scales():
    rows = {sf: tpcds_data.row_counts(Decimal(sf)) for sf in ("0.01", "1", "10", "100", "500", "1000")}
    assert sum(rows["0.01"].values()) == 278_238  # a thousandth more than the published 277,976, see README
    assert rows["1"]["customer_demographics"] == 1_920_800 and rows["0.01"]["customer_demographics"] == 19_208
    assert (rows["10"]["customer"], rows["100"]["customer"], rows["1000"]["customer"]) == (500_000, 2_000_000, 12_000_000)
    assert (rows["10"]["inventory"], rows["100"]["inventory"], rows["1000"]["inventory"]) == (133_110_000, 399_330_000, 783_000_000)
    assert rows["100"]["item"] < rows["500"]["item"] < rows["1000"]["item"]

"""Checks of a dataset against its benchmark. Every check returns violations in one shape, so the gate is a union."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from benchloom.schemas import benchmark, expected_layouts, table_schema
from benchloom.session import constant_rows

VIOLATION = "check string, table string, subject string, expected string, actual string"

# Rows per unit of scale factor; region and nation do not scale.
TPCH_FIXED = {"region": 5, "nation": 25}
TPCH_PER_SF = {"supplier": 10_000, "customer": 150_000, "part": 200_000, "orders": 1_500_000}
SUPPLIERS_PER_PART = 4
LINEITEM_AT_SF1 = 6_001_215
MOST_LINES_PER_ORDER = 7

# Foreign keys of the TPC-H schema, (child table, child column, parent table, parent column).
TPCH_FOREIGN_KEYS = (
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("partsupp", "ps_partkey", "part", "p_partkey"),
    ("partsupp", "ps_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
)


def violation(df: DataFrame, check: str, table, subject, expected, actual) -> DataFrame:
    def text(value) -> Column:
        return (value if isinstance(value, Column) else F.lit(value)).cast("string")

    return df.select(
        F.lit(check).alias("check"),
        text(table).alias("table"),
        text(subject).alias("subject"),
        text(expected).alias("expected"),
        text(actual).alias("actual"),
    )


def kind_matches(dtype: Column, kind: Column) -> Column:
    """Whether a file column of this type may stand for a benchmark column of this kind; nothing is cast.

    Null without a kind: Spark may ask this before a filter that drops such columns.
    """
    return (
        F.when(kind.isNull(), F.lit(None).cast("boolean"))
        .when(kind == "I", dtype.isin("int", "bigint"))
        .when(kind == "L", dtype == "bigint")
        .when(kind == "S", dtype == "string")
        .when(kind == "D", dtype == "date")
        .when(
            kind.rlike(r"^D\d+_\d+$"),
            dtype == F.regexp_replace(kind, r"^D(\d+)_(\d+)$", r"decimal($1,$2)"),
        )
        .otherwise(F.raise_error(F.concat(F.lit("unknown kind "), kind)).cast("boolean"))
    )


def _with_layout(footers: DataFrame, bench: str) -> DataFrame:
    """Files joined with their table's definition. That side has one row per benchmark table, 8 or 24."""
    layouts = expected_layouts(footers.sparkSession, bench)
    return footers.where("table is not null and error is null").join(F.broadcast(layouts), "table")


def name_violations(footers: DataFrame, bench: str) -> DataFrame:
    """Files whose column names or their order differ from the definition."""
    found = _with_layout(footers, bench).withColumn("found", F.col("columns.name")).where("found <> names")
    return violation(
        found, "column_names", F.col("table"), F.col("path"), F.array_join("names", ","), F.array_join("found", ",")
    )


def kind_violations(footers: DataFrame, bench: str) -> DataFrame:
    """Columns whose type does not fit the kind of the column of that name."""
    cols = (
        _with_layout(footers, bench)
        .select("table", "path", F.map_from_arrays("names", "kinds").alias("kind_of"), F.explode("columns").alias("c"))
        .withColumn("kind", F.col("kind_of")[F.col("c.name")])
        .where("kind is not null")
        .where(~kind_matches(F.col("c.type"), F.col("kind")))
    )
    subject = F.concat_ws("#", "path", "c.name")
    return violation(cols, "column_kind", F.col("table"), subject, F.col("kind"), F.col("c.type"))


def field_id_violations(footers: DataFrame) -> DataFrame:
    """Columns that carry a Parquet field id."""
    cols = footers.select("table", "path", F.explode("columns").alias("c")).where("c.field_id is not null")
    return violation(
        cols, "field_id", F.col("table"), F.concat_ws("#", "path", "c.name"), "none", F.col("c.field_id")
    )


def schema_variants(footers: DataFrame) -> DataFrame:
    """Distinct schemas per table: ``(table, layout, first_path, files)``; two steps, so no group is collected."""
    layout = F.to_json(F.transform("columns", lambda c: F.struct(c["name"], c["type"], c["nullable"])))
    return (
        footers.where("error is null and table is not null")
        .groupBy("table", layout.alias("layout"))
        .agg(F.min("path").alias("first_path"), F.count("*").alias("files"))
    )


def drift_violations(footers: DataFrame) -> DataFrame:
    """Tables whose parts disagree; the first part by path sets the schema, the first other one is named."""
    variants = schema_variants(footers)
    first = variants.groupBy("table").agg(F.min_by("layout", "first_path").alias("canonical"))
    other = (
        variants.join(first, "table")
        .where("layout <> canonical")
        .groupBy("table", "canonical")
        .agg(F.min_by("layout", "first_path").alias("layout"), F.min("first_path").alias("first_path"))
    )
    return violation(other, "schema_drift", F.col("table"), F.col("first_path"), F.col("canonical"), F.col("layout"))


def footer_violations(footers: DataFrame) -> DataFrame:
    """Unreadable footers and negative row counts."""
    bad = footers.where("error is not null or rows < 0")
    return violation(
        bad, "footer", F.col("table"), F.col("path"), "readable", F.coalesce("error", F.col("rows").cast("string"))
    )


def assignment_violations(parts: DataFrame) -> DataFrame:
    """Files that do not name exactly one table."""
    return violation(
        parts.where("table is null"), "assignment", None, F.col("path"), "1 table", F.col("candidates")
    )


def missing_violations(missing: DataFrame) -> DataFrame:
    return violation(missing, "missing_table", F.col("table"), F.col("table"), "at least 1 file", "none")


def duplicate_violations(duplicates: DataFrame) -> DataFrame:
    return violation(duplicates, "duplicate_path", None, F.col("path"), 1, F.col("listed"))


def source_violations(totals: DataFrame, sources: DataFrame) -> DataFrame:
    """Exported rows differ from the rows counted at the source, where such a count exists."""
    joined = totals.join(sources.select("table", F.col("rows").alias("source_rows")), "table").where(
        "rows <> source_rows"
    )
    return violation(joined, "source_rows", F.col("table"), F.col("table"), F.col("source_rows"), F.col("rows"))


def source_set_violations(sources: DataFrame, bench: str) -> DataFrame:
    """The counted source tables must be exactly the benchmark's tables."""
    return set_violations(sources.select("table"), bench, "source_set")


def set_violations(found: DataFrame, bench: str, check: str = "table_set") -> DataFrame:
    """Difference of a set of table names with the benchmark's set: missing and unexpected names."""
    spark = found.sparkSession
    expected = constant_rows(spark, "table string, expected boolean", [(t, True) for t in benchmark(bench)])
    both = found.distinct().withColumn("found", F.lit(True)).join(expected, "table", "full_outer")
    odd = both.where("found is null or expected is null")
    return violation(
        odd,
        check,
        F.col("table"),
        F.col("table"),
        F.when(F.col("expected"), "present").otherwise("absent"),
        F.when(F.col("found"), "present").otherwise("absent"),
    )


def tpch_row_rules(sf: Decimal) -> dict[str, int]:
    """Exact rows per table. Fractions are cut per base table, so partsupp is 4 times the *cut* number of parts."""
    rows = dict(TPCH_FIXED)
    rows.update({table: int(Decimal(per) * sf) for table, per in TPCH_PER_SF.items()})
    rows["partsupp"] = SUPPLIERS_PER_PART * rows["part"]
    if sf == 1:
        rows["lineitem"] = LINEITEM_AT_SF1
    return rows


def tpch_count_violations(totals: DataFrame, sf: Decimal) -> DataFrame:
    """Tables whose row count breaks the rule; a table without files counts as no rows."""
    spark = totals.sparkSession
    rules = constant_rows(spark, "table string, wanted bigint", list(tpch_row_rules(sf).items()))
    joined = rules.join(totals, "table", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    exact = violation(
        joined.where("rows <> wanted"), "row_count", F.col("table"), F.col("table"), F.col("wanted"), F.col("rows")
    )
    if sf == 1:
        return exact
    return exact.unionByName(lineitem_bound_violations(totals))


def tpcds_count_violations(totals: DataFrame, sf: Decimal) -> DataFrame:
    """Tables that have not the rows listed for the scale factor; a table without files counts as no rows."""
    from benchloom.sources.tpcds_data import row_counts

    rules = constant_rows(totals.sparkSession, "table string, wanted bigint", list(row_counts(sf).items()))
    joined = rules.join(totals, "table", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    return violation(
        joined.where("rows <> wanted"), "row_count", F.col("table"), F.col("table"), F.col("wanted"), F.col("rows")
    )


def lineitem_bounds(totals: DataFrame) -> DataFrame:
    """``(orders, lineitem, within)``: every order has between one and seven lines on average."""
    both = totals.agg(
        F.coalesce(F.sum(F.when(F.col("table") == "orders", F.col("rows"))), F.lit(0)).alias("orders"),
        F.coalesce(F.sum(F.when(F.col("table") == "lineitem", F.col("rows"))), F.lit(0)).alias("lineitem"),
    )
    return both.withColumn("within", F.expr(f"lineitem between orders and {MOST_LINES_PER_ORDER} * orders"))


def lineitem_bound_violations(totals: DataFrame) -> DataFrame:
    out = lineitem_bounds(totals).where("not within")
    wanted = F.format_string(f"%d to %d", F.col("orders"), MOST_LINES_PER_ORDER * F.col("orders"))
    return violation(out, "lineitem_bounds", "lineitem", "lineitem", wanted, F.col("lineitem"))


def cast_losses(df: DataFrame, bench: str, table: str) -> DataFrame:
    """Per column, how many values would not survive the benchmark type unchanged: ``(column, kind, values, lost)``.

    One scan and one row of sums for the whole table; the row is turned into one row per column at the end.
    """
    kinds = dict(benchmark(bench)[table])
    target = table_schema(bench, table)
    sums, stacked = [], []
    for field in target.fields:
        if field.name not in df.columns:
            continue
        column = F.col(field.name)
        # try_cast rounds a decimal silently, so the value must also come back equal.
        moved = column.try_cast(field.dataType)
        source = df.schema[field.name].dataType
        lost = column.isNotNull() & (moved.isNull() | (moved.try_cast(source) != column))
        sums += [
            F.count(column).alias(f"v_{field.name}"),
            F.count_if(lost).alias(f"l_{field.name}"),
        ]
        stacked.append(f"'{field.name}', '{kinds[field.name]}', v_{field.name}, l_{field.name}")
    return df.agg(*sums).selectExpr(f"stack({len(stacked)}, {', '.join(stacked)}) as (column, kind, values, lost)")


def fk_orphans(tables: dict[str, DataFrame], keys=TPCH_FOREIGN_KEYS) -> DataFrame:
    """Rows without a parent per foreign key: ``(child, child_column, parent, orphan_keys, orphan_rows)``.

    The child is first reduced to its distinct keys with counts. That step combines before the shuffle,
    so a key that holds a third of the rows travels as one row per task, and the join sees each key once.
    """
    found = []
    for child, child_column, parent, parent_column in keys:
        if absent := {child, parent} - set(tables):
            raise ValueError(f"{child}.{child_column} refers to {parent}, but {', '.join(sorted(absent))} is not given")
        used = (
            tables[child]
            .where(F.col(child_column).isNotNull())
            .groupBy(F.col(child_column).cast("bigint").alias("key"))
            .agg(F.count("*").alias("n"))
        )
        known = tables[parent].select(F.col(parent_column).cast("bigint").alias("key"))
        found.append(
            used.join(known, "key", "left_anti")
            .agg(F.count("*").alias("orphan_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"))
            .select(
                F.lit(child).alias("child"),
                F.lit(child_column).alias("child_column"),
                F.lit(parent).alias("parent"),
                "orphan_keys",
                "orphan_rows",
            )
        )
    return reduce(DataFrame.unionByName, found)


def published_schema_violations(spark: SparkSession, published: str, source: DataFrame) -> DataFrame:
    """Published table against its source: names, order, types, no tightened nullability, no partition columns."""
    return published_schemas_violations(spark, {published: source.schema})


def published_schemas_violations(spark: SparkSession, sources: dict[str, StructType]) -> DataFrame:
    """Published tables, by name, against the schemas of their sources, in one join."""
    shape = "published string, pos int, name string, type string, nullable boolean"

    def rows(schemas):
        return [(t, i, f.name, f.dataType.simpleString(), f.nullable) for t, s in schemas.items() for i, f in enumerate(s.fields)]

    # Schemas are a few hundred fields known to the driver; the comparison itself stays a join.
    left = constant_rows(spark, shape, rows(sources)).alias("s")
    right = constant_rows(spark, shape, rows({name: spark.table(name).schema for name in sources})).alias("p")
    same_place = (F.col("s.published") == F.col("p.published")) & (F.col("s.pos") == F.col("p.pos"))
    joined = left.join(right, same_place, "full_outer")
    differs = (
        ~F.col("s.name").eqNullSafe(F.col("p.name"))
        | ~F.col("s.type").eqNullSafe(F.col("p.type"))
        | (F.col("s.nullable") & ~F.col("p.nullable"))
    )
    shown = [F.concat_ws(" ", f"{a}.name", f"{a}.type", F.col(f"{a}.nullable").cast("string")) for a in "sp"]
    out = violation(
        joined.where(differs),
        "published_schema",
        F.coalesce("s.published", "p.published"),
        F.coalesce("s.name", "p.name"),
        shown[0],
        shown[1],
    )
    parted = [(name, column) for name in sources for column in partition_columns(spark, name)]
    if parted:
        layout = constant_rows(spark, "published string, name string", parted)
        out = out.unionByName(
            violation(layout, "partitioned", F.col("published"), F.col("name"), "unpartitioned", "partition column")
        )
    return out


def partition_columns(spark: SparkSession, published: str) -> list[str]:
    """Names of a table's partition columns, which its description lists last, below a heading."""
    names = [row.col_name for row in spark.sql(f"DESCRIBE TABLE {published}").collect()]
    heading = "# col_name"
    return names[names.index(heading) + 1 :] if heading in names else []


def dataset_violations(
    parts: DataFrame,
    footers: DataFrame,
    bench: str,
    sf: Decimal,
    missing: DataFrame,
    duplicates: DataFrame,
    sources: DataFrame | None = None,
) -> DataFrame:
    """All findings about a dataset. ``parts`` is the assigned listing, ``footers`` the same with footers."""
    from benchloom.sources.files import table_totals

    totals = table_totals(footers)
    checks = [
        assignment_violations(parts),
        missing_violations(missing),
        duplicate_violations(duplicates),
        footer_violations(footers),
        name_violations(footers, bench),
        kind_violations(footers, bench),
        field_id_violations(footers),
        drift_violations(footers),
    ]
    if sources is not None:
        checks.append(source_violations(totals, sources))
    if bench == "tpch":
        checks.append(tpch_count_violations(totals, sf))
    else:
        checks.append(tpcds_count_violations(totals, sf))
        empty = parts.sparkSession.createDataFrame([], "table string")
        checks.append(source_set_violations(sources if sources is not None else empty, bench))
    return reduce(DataFrame.unionByName, checks)


def gate(violations: DataFrame) -> DataFrame:
    """Findings per check; an empty result opens the gate."""
    return violations.groupBy("check").agg(F.count("*").alias("findings"))

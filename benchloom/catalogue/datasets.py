"""Files, conformance and gate queries over a folder of tables."""

from __future__ import annotations

import uuid
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.catalogue.base import ORACLE_DIR, register, table
from benchloom.operators import conform, inventory, keysets
from benchloom.plans.completion import complete_table, derive_partsupp
from benchloom.schemas import benchmark, expected_columns
from benchloom.session import ensure_checkpoint_dir
from benchloom.sinks import publish
from benchloom.sources import files, scan
from benchloom.sources.drawing import count_sources

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
BENCH = [name for name in GIVEN if name in benchmark("tpch")]

# --- SQL over the files themselves ----------------------------------------------------------------

BLOBS = f"read_blob('{ORACLE_DIR}/*.parquet')"
NAMES_SQL = ", ".join(f"'{name}'" for name in benchmark("tpch"))
FILES_SQL = f"SELECT regexp_extract(filename, '[^/]+$') AS name, size FROM {BLOBS}"
ASSIGNED_SQL = f"""
    SELECT name, size, CASE WHEN stem IN ({NAMES_SQL}) THEN stem END AS tbl
    FROM (SELECT name, size, regexp_extract(name, '^(.+?)([._-][0-9]+)*\\.parquet$', 1) AS stem
          FROM ({FILES_SQL}) AS f) AS s"""
FOOTERS_SQL = f"""
    SELECT regexp_extract(file_name, '[^/]+$') AS name, num_rows, num_row_groups, file_size_bytes
    FROM parquet_file_metadata('{ORACLE_DIR}/*.parquet')"""
COLUMNS_SQL = f"""
    SELECT regexp_extract(file_name, '[^/]+$') AS file, name AS col,
           row_number() OVER (PARTITION BY file_name ORDER BY column_id) - 1 AS pos,
           CASE WHEN converted_type = 'LIST' THEN 'list<element: float>'
                WHEN type = 'INT32' AND converted_type IS NULL THEN 'int'
                WHEN type = 'INT64' AND converted_type LIKE 'TIMESTAMP%' THEN 'timestamp_ntz'
                WHEN type = 'INT64' AND converted_type IS NULL THEN 'bigint'
                WHEN converted_type = 'UTF8' THEN 'string'
                ELSE lower(type) END AS dtype,
           repetition_type = 'OPTIONAL' AS nullable
    FROM parquet_schema('{ORACLE_DIR}/*.parquet')
    WHERE name NOT IN ('schema', 'list', 'element')"""
DEFINED_SQL = "(VALUES {}) AS d(tbl, pos, col, kind)".format(
    ", ".join(
        f"('{name}', {pos}, '{column}', '{kind}')"
        for name, columns in benchmark("tpch").items()
        for pos, (column, kind) in enumerate(columns)
    )
)
KIND_FITS_SQL = """(CASE kind WHEN 'I' THEN dtype IN ('int', 'bigint') WHEN 'L' THEN dtype = 'bigint'
    WHEN 'S' THEN dtype = 'string' WHEN 'D' THEN dtype = 'date' ELSE dtype = 'decimal(15,2)' END)"""


def base_name(column: str = "path"):
    return F.substring_index(column, "/", -1)


def assigned(spark: SparkSession, folder: str) -> DataFrame:
    return files.assign_table(files.list_parts(spark, folder), "tpch")


def with_footers(spark: SparkSession, folder: str) -> DataFrame:
    return files.assign_table(scan.footers(spark, folder), "tpch")


def scale_of(spark: SparkSession, folder: str) -> Decimal:
    """Scale factor that the given orders stand for; one number, read from Parquet metadata."""
    rows = files.metadata_count(spark, f"{folder}/orders.parquet").first()["rows"]
    return Decimal(rows) / conform.TPCH_PER_SF["orders"]


# --- discovery and footers ------------------------------------------------------------------------


@register("list_parts", "name:s size_bytes:i", f"SELECT name, size AS size_bytes FROM ({FILES_SQL}) AS f")
def _(spark, folder):
    return files.list_parts(spark, folder)


@register(
    "assign_table",
    "name:s table:s candidates:i",
    f"""SELECT name, coalesce(tbl, '-') AS "table", CASE WHEN tbl IS NULL THEN 0 ELSE 1 END AS candidates
        FROM ({ASSIGNED_SQL}) AS a""",
)
def _(spark, folder):
    return assigned(spark, folder).withColumn("table", F.coalesce("table", F.lit("-")))


@register(
    "assign_paths",
    "doc_id:i table:s candidates:i",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'orders' WHEN 1 THEN 'part' WHEN 2 THEN 'nation' ELSE '-' END AS "table",
              CASE WHEN doc_id % 4 = 3 THEN 0 ELSE 1 END AS candidates
       FROM documents""",
)
def _(spark, folder):
    # Every document stands for a file: in a table's folder, as a named shard, or under no table at all.
    number = F.col("doc_id") % 4
    path = (
        F.when(number == 0, F.concat(F.lit("orders/part-"), "doc_id", F.lit(".parquet")))
        .when(number == 1, F.concat(F.lit("part-"), "doc_id", F.lit(".parquet")))
        .when(number == 2, F.concat("source", F.lit("/nation_"), "doc_id", F.lit(".1.parquet")))
        .otherwise(F.concat("source", F.lit("/customer_copy."), "doc_id", F.lit(".parquet")))
    )
    docs = table(spark, folder, "documents").select("doc_id", path.alias("relative"))
    return files.assign_table(docs, "tpch").withColumn("table", F.coalesce("table", F.lit("-")))


@register(
    "missing_tables",
    "table:s",
    f"""SELECT DISTINCT tbl AS "table" FROM {DEFINED_SQL}
        WHERE tbl NOT IN (SELECT tbl FROM ({ASSIGNED_SQL}) AS a WHERE tbl IS NOT NULL)""",
)
def _(spark, folder):
    return files.missing_tables(assigned(spark, folder), "tpch")


@register(
    "duplicate_parts",
    "path:s listed:i",
    """SELECT 's3://lake/' || l_orderkey || '/' || l_linenumber AS path, count(*) AS listed
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _(spark, folder):
    # A line number that occurs twice in an order would be written to one path twice.
    path = F.concat(F.lit("s3://lake/"), "l_orderkey", F.lit("/"), "l_linenumber")
    return files.duplicate_parts(table(spark, folder, "lineitem").select(path.alias("path")))


@register(
    "equal_content",
    "size_bytes:i md5:s copies:i first_path:s",
    """SELECT octet_length(encode(text)) AS size_bytes, md5(text) AS md5, count(*) AS copies,
              min(lang || '/' || doc_id) AS first_path
       FROM documents WHERE n_chars > 0 GROUP BY text HAVING count(*) > 1""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents").select(
        F.concat_ws("/", "lang", "doc_id").alias("path"),
        F.col("n_chars").alias("rows"),
        F.octet_length("text").alias("size_bytes"),
        F.md5("text").alias("md5"),
    )
    return files.equal_content(docs, "size_bytes", "md5")


@register(
    "footer_stats",
    "name:s rows:i row_groups:i size_bytes:i",
    f"""SELECT name, num_rows AS rows, num_row_groups AS row_groups, file_size_bytes AS size_bytes
        FROM ({FOOTERS_SQL}) AS f""",
)
def _(spark, folder):
    return with_footers(spark, folder)


@register(
    "part_index",
    "table:s path:s part_index:i",
    """SELECT source AS "table", lang || '/' || doc_id AS path,
              row_number() OVER (PARTITION BY source ORDER BY lang || '/' || doc_id) - 1 AS part_index
       FROM documents""",
)
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return files.part_index(docs.select(F.col("source").alias("table"), F.concat_ws("/", "lang", "doc_id").alias("path")))


@register(
    "table_totals",
    "table:s rows:i size_bytes:i files:i",
    f"""SELECT tbl AS "table", sum(num_rows) AS rows, sum(size) AS size_bytes, count(*) AS files
        FROM ({ASSIGNED_SQL}) AS a JOIN ({FOOTERS_SQL}) AS f USING (name) WHERE tbl IS NOT NULL GROUP BY tbl""",
)
def _(spark, folder):
    return files.table_totals(with_footers(spark, folder))


COUNTS_SQL = " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {name}" for name in GIVEN)


@register("metadata_count", "table:s rows:i", COUNTS_SQL)
def _(spark, folder):
    counts = [
        files.metadata_count(spark, f"{folder}/{name}.parquet").select(F.lit(name).alias("table"), "rows")
        for name in GIVEN
    ]
    return reduce(DataFrame.unionByName, counts)


@register(
    "schema_listing",
    "file:s pos:i name:s type:s nullable:b",
    f"SELECT file, pos, col AS name, dtype AS type, nullable FROM ({COLUMNS_SQL}) AS c",
)
def _(spark, folder):
    footers = scan.footers(spark, folder)
    return files.schema_listing(footers).withColumn("file", base_name())


# --- conformance ----------------------------------------------------------------------------------


@register(
    "kind_matrix",
    "file:s name:s kind:s ok:b",
    f"""SELECT file, col AS name, kind, {KIND_FITS_SQL} AS ok FROM ({COLUMNS_SQL}) AS c,
        (SELECT unnest(['I', 'L', 'S', 'D', 'D15_2']) AS kind) AS k""",
)
def _(spark, folder):
    columns = files.schema_listing(scan.footers(spark, folder))
    kinds = F.explode(F.array(*[F.lit(k) for k in ("I", "L", "S", "D", "D15_2")]))
    return (
        columns.withColumn("file", base_name())
        .withColumn("kind", kinds)
        .withColumn("ok", conform.kind_matches(F.col("type"), F.col("kind")))
    )


@register(
    "schema_names",
    "table:s file:s expected:s actual:s",
    f"""SELECT f.tbl AS "table", file, expected, actual
        FROM (SELECT file, replace(file, '.parquet', '') AS tbl, string_agg(col, ',' ORDER BY pos) AS actual
              FROM ({COLUMNS_SQL}) AS c GROUP BY file) AS f
        JOIN (SELECT tbl, string_agg(col, ',' ORDER BY pos) AS expected FROM {DEFINED_SQL} GROUP BY tbl) AS e
          ON e.tbl = f.tbl WHERE expected <> actual""",
)
def _(spark, folder):
    return conform.name_violations(with_footers(spark, folder), "tpch").withColumn("file", base_name("subject"))


@register(
    "schema_violations",
    "table:s subject:s expected:s actual:s",
    f"""SELECT d.tbl AS "table", file || '#' || c.col AS subject, kind AS expected, dtype AS actual
        FROM ({COLUMNS_SQL}) AS c JOIN {DEFINED_SQL} ON d.tbl || '.parquet' = file AND d.col = c.col
        WHERE NOT {KIND_FITS_SQL}""",
)
def _(spark, folder):
    found = conform.kind_violations(with_footers(spark, folder), "tpch")
    return found.withColumn("subject", base_name("subject"))


@register(
    "schema_drift",
    "table:s first_file:s",
    f"""SELECT 'all' AS "table", min(file) AS first_file
        FROM (SELECT file, string_agg(col || ' ' || dtype || nullable, ',' ORDER BY pos) AS layout
              FROM ({COLUMNS_SQL}) AS c GROUP BY file) AS f
        WHERE layout <> (SELECT string_agg(col || ' ' || dtype || nullable, ',' ORDER BY pos)
                         FROM ({COLUMNS_SQL}) AS c
                         WHERE file = (SELECT min(name) FROM ({FILES_SQL}) AS n))""",
)
def _(spark, folder):
    # All files are taken as parts of one table; the first by path sets the schema.
    pool = scan.footers(spark, folder).withColumn("table", F.lit("all"))
    return conform.drift_violations(pool).withColumn("first_file", base_name("subject"))


@register("source_counts", "table:s rows:i", " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {name}" for name in BENCH
))
def _(spark, folder):
    counts = [
        table(spark, folder, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name in BENCH
    ]
    return reduce(DataFrame.unionByName, counts)


KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}
KEY_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS tbl, count(*) AS source_rows FROM (SELECT DISTINCT {', '.join(keys)} FROM {name}) AS k"
    for name, keys in KEYS.items()
)


def key_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct primary keys per table: what a source with enforced keys would hold."""
    counts = [
        table(spark, folder, name).select(*keys).distinct().agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table"), "rows")
        for name, keys in KEYS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@register(
    "source_parity",
    "table:s expected:i actual:i",
    f"""SELECT tbl AS "table", source_rows AS expected, num_rows AS actual
        FROM ({KEY_COUNTS_SQL}) AS k JOIN ({FOOTERS_SQL}) AS f ON f.name = tbl || '.parquet'
        WHERE source_rows <> num_rows""",
)
def _(spark, folder):
    totals = files.table_totals(with_footers(spark, folder))
    return conform.source_violations(totals, key_counts(spark, folder))


@register(
    "table_set_diff",
    "table:s expected:s actual:s",
    f"""SELECT coalesce(d, f) AS "table", CASE WHEN d IS NULL THEN 'absent' ELSE 'present' END AS expected,
               CASE WHEN f IS NULL THEN 'absent' ELSE 'present' END AS actual
        FROM (SELECT DISTINCT tbl AS d FROM {DEFINED_SQL}) AS e
        FULL JOIN (SELECT replace(name, '.parquet', '') AS f FROM ({FILES_SQL}) AS n) AS g ON d = f
        WHERE d IS NULL OR f IS NULL""",
)
def _(spark, folder):
    names = files.list_parts(spark, folder).select(F.regexp_replace("name", r"\.parquet$", "").alias("table"))
    return conform.set_violations(names, "tpch")


def _losses_sql() -> str:
    casts = {"D": "DATE", "D15_2": "DECIMAL(15,2)", "I": "BIGINT", "S": "VARCHAR"}
    rows = []
    given = {
        "region": "r_regionkey r_name",
        "nation": "n_nationkey n_name n_regionkey",
        "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
        "supplier": "s_suppkey s_name s_nationkey s_acctbal",
        "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
        "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
        "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate",
    }
    for name, columns in given.items():
        kinds = dict(benchmark("tpch")[name])
        for column in columns.split():
            moved = f"TRY_CAST({column} AS {casts[kinds[column]]})"
            rows.append(
                f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", '{kinds[column]}' AS kind, "
                f"count({column}) AS \"values\", count(*) FILTER ({column} IS NOT NULL AND "
                f"({moved} IS NULL OR {moved} <> {column})) AS lost FROM {name}"
            )
    return " UNION ALL ".join(rows)


@register("cast_violations", "table:s column:s kind:s values:i lost:i", _losses_sql())
def _(spark, folder):
    checks = [
        conform.cast_losses(table(spark, folder, name), "tpch", name).withColumn("table", F.lit(name))
        for name in BENCH
    ]
    return reduce(DataFrame.unionByName, checks)


@register(
    "cast_violations_events",
    "column:s kind:s values:i lost:i",
    """SELECT 'o_orderkey' AS "column", 'I' AS kind, count(event_id) AS "values", 0 AS lost FROM events
       UNION ALL SELECT 'o_custkey', 'I', count(event_type), count(*) FILTER (TRY_CAST(event_type AS BIGINT) IS NULL)
       FROM events
       UNION ALL SELECT 'o_totalprice', 'D15_2', count(value),
                 count(*) FILTER (CAST(value / 4 AS DECIMAL(15,2)) <> value / 4) FROM events
       UNION ALL SELECT 'o_orderdate', 'D', count(ts), count(*) FILTER (CAST(ts AS DATE) <> ts) FROM events""",
)
def _(spark, folder):
    # Events as candidate orders: times of day, quarter cents and words do not fit the benchmark types.
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("o_orderkey"),
        F.col("event_type").alias("o_custkey"),
        (F.col("value") / 4).alias("o_totalprice"),
        F.col("ts").alias("o_orderdate"),
    )
    return conform.cast_losses(events, "tpch", "orders")


SCALE_SQL = "(SELECT count(*) FROM orders)"
RULES_SQL = f"""
    SELECT 'region' AS tbl, 5 AS wanted UNION ALL SELECT 'nation', 25
    UNION ALL SELECT 'supplier', 10000 * {SCALE_SQL} // 1500000
    UNION ALL SELECT 'customer', 150000 * {SCALE_SQL} // 1500000
    UNION ALL SELECT 'part', 200000 * {SCALE_SQL} // 1500000
    UNION ALL SELECT 'partsupp', 4 * (200000 * {SCALE_SQL} // 1500000)
    UNION ALL SELECT 'orders', {SCALE_SQL}"""
BROKEN_RULES_SQL = f"""
    SELECT r.tbl, wanted, coalesce(num_rows, 0) AS num_rows
    FROM ({RULES_SQL}) AS r LEFT JOIN ({FOOTERS_SQL}) AS f ON f.name = r.tbl || '.parquet'
    WHERE wanted <> coalesce(num_rows, 0)"""


@register(
    "tpch_counts",
    "table:s expected:s actual:s",
    f"""SELECT tbl AS "table", wanted AS expected, num_rows AS actual FROM ({BROKEN_RULES_SQL}) AS b
        UNION ALL SELECT 'lineitem', o || ' to ' || 7 * o, l
        FROM (SELECT {SCALE_SQL} AS o, (SELECT count(*) FROM lineitem) AS l) AS c WHERE NOT l BETWEEN o AND 7 * o""",
)
def _(spark, folder):
    totals = files.table_totals(with_footers(spark, folder))
    return conform.tpch_count_violations(totals, scale_of(spark, folder))


@register(
    "lineitem_bounds",
    "orders:i lineitem:i within:b",
    """SELECT o AS orders, l AS lineitem, l BETWEEN o AND 7 * o AS within
       FROM (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l) AS c""",
)
def _(spark, folder):
    return conform.lineitem_bounds(files.table_totals(with_footers(spark, folder)))


@register(
    "dataset_gate",
    "check:s findings:i",
    f"""SELECT * FROM (
          SELECT 'assignment' AS "check", count(*) AS findings FROM ({ASSIGNED_SQL}) AS a WHERE tbl IS NULL
          UNION ALL SELECT 'missing_table', count(DISTINCT tbl) FROM {DEFINED_SQL}
            WHERE tbl NOT IN (SELECT tbl FROM ({ASSIGNED_SQL}) AS a WHERE tbl IS NOT NULL)
          UNION ALL SELECT 'column_names', count(*)
            FROM (SELECT replace(file, '.parquet', '') AS tbl, string_agg(col, ',' ORDER BY pos) AS actual
                  FROM ({COLUMNS_SQL}) AS c GROUP BY file) AS f
            JOIN (SELECT tbl, string_agg(col, ',' ORDER BY pos) AS expected FROM {DEFINED_SQL} GROUP BY tbl) AS e
              ON e.tbl = f.tbl WHERE expected <> actual
          UNION ALL SELECT 'column_kind', count(*)
            FROM ({COLUMNS_SQL}) AS c JOIN {DEFINED_SQL} ON d.tbl || '.parquet' = file AND d.col = c.col
            WHERE NOT {KIND_FITS_SQL}
          UNION ALL SELECT 'row_count', count(*) FROM ({BROKEN_RULES_SQL}) AS b
        ) AS g WHERE findings > 0""",
)
def _(spark, folder):
    # Many checks share the listing and the footers, so both are read once.
    ensure_checkpoint_dir(spark)
    parts = with_footers(spark, folder).checkpoint()
    found = conform.dataset_violations(
        parts,
        parts,
        "tpch",
        scale_of(spark, folder),
        files.missing_tables(parts, "tpch"),
        files.duplicate_parts(parts),
    )
    return conform.gate(found)


@register(
    "published_schema",
    "subject:s expected:s actual:s",
    f"""SELECT coalesce(p.col, s.col) AS subject,
               CASE WHEN p.col IS NULL THEN '' ELSE p.col || ' ' || p.dtype || ' true' END AS expected,
               CASE WHEN s.col IS NULL THEN '' ELSE s.col || ' ' || s.dtype || ' true' END AS actual
        FROM (SELECT pos, col, dtype FROM ({COLUMNS_SQL}) AS c WHERE file = 'lineitem.parquet') AS s
        FULL JOIN (SELECT pos, col, CASE WHEN col = 'l_linenumber' THEN 'int' ELSE
                          CASE kind WHEN 'I' THEN 'bigint' WHEN 'S' THEN 'string' WHEN 'D' THEN 'date'
                               ELSE 'decimal(15,2)' END END AS dtype
                   FROM {DEFINED_SQL} WHERE tbl = 'lineitem') AS p ON s.pos = p.pos
        WHERE s.col IS DISTINCT FROM p.col OR s.dtype IS DISTINCT FROM p.dtype""",
)
def _(spark, folder):
    # A catalog table over the given lineitem, against the complete one.
    given, name = table(spark, folder, "lineitem"), f"given_lineitem_{uuid.uuid4().hex}"
    publish.create_table(spark, "default", name, given.schema, f"{folder}/lineitem.parquet", {})
    return conform.published_schema_violations(spark, f"default.{name}", complete_table("lineitem", given))


@register(
    "expected_columns",
    "table:s name:s kind:s given_type:s fits:b",
    f"""SELECT tbl AS "table", d.col AS name, kind, coalesce(dtype, '-') AS given_type,
               coalesce({KIND_FITS_SQL}, false) AS fits
        FROM {DEFINED_SQL} LEFT JOIN ({COLUMNS_SQL}) AS c ON d.tbl || '.parquet' = file AND d.col = c.col""",
)
def _(spark, folder):
    # Every defined column with the type that the given file of its table has for it.
    footers = with_footers(spark, folder).where("table is not null")
    given = footers.select("table", F.explode("columns").alias("c")).select(
        "table", F.col("c.name").alias("name"), F.col("c.type").alias("given_type")
    )
    joined = expected_columns(spark, "tpch").join(given, ["table", "name"], "left")
    fits = F.coalesce(conform.kind_matches(F.col("given_type"), F.col("kind")), F.lit(False))
    return joined.select("table", "name", "kind", F.coalesce("given_type", F.lit("-")).alias("given_type"), fits.alias("fits"))


@register(
    "source_set",
    "table:s expected:s actual:s",
    "SELECT coalesce(t, g) AS \"table\", CASE WHEN g IS NULL THEN 'present' ELSE 'absent' END AS expected, "
    "CASE WHEN g IS NULL THEN 'absent' ELSE 'present' END AS actual FROM (VALUES {}) AS d(t) FULL JOIN (VALUES {}) AS v(g) "
    "ON t = g WHERE t IS NULL OR g IS NULL".format(
        ", ".join(f"('{t}')" for t in benchmark("tpcds")), ", ".join(f"('{t}')" for t in GIVEN)
    ),
)
def _(spark, folder):
    # The given tables, counted, against those of TPC-DS.
    counted = count_sources({name: table(spark, folder, name) for name in GIVEN})
    return conform.source_set_violations(counted, "tpcds").select("table", "expected", "actual")


ORPHAN_KEYS = conform.TPCH_FOREIGN_KEYS + (
    ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("events", "user_id", "customer", "c_custkey"),
    ("customer", "c_custkey", "events", "user_id"),
)
OFFERS_SQL = (
    "(SELECT p_partkey AS ps_partkey, (p_partkey + i * (n // 4 + p_partkey // n)) % n AS ps_suppkey "
    "FROM part, (SELECT count(*) AS n FROM supplier) AS c, (SELECT unnest([0, 1, 2, 3]) AS i) AS x) AS partsupp"
)


def _orphans_sql() -> str:
    rows = []
    for child, column, parent, key in ORPHAN_KEYS:
        source = OFFERS_SQL if child == "partsupp" else child
        rows.append(
            f"SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, "
            f"count(DISTINCT {column}) AS orphan_keys, count(*) AS orphan_rows FROM {source} "
            f"WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
        )
    return " UNION ALL ".join(rows)


@register("fk_orphans", "child:s child_column:s parent:s orphan_keys:i orphan_rows:i", _orphans_sql())
def _(spark, folder):
    tables = {name: table(spark, folder, name) for name in BENCH + ["labels", "documents", "events"]}
    tables["partsupp"] = derive_partsupp(tables["part"], tables["supplier"])
    return conform.fk_orphans(tables, ORPHAN_KEYS)


# Keys of the given tables, by table, as names and expressions.
GIVEN_KEYS = {
    "customer": {"c_custkey": "c_custkey"},
    "supplier": {"s_suppkey": "s_suppkey"},
    "part": {"p_partkey": "p_partkey"},
    "orders": {"o_orderkey": "o_orderkey", "o_custkey": "o_custkey"},
    "lineitem": {
        "l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey",
        "l_orderkey,l_linenumber": "l_orderkey * 8 + l_linenumber",
    },
    "documents": {"doc_id": "doc_id"},
    "labels": {"doc_id": "doc_id"},
    "events": {"event_id": "event_id", "user_id": "user_id"},
    "pages": {"page_id": "page_id"},
}
GIVEN_LINKS = tuple(
    link for link in ORPHAN_KEYS if link[1] in GIVEN_KEYS.get(link[0], {}) and link[3] in GIVEN_KEYS.get(link[2], {})
)


@register(
    "key_bitmaps",
    "table:s key:s rows:i null_rows:i distinct_keys:i duplicate_rows:i",
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", '{key}' AS key, count(*) AS rows, count(*) - count({expr}) AS null_rows, "
        f"count(DISTINCT {expr}) AS distinct_keys, count({expr}) - count(DISTINCT {expr}) AS duplicate_rows FROM {name}"
        for name, keys in GIVEN_KEYS.items()
        for key, expr in keys.items()
    ),
)
def _(spark, folder):
    return keysets.key_facts(keysets.table_key_sets({name: table(spark, folder, name) for name in GIVEN_KEYS}, GIVEN_KEYS))


@register(
    "key_bitmap_orphans",
    "child:s child_column:s parent:s orphan_keys:i",
    " UNION ALL ".join(
        f"SELECT '{child}' AS child, '{column}' AS child_column, '{parent}' AS parent, count(DISTINCT {column}) AS orphan_keys "
        f"FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
        for child, column, parent, key in GIVEN_LINKS
    ),
)
def _(spark, folder):
    # Foreign keys of the given tables lie anywhere, so they are dealt by range first.
    sets = keysets.table_key_sets({name: table(spark, folder, name) for name in GIVEN_KEYS}, GIVEN_KEYS, scattered=True)
    return keysets.orphan_keys(sets, GIVEN_LINKS)


@register(
    "report_complete",
    "table:s gap:s",
    f"""SELECT DISTINCT tbl AS "table", 'missing' AS gap FROM {DEFINED_SQL}
        WHERE tbl || '.parquet' NOT IN (SELECT name FROM ({FILES_SQL}) AS f)
        UNION ALL SELECT replace(name, '.parquet', ''), 'unexpected' FROM ({FILES_SQL}) AS f
        WHERE replace(name, '.parquet', '') NOT IN ({NAMES_SQL})""",
)
def _(spark, folder):
    names = files.list_parts(spark, folder).select(F.regexp_replace("name", r"\.parquet$", "").alias("table"))
    return inventory.report_gaps(names, "tpch")

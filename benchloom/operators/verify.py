"""Re-verification of published data from a saved report: stored facts, full decoding, digests, samples, parity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_VERSION = 1
FILE = (
    "local_path:string,row_count:bigint,size_bytes:bigint,remote_uri:string,state:string,md5:string,sha256:string,"
    "md5_duration_seconds:double,transfer_duration_seconds:double,upload_duration_seconds:double"
)
TABLE = (
    "status:string,reason:string,error:string,table_identifier:array<string>,table_uuid:string,"
    "table_creation_state:string,table_created:boolean,snapshot_id:bigint,duration_seconds:double,"
    "row_count:bigint,size_bytes:bigint,file_count:bigint,"
    f"content:string,schema:array<struct<name:string,type:string,nullable:boolean>>,files:array<struct<{FILE}>>"
)
REPORT = (
    "report_format_version int, run_id string, command string, benchmark string, scale_factor string, "
    "namespace array<string>, catalog_uri string, on_exists string, status string, phase string, "
    "started_at string, updated_at string, finished_at string, "
    "generator struct<implementation:string,version:string,source_row_counts:map<string,bigint>>, "
    f"tables map<string,struct<{TABLE}>>, "
    "probes array<struct<uri:string,state:string,cleanup_error:string>>, warnings array<string>, errors array<string>, "
    "summary struct<succeeded:array<string>,skipped:array<string>,failed:array<string>,uncertain:array<string>,"
    "not_loaded:array<string>,tables_requiring_inspection:array<struct<table:string,identifier:array<string>,"
    "creation_state:string,status:string>>,generated_rows:bigint,generated_bytes:bigint,"
    "unregistered_uploads:array<struct<table:string,uri:string,state:string>>,"
    "uncertain_uploads:array<struct<table:string,uri:string,state:string>>,"
    "probe_cleanup_candidates:array<struct<uri:string,state:string,cleanup_error:string>>>"
)


def read_reports(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame:
    """Saved reports with their fixed schema. ``lines`` reads the line form our own publisher writes, which splits."""
    return spark.read.schema(REPORT).json(list(paths), multiLine=not lines)


def read_variants(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame:
    """Saved reports of any shape, one variant ``report`` each: fields that the fixed schema does not know stay."""
    return spark.read.option("singleVariantColumn", "report").json(list(paths), multiLine=not lines)


def variant_tables(reports: DataFrame) -> DataFrame:
    """One row per run and table, ``(run_id, benchmark, table, status, facts)``; a value of another type is null."""
    spark = reports.sparkSession
    known = reports.select(
        F.try_variant_get("report", "$.run_id", "string").alias("run_id"),
        F.try_variant_get("report", "$.benchmark", "string").alias("benchmark"),
        F.try_variant_get("report", "$.tables", "variant").alias("all"),
    )
    return known.lateralJoin(spark.tvf.variant_explode(F.col("all").outer())).select(
        "run_id",
        "benchmark",
        F.col("key").alias("table"),
        F.try_variant_get("value", "$.status", "string").alias("status"),
        F.col("value").alias("facts"),
    )


def variant_files(tables: DataFrame) -> DataFrame:
    """One row per file of the succeeded tables, as :func:`report_files`, with the file's whole ``entry`` behind."""
    spark = tables.sparkSession
    listed = tables.where("status = 'succeeded'").select(
        "run_id", "table", F.try_variant_get("facts", "$.files", "variant").alias("all")
    )
    picked = [
        F.try_variant_get("value", f"$.{name}", kind).alias(alias)
        for name, kind, alias in (
            ("remote_uri", "string", "uri"), ("row_count", "bigint", "row_count"), ("size_bytes", "bigint", "size_bytes"),
            ("state", "string", "state"), ("md5", "string", "md5"), ("sha256", "string", "sha256"),
        )
    ]
    found = listed.lateralJoin(spark.tvf.variant_explode(F.col("all").outer()))
    return found.select("run_id", "table", *picked, F.col("value").alias("entry"))


def unknown_fields(tables: DataFrame) -> DataFrame:
    """Fields of tables that the fixed schema would lose: ``(run_id, table, field, type)``."""
    spark = tables.sparkSession
    known = T.StructType.fromDDL(REPORT)["tables"].dataType.valueType.names
    fields = tables.lateralJoin(spark.tvf.variant_explode(F.col("facts").outer()))
    return fields.where(~F.col("key").isin(known)).select(
        "run_id", "table", F.col("key").alias("field"), F.schema_of_variant("value").alias("type")
    )


def rejected_reports(reports: DataFrame) -> DataFrame:
    """Reports that cannot be verified: wrong format version or not a load."""
    fine = F.col("report_format_version").eqNullSafe(F.lit(REPORT_VERSION)) & F.col("command").eqNullSafe(F.lit("load"))
    return reports.where(~fine).select("run_id", "report_format_version", "command")


def report_tables(reports: DataFrame) -> DataFrame:
    """One row per run and table of the report."""
    return reports.select("run_id", "benchmark", F.explode("tables").alias("table", "t")).select(
        "run_id", "benchmark", "table", "t.*"
    )


def report_files(tables: DataFrame) -> DataFrame:
    """One row per file of the succeeded tables."""
    return (
        tables.where("status = 'succeeded'")
        .select("run_id", "table", "table_uuid", F.explode("files").alias("f"))
        .select("run_id", "table", "table_uuid", "f.*")
        .withColumnRenamed("remote_uri", "uri")
    )


def report_file_problems(files: DataFrame) -> DataFrame:
    """Files of a report that are listed twice or not registered: ``(run_id, table, uri, problem)``."""
    return (
        files.groupBy("run_id", "table", "uri")
        .agg(F.count("*").alias("listed"), F.count_if(~F.col("state").eqNullSafe(F.lit("registered"))).alias("open"))
        .select(
            "run_id",
            "table",
            "uri",
            F.when(F.col("listed") > 1, "duplicate").when(F.col("open") > 0, "unverified").alias("problem"),
        )
        .where("problem is not null")
    )


def stored_parity(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored size and footer rows against the expected ones, per file: adds ``finding`` (``ok`` when equal).

    Both sides are keyed by ``uri``; ``stored`` comes from the listing and the footers.
    """
    right = stored.select("uri", F.col("rows").alias("footer_rows"), F.col("size_bytes").alias("stored_bytes"))
    finding = (
        F.when(F.col("stored_bytes").isNull(), "gone")
        .when(F.col("stored_bytes") != F.col("size_bytes"), "size changed")
        .when(~F.col("footer_rows").eqNullSafe(F.col("row_count")), "rows changed")
        .otherwise("ok")
    )
    return (
        expected.select("table", "uri", "row_count", "size_bytes")
        .join(right, "uri", "left")
        .withColumn("finding", finding)
    )


def verified_totals(parity: DataFrame) -> DataFrame:
    """Tables and rows that passed and files that did not."""
    per_table = parity.groupBy("table").agg(
        F.count_if(F.col("finding") != "ok").alias("bad_files"), F.sum("row_count").alias("rows")
    )
    return per_table.agg(
        F.count_if(F.col("bad_files") == 0).alias("verified_tables"),
        F.coalesce(F.sum(F.when(F.col("bad_files") == 0, F.col("rows"))), F.lit(0)).alias("verified_rows"),
        F.sum("bad_files").alias("bad_files"),
    )


def row_hash(df: DataFrame) -> Column:
    """Hash over all columns of a row, which forces every column to be decoded."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


SUMS = [f"sum_{i}" for i in range(6)]


def content_sums(df: DataFrame) -> list[Column]:
    """Six sums over all rows, whatever their order, that tell contents apart: slices of 21 and 22 bits of two hashes of
    each row, which start from different seeds. Sums of files or partitions add up to those of the table; slices
    keep them below 63 bits for 2 * 10^12 rows."""
    first, second = row_hash(df), F.xxhash64(F.lit("again"), *[F.col(c) for c in df.columns])
    slices = [(h, shift, bits) for h in (first, second) for shift, bits in ((0, 21), (21, 21), (42, 22))]
    return [
        F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1))).alias(name)
        for (h, shift, bits), name in zip(slices, SUMS, strict=True)
    ]


def content_text(*sums) -> Column:
    """The sums as one text; those of no rows are 0."""
    return F.concat_ws("-", *(F.lower(F.hex(F.coalesce(F.col(s) if isinstance(s, str) else s, F.lit(0)).cast("bigint"))) for s in sums))


def full_decode(spark: SparkSession, *paths: str) -> DataFrame:
    """Decode every row of every column of a table's files: ``(path, decoded_rows, checksum, sum_0 … sum_5)``.

    A plain count would read no column at all. The per-file sums are combined before the shuffle, so a
    file that holds most rows costs no more than its split reads.
    """
    df = spark.read.parquet(*paths)
    sums = content_sums(df)
    named = df.withColumn("_path", F.col("_metadata.file_path"))
    found = named.groupBy(F.col("_path").alias("path")).agg(F.count("*").alias("decoded_rows"), *sums)
    return found.withColumn("checksum", content_text(*SUMS))


def content_differences(recorded: DataFrame, decoded: DataFrame) -> DataFrame:
    """Tables whose rows are not those that were written: ``(table, content, found)``. ``recorded`` has ``table, content``,
    ``decoded`` the files of :func:`full_decode` with their ``table``."""
    sums = decoded.groupBy("table").agg(*(F.sum(name).alias(name) for name in SUMS))
    found = sums.select("table", content_text(*SUMS).alias("found"))
    both = recorded.where("content is not null").join(found, "table", "left")
    nothing = content_text(*(F.lit(0) for _ in SUMS))
    return both.withColumn("found", F.coalesce("found", nothing)).where("content <> found").select("table", "content", "found")


def digest_findings(expected: DataFrame, digests: DataFrame) -> DataFrame:
    """Files whose bytes are not the recorded ones; ``expected`` has ``uri, size_bytes, digest``."""
    read = digests.select(F.col("path").alias("uri"), "read_bytes", F.col("digest").alias("read_digest"))
    return (
        expected.join(read, "uri", "left")
        .where(
            ~F.col("read_bytes").eqNullSafe(F.col("size_bytes")) | ~F.col("read_digest").eqNullSafe(F.col("digest"))
        )
        .select("uri", "size_bytes", "read_bytes", "digest", "read_digest")
    )


def sample_scan(tables: dict[str, DataFrame], size: int = 10) -> DataFrame:
    """Rows a limited scan returns next to the rows there are: ``(table, sampled, rows, ok)``.

    The limit is the feature under test. Counting reads no column.
    """
    checked = []
    for name, df in tables.items():
        checked.append(
            df.limit(size)
            .agg(F.count("*").alias("sampled"))
            .withColumn("rows", df.agg(F.count("*")).scalar())
            .select(
                F.lit(name).alias("table"),
                "sampled",
                "rows",
                (F.col("sampled") == F.least(F.lit(size), "rows")).alias("ok"),
            )
        )
    return reduce(DataFrame.unionByName, checked)


def result_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two results that differ as bags: columns plus ``side`` and ``copies``.

    Equal rows are counted on each side with partial aggregation before they travel, so a row repeated in
    a third of a result is one row per task. Rows are compared null-safe.
    """
    columns = left.columns
    both = left.withColumn("_delta", F.lit(1)).unionByName(right.select(*columns).withColumn("_delta", F.lit(-1)))
    return (
        both.groupBy(*columns)
        .agg(F.sum("_delta").alias("_delta"))
        .where("_delta <> 0")
        .withColumn("side", F.when(F.col("_delta") > 0, "left").otherwise("right"))
        .withColumn("copies", F.abs("_delta"))
        .drop("_delta")
    )

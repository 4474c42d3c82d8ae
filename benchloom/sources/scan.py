"""Files below a folder as a data source: listed once for a plan, packed into input partitions, opened by the tasks.

``footers``, ``digests`` and ``ranges`` need no shuffle and no job of their own: the planner lists the folder, as it does
for any file scan, and gives each task files, or ranges of large files, of about equal bytes. A part that is larger
than a task's share is read in ranges wherever what is asked can be put together from them.

Storage settings are those of the session's Hadoop configuration (keys, endpoints and tokens, also per bucket). They
travel with the source's class, not as options of the plan, so no plan shows them.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from benchloom.sources.files import BLOCK, FOOTER, RANGE_BYTES, RANGED_FROM, _footer, _footer_schema, _store

# The source's code travels with the plan, so neither planner nor workers need a copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PART = "path string, relative string, name string, size_bytes bigint"
READS = {
    "listing": PART,
    "footers": f"{PART}, {FOOTER}",
    "digests": f"{PART}, read_bytes bigint, digest string",
    "ranges": f"{PART}, idx bigint, offset bigint, length bigint, digest string",
}
#: Bytes of a task's files where there are more than tasks at once; files of a task that reads footers only.
TASK_BYTES, TASK_FILES = 256 << 20, 64
LEAST_TASK_BYTES = 8 << 20


def storage_settings(spark: SparkSession) -> dict[str, str]:
    """The session's settings of object stores."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for prefix in ("fs.s3a.", "fs.azure."):
        found.update({prefix + key: value for key, value in dict(conf.getPropsWithPrefix(prefix)).items()})
    return found


def store_of(uri: str, settings: dict[str, str]):
    """(file system, path inside it, prefix that makes it a full path again) with the session's settings."""
    from pyarrow import fs

    scheme, _, rest = uri.partition("://")
    if rest and scheme in ("s3", "s3a", "s3n"):
        bucket = rest.split("/", 1)[0]
        return fs.S3FileSystem(**s3_arguments(bucket, settings)), rest, f"{scheme}://"
    if rest and scheme in ("abfs", "abfss"):
        place, _, inner = rest.partition("/")
        container, _, host = place.partition("@")
        store = fs.AzureFileSystem(**azure_arguments(host, settings))
        return store, f"{container}/{inner}", None
    return _store(uri)


def s3_arguments(bucket: str, settings: dict[str, str]) -> dict[str, str]:
    """Settings of a bucket: its own first, then those for all."""

    def setting(name: str) -> str | None:
        return settings.get(f"fs.s3a.bucket.{bucket}.{name}") or settings.get(f"fs.s3a.{name}")

    found = {
        "access_key": setting("access.key"),
        "secret_key": setting("secret.key"),
        "session_token": setting("session.token"),
        "region": setting("endpoint.region"),
    }
    if endpoint := setting("endpoint"):
        plain = setting("connection.ssl.enabled") == "false" or endpoint.startswith("http://")
        found |= {"endpoint_override": endpoint.split("://")[-1], "scheme": "http" if plain else "https"}
    if not (found["access_key"] and found["secret_key"]):  # what the machine's role or environment gives
        found = {name: value for name, value in found.items() if name not in ("access_key", "secret_key", "session_token")}
    return {name: value for name, value in found.items() if value}


def azure_arguments(host: str, settings: dict[str, str]) -> dict[str, str]:
    """Settings of a storage account."""
    key = settings.get(f"fs.azure.account.key.{host}") or settings.get("fs.azure.account.key")
    found = {"account_name": host.split(".")[0]}
    return found | ({"account_key": key} if key else {})


def full_path(root: str, base: str, prefix: str | None, path: str) -> str:
    """The path of a file as it is named outside its store."""
    return root.rstrip("/") + path[len(base) :] if prefix is None else prefix + path


def walk(root: str, settings: dict[str, str]) -> list[tuple[str, str, str, int]]:
    """All ``.parquet`` files below a root: ``(path, relative, path inside the store, size)``, by path.

    On a local disk links are refused, and so is a file that has two names here: a dataset has its own files, once.
    """
    from pyarrow import fs

    store, inner, prefix = store_of(root, settings)
    base = inner.rstrip("/")
    here = store.get_file_info(base)
    if here.type == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    local, seen, found = isinstance(store, fs.LocalFileSystem), set(), []
    for info in [here] if here.is_file else store.get_file_info(fs.FileSelector(base, recursive=True)):
        if local and info.path != base:
            if os.path.islink(info.path):
                raise ValueError(f"{info.path} is a link")
            if info.is_file and info.path.lower().endswith(".parquet") and (stat := os.stat(info.path)).st_nlink > 1:
                if (stat.st_dev, stat.st_ino) in seen:
                    raise ValueError(f"{info.path} is a second name of a file")
                seen.add((stat.st_dev, stat.st_ino))
        if info.is_file and info.path.lower().endswith(".parquet"):
            below = info.path[len(base) :].lstrip("/") if len(info.path) > len(base) else info.base_name
            found.append((full_path(root, base, prefix, info.path), below, info.path, info.size))
    return sorted(found)


class Pack(InputPartition):
    """What one task reads: ``(path, relative, inner path, size, idx, offset, length)``."""

    def __init__(self, items: list[tuple]) -> None:
        super().__init__(None)
        self.items = items


def packed(items: list[tuple], weights: list[int], share: int) -> list[Pack]:
    """Items in order, a new pack before one would pass its share."""
    packs, held, sum_ = [], [], 0
    for item, weight in zip(items, weights, strict=True):
        if held and sum_ + weight > share:
            packs.append(Pack(held))
            held, sum_ = [], 0
        held.append(item)
        sum_ += weight
    return [*packs, Pack(held)] if held or not packs else packs


class PartReader(DataSourceReader):
    def __init__(self, options: dict, settings: dict[str, str]) -> None:
        self.read_what, self.root, self.settings = options["read"], options["path"], settings
        self.slots = int(options["slots"])
        self.algorithm = options.get("algorithm", "md5")
        self.range_bytes, self.from_bytes = int(options["range_bytes"]), int(options["from_bytes"])

    def partitions(self) -> list[Pack]:
        """Lists the folder: this is the only place that does."""
        found = walk(self.root, self.settings)
        if self.read_what in ("listing", "footers"):
            share = min(TASK_FILES, max(1, -(-len(found) // self.slots)))
            share = max(1, len(found)) if self.read_what == "listing" and len(found) < 10_000 else share
            return packed([(*part, 0, 0, part[3]) for part in found], [1] * len(found), share)
        items = []
        for part in found:
            size = part[3]
            if self.read_what == "ranges" and size >= max(1, self.from_bytes):
                for idx in range(-(-size // self.range_bytes)):
                    offset = idx * self.range_bytes
                    items.append((*part, idx, offset, min(self.range_bytes, size - offset)))
            else:
                items.append((*part, 0, 0, size))
        share = sum(item[6] for item in items) // self.slots
        share = min(TASK_BYTES, max(LEAST_TASK_BYTES, share))
        return packed(items, [item[6] for item in items], share)

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        store = store_of(self.root, self.settings)[0] if partition.items else None
        for at in range(0, len(partition.items), 1_000):
            items = partition.items[at : at + 1_000]
            paths, below, inner, sizes, idx, offsets, lengths = (list(x) for x in zip(*items, strict=True))
            columns = [pa.array(paths), pa.array(below), pa.array([x.rsplit("/", 1)[-1] for x in paths]), pa.array(sizes, pa.int64())]
            names = ["path", "relative", "name", "size_bytes"]
            if self.read_what == "footers":
                schema = _footer_schema()
                rows = [_footer(path, lambda _, i=i: store.open_input_file(i)) for path, i in zip(paths, inner, strict=True)]
                columns += pa.RecordBatch.from_pylist(rows, schema=schema).columns[1:]
                names += schema.names[1:]
            elif self.read_what != "listing":
                read = [self.digest(store, i, offset, length) for i, offset, length in zip(inner, offsets, lengths, strict=True)]
                seen, digests = (list(x) for x in zip(*read, strict=True))
                if self.read_what == "ranges":
                    columns += [pa.array(idx, pa.int64()), pa.array(offsets, pa.int64())]
                    names += ["idx", "offset"]
                columns += [pa.array(seen, pa.int64()), pa.array(digests)]
                names += ["length" if self.read_what == "ranges" else "read_bytes", "digest"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def digest(self, store, inner: str, offset: int, length: int) -> tuple[int, str]:
        """(bytes read, digest) of a range, block by block; of whole files to their end, whatever was listed."""
        chain, seen = hashlib.new(self.algorithm), 0
        whole = self.read_what == "digests"
        with store.open_input_file(inner) as source:
            source.seek(offset)
            while (whole or seen < length) and (block := source.read(BLOCK if whole else min(BLOCK, length - seen))):
                chain.update(block)
                seen += len(block)
        return seen, chain.hexdigest()


def source_class(settings: dict[str, str]) -> type[DataSource]:
    class PartFiles(DataSource):
        @classmethod
        def name(cls) -> str:
            return "benchloom_parts"

        def schema(self) -> str:
            return READS[self.options["read"]]

        def reader(self, schema) -> PartReader:
            return PartReader(dict(self.options), settings)

    return PartFiles


#: Settings that each session has the source with: sources are a session's own, also within one application.
_registered: WeakKeyDictionary[SparkSession, str] = WeakKeyDictionary()


def scan(spark: SparkSession, root: str, read: str, algorithm: str = "md5", range_bytes: int = RANGE_BYTES, from_bytes: int = RANGED_FROM) -> DataFrame:
    """Parts below a root; ``read`` is one of :data:`READS`."""
    settings = storage_settings(spark)
    mark = json.dumps(settings, sort_keys=True)
    # Spark looks for a source in the thread's active session, which a new one becomes by making a frame.
    spark.createDataFrame([], "mark int")
    if _registered.get(spark) != mark:
        spark.dataSource.register(source_class(settings))
        _registered[spark] = mark
    options = {
        "read": read, "algorithm": algorithm, "range_bytes": range_bytes, "from_bytes": from_bytes,
        "slots": max(2 * spark.sparkContext.defaultParallelism, 8),
    }
    return spark.read.format("benchloom_parts").options(**options).load(root)


def footers(spark: SparkSession, root: str) -> DataFrame:
    """``path, relative, name, size_bytes`` and the footer of every part."""
    return scan(spark, root, "footers")


def digests(spark: SparkSession, root: str, algorithm: str = "md5") -> DataFrame:
    """``path, …, read_bytes, digest`` of whole files, each a chain in one task."""
    return scan(spark, root, "digests", algorithm)


def ranges(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES, from_bytes: int = RANGED_FROM) -> DataFrame:
    """``path, …, idx, offset, length, digest`` of the ranges of files from ``from_bytes`` on; smaller ones are one range."""
    return scan(spark, root, "ranges", "md5", range_bytes, from_bytes)


def composite(found: DataFrame) -> DataFrame:
    """One digest of each file from its ranges': ``path, read_bytes, digest, parts``.

    A file of one range has the md5 of its bytes. A longer one has the md5 of its ranges' md5s one after the other, with
    their number behind a dash. No file is a chain in one task: a file of a TB is 16,000 rows of 16 bytes here.
    """
    both = found.groupBy("path").agg(
        F.sum("length").alias("read_bytes"),
        F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("found"),
        F.max("idx").alias("last"),
    )
    joined = F.unhex(F.array_join(F.col("found.digest"), ""))
    digest = F.when(F.col("last") == 0, F.element_at("found", 1)["digest"]).otherwise(
        F.concat(F.md5(joined), F.lit("-"), F.size("found").cast("string"))
    )
    return both.select("path", "read_bytes", digest.alias("digest"), F.size("found").cast("bigint").alias("parts"))


def composite_digests(spark: SparkSession, root: str, range_bytes: int = RANGE_BYTES, from_bytes: int = RANGED_FROM) -> DataFrame:
    """The digest of every part below a root, large ones put together from ranges."""
    return composite(ranges(spark, root, range_bytes, from_bytes))

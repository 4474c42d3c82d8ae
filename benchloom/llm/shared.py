"""Files in the folder that the cluster shares, written by tasks and memory-mapped by workers.

The folder is the one named in ``spark.checkpoint.dir``; only a local session may go without it. Where it is a mounted
path its files are mapped in place. A file in a store that no path reaches is copied, when first needed, to a scratch
file without a name, which vanishes with its worker.
"""

from __future__ import annotations

import mmap
import os
import re
import tempfile
import uuid
from functools import lru_cache

import numpy as np
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and authority that Spark would resolve it by: without a scheme it lies in the default
    file system, whose files workers must not look for on their own disks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a scratch one only for a session on one machine."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="benchloom-shared-")
    folder = qualified(spark, folder)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of this run's own; it is made when the first file is written."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _path(uri: str) -> str | None:
    """The path of a mounted file. As in Spark's own paths, nothing in it is percent-encoded."""
    if uri.startswith("file:"):
        return "/" + uri.removeprefix("file:").lstrip("/")
    return uri if "://" not in uri else None


def write_file(uri: str, *arrays: np.ndarray) -> None:
    """Write arrays one after the other. Attempts of a task write the same bytes, so the last to finish may win."""
    path = _path(uri)
    if path is None:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        with store.open_output_stream(path) as out:
            for array in arrays:
                out.write(memoryview(np.ascontiguousarray(array)).cast("B"))
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    attempt = f"{path}.{uuid.uuid4().hex}"
    with open(attempt, "wb") as out:
        for array in arrays:
            np.ascontiguousarray(array).tofile(out)
    os.replace(attempt, path)


@lru_cache(maxsize=4096)
def mapped(uri: str) -> np.ndarray:
    """The bytes of a file, memory-mapped."""
    path = _path(uri)
    if path is not None:
        source = open(path, "rb")
    else:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        source = tempfile.TemporaryFile()
        with store.open_input_stream(path) as stored:
            while block := stored.read(1 << 22):
                source.write(block)
        source.flush()
    with source:
        size = os.fstat(source.fileno()).st_size
        if not size:
            return np.empty(0, np.uint8)
        return np.frombuffer(mmap.mmap(source.fileno(), size, access=mmap.ACCESS_READ), np.uint8)

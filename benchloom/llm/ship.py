"""Arrow maps whose code the executors get from the driver, so that the package need not be installed there."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from pathlib import Path

import benchloom
import pyarrow as pa
from pyspark.sql import DataFrame

_shipped: set[str] = set()


def ship(frame: DataFrame) -> None:
    """Send this subpackage to the executors, once per application."""
    context = frame.sparkSession.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(benchloom.__file__).parent
    archive = os.path.join(tempfile.mkdtemp(prefix="benchloom-code-"), "benchloom_llm.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system. Workers stay for further tasks and would each keep the most they ever had."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only some C libraries have it
        trim(0)


def arrow_map(frame: DataFrame, work, schema: str) -> DataFrame:
    """``mapInArrow`` with this subpackage at hand; what a task freed is given back at its end."""
    ship(frame)

    def task(batches):
        try:
            yield from work(batches)
        finally:
            give_back()

    return frame.mapInArrow(task, schema)


def kind(frame: DataFrame, column: str) -> str:
    """``name type`` of a column, for a schema."""
    return f"`{column}` {frame.schema[column].dataType.simpleString()}"


def spare(frame: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of the frame has, in any case of letters."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_struct(frame: DataFrame, name: str, fields: dict[str, str]) -> str:
    """The schema of ``frame`` with one more column, a struct."""
    inner = ", ".join(f"{field}: {form}" for field, form in fields.items())
    return ", ".join([*(kind(frame, column) for column in frame.columns), f"`{name}` struct<{inner}>"])

"""The folder that tasks share."""

import numpy as np
import pytest

from benchloom.llm import shared


def test_folder_lies_where_spark_resolves_it(spark, tmp_path):
    assert shared.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    settings = spark._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.viewfs.mounttable.shared.link./data", f"file://{tmp_path}")
    settings.set("fs.defaultFS", "viewfs://shared/")
    try:
        there = shared.qualified(spark, "/data/x")
        assert there == "viewfs://shared/data/x" and shared._path(there) is None
        assert shared.qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    finally:
        settings.set("fs.defaultFS", before)


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_files_lie_beside_the_tables(spark, tmp_path, form):
    folder = form.format(tmp_path) + "/a b%20c"
    shared.write_file(f"{folder}/numbers", np.arange(5))
    assert (tmp_path / "a b%20c" / "numbers").exists()
    assert (shared.mapped(f"{folder}/numbers").view(np.int64) == np.arange(5)).all()

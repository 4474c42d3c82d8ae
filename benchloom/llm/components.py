"""Connected components of a graph given by its edges, by alternating large and small stars.

Every round links each node to the smallest one that it sees, so that trees become stars within a few rounds. Rounds are
written to the shared folder, which cuts the lineage; only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm.shared import new_folder


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges ``a, b`` (whole numbers); the root is the smallest node."""
    stars = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars, before = written(stars, "edges"), None
    while True:
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
        if state == before or not state.n:
            break
        before = state
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = written(small.union(least.toDF("u", "v")).distinct(), "edges")
    nodes = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(stars.select("v", "v").distinct())

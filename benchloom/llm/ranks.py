"""Exact order statistics and quantiles of any number of values.

Equal values are counted first, so a value that stands a million times is one row. The different ones are dealt by
ranges; the counts of the ranges tell in which of them a rank lies, and only there values are put in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm.shared import new_folder


def at_ranks(values: DataFrame, wanted: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The values at the given ranks, from 0 in ascending order, of each part of ``part int, value double``."""
    spark = values.sparkSession
    folder = new_folder(spark, "ranks")
    counted = values.groupBy("part", "value").agg(F.count("*").alias("n"))
    # Ranges come from a sample of the plan, so they are fixed in files.
    dealt = counted.repartitionByRange("part", "value").withColumn("range", F.spark_partition_id())
    dealt.write.parquet(folder)
    dealt = spark.read.parquet(folder)
    # At most a row for each part in each range.
    sizes = sorted(tuple(r) for r in dealt.groupBy("part", "range").agg(F.sum("n").alias("n")).collect())
    inside: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for part, ranks in wanted.items():
        mine = [(place, n) for p, place, n in sizes if p == part]
        ends = np.cumsum([n for _, n in mine])
        where = np.searchsorted(ends, ranks, "right")
        for i in np.unique(where):
            chosen = np.flatnonzero(where == i)
            inside[part, mine[i][0]] = chosen, np.asarray(ranks)[chosen] - (ends[i] - mine[i][1])

    def pick(keys, table):
        part, place = (x.as_py() for x in keys)
        order = np.argsort(table["value"].to_numpy())
        chosen, ranks = inside[part, place]
        at = np.searchsorted(np.cumsum(table["n"].to_numpy()[order]), ranks, "right")
        found = table["value"].to_numpy()[order][at]
        return pa.table({"part": pa.array([part] * len(at), pa.int32()), "place": pa.array(chosen, pa.int64()), "value": pa.array(found, pa.float64())})

    # So many pairs at most as there are wanted ranks.
    pairs = F.struct("part", "range").isin([F.struct(F.lit(p), F.lit(r)) for p, r in inside])
    picked = dealt.where(pairs).groupBy("part", "range").applyInArrow(pick, "part int, place bigint, value double")
    out = {part: np.empty(len(ranks)) for part, ranks in wanted.items()}
    for row in picked.collect():
        out[row["part"]][row["place"]] = row["value"]
    return out


def quantiles(values: DataFrame, sizes: dict[int, int], shares: np.ndarray) -> dict[int, np.ndarray]:
    """Quantiles of each part, of which the sizes are known, with numpy's linear interpolation."""
    places = {part: (n - 1) * shares for part, n in sizes.items()}
    both = {part: np.concatenate((np.floor(x), np.minimum(np.floor(x) + 1, sizes[part] - 1))).astype(np.int64) for part, x in places.items()}
    out = {}
    for part, found in at_ranks(values, both).items():
        low, high = found.reshape(2, -1)
        share = places[part] - np.floor(places[part])
        out[part] = np.where(share < 0.5, low + (high - low) * share, high - (high - low) * (1 - share))
    return out

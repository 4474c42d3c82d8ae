"""Labels of documents, and bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marks(labels: DataFrame, label: str, key: str) -> DataFrame:
    """``__key, __label``, once each. Rows without a key or with another label than 0 and 1 are left out."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
    return usable.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label")).distinct()


def sample(documents: DataFrame, labels: DataFrame, label: str, key: str, text: str, most: int) -> DataFrame:
    """``__text, __label`` of at most ``most`` labelled documents, chosen by a hash of the key alone.

    Labels whose key stands in no row of ``documents`` do not count. A label is one row however often it is given, and a
    key one text, of several the one with the smallest hash. Rows of ``labels`` without a key or with another label than
    0 and 1 are left out. The chosen keys and labels are broadcast, ``most`` rows at most; only chosen texts are exchanged.
    """
    known = documents.select(F.col(key).alias("__key")).distinct()
    chosen = (
        marks(labels, label, key)
        .join(known, "__key", "left_semi")
        .orderBy(F.xxhash64("__key"), "__key", "__label")
        .limit(most)
    )
    found = documents.join(F.broadcast(chosen), documents[key] == chosen["__key"])
    first = found.groupBy("__key", "__label").agg(F.min_by(text, F.xxhash64(text)).alias("__text"))
    return first.select("__text", "__label")

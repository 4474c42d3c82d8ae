"""Quality rules: fixed limits on document statistics, then gradient-boosted trees over more of them.

The trees are fitted to all labelled documents, with monotonic constraints: a document never gets a better score for more
symbols, capitals, repeated lines or repeated words. Their flat arrays go to the workers, which score whole Arrow batches.

A document fails the limits with fewer than 20 words, or with more than 30 per cent of its words in 8-word windows that
it holds twice or more. Otherwise it is kept unless its score is below the threshold, which is fitted to reject at most
``SPARE`` of the good labelled documents. Null and empty texts have no words and fail. Without labels of both kinds
nothing but the limits rejects. Further columns are passed on; the result is one column whose name is a parameter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm import boosting, ranks
from benchloom.llm.columns import NOT_SPACE, U64, Words, byte_table, mix, rolling, slices, utf8
from benchloom.llm.labelled import marks
from benchloom.llm.shared import new_folder
from benchloom.llm.ship import arrow_map, kind, with_struct

#: Share of good labelled documents that the threshold may cost.
SPARE = 0.002
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_NOT_NEWLINE = ~byte_table((0x0A, 0x0A))
_CAPITAL, _SMALL, _DIGIT = byte_table((65, 90)), byte_table((97, 122)), byte_table((48, 57))
_MARK = np.isin(np.arange(256), np.frombuffer(b"!?;:\"'()[]{}=+/\\@^~_`", np.uint8))

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features and how the score may change with them.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "marks_per_word": -1,
    "capitals_per_letter": -1,
    "digits_per_char": 0,
    "words_per_line": 0,
    "dup_lines_per_line": -1,
    "repeated_words": -1,
    "different_words": 0,
    "most_frequent_word": -1,
    "words_like_the_last": -1,
}


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(``BASE`` as whole numbers, ``FEATURES``) of a slice of texts, a row for each."""
    words = Words(*utf8(column), NOT_SPACE)
    data, offsets, n = words.data, words.offsets, len(words.counts)
    owner, hashes = words.documents(), words.hashes()

    def each(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[offsets])

    chars = each(words.inside & ((data & 0xC0) != 0x80))
    symbols = each(_SYMBOL[data])

    lines = Words(data, offsets, _NOT_NEWLINE)
    worded = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    line_owner = lines.documents()[worded]
    n_lines = np.bincount(line_owner, minlength=n)
    _, first = np.unique(_within(line_owner, lines.hashes()[worded]), return_index=True)
    dup_lines = n_lines - np.bincount(line_owner[first], minlength=n)

    at = words.windows(REPEAT_WINDOW)
    edges = np.zeros(len(hashes) + 1, np.int32)
    if len(at):
        keys = _within(owner[at], rolling(hashes, REPEAT_WINDOW)[at])
        _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
        twice = at[times[which] > 1]
        edges[twice] += 1
        np.add.at(edges, twice + REPEAT_WINDOW, -1)
    repeats = np.bincount(owner[np.cumsum(edges[:-1]) > 0], minlength=n)

    _, first, times = np.unique(_within(owner, hashes), return_index=True, return_counts=True)
    different = np.bincount(owner[first], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], times)
    like_last = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])))[: len(hashes)]

    count = words.counts.astype(np.int64)
    some, letters = np.maximum(count, 1), np.maximum(each(_CAPITAL[data] | _SMALL[data]), 1)
    features = np.stack(
        [
            np.log1p(count),
            chars / some,
            symbols / some,
            each(_MARK[data]) / some,
            each(_CAPITAL[data]) / letters,
            each(_DIGIT[data]) / np.maximum(chars, 1),
            count / np.maximum(n_lines, 1),
            dup_lines / np.maximum(n_lines, 1),
            repeats / some,
            different / some,
            most / some,
            np.bincount(owner[like_last], minlength=n) / some,
        ],
        axis=1,
    )
    return np.stack([count, chars, symbols, dup_lines, repeats], axis=1), features


def _within(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return mix(hashes ^ mix(owner.astype(U64) + U64(1)))


class Rules(NamedTuple):
    trees: boosting.Trees
    threshold: float


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Rules:
    """Fit the trees to all labelled documents.

    A key has one text, of several the one with the smallest hash, and counts once for each of its labels. The statistics are
    made where the texts are and only they are exchanged; they stand in a file, which the steps of the fit read.
    """
    spark = documents.sparkSession

    def work(batches):
        for batch in slices(batches, "__text"):
            features = statistics(batch.column("__text"))[1]
            rows = pa.FixedSizeListArray.from_arrays(features.reshape(-1), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.record_batch([*batch.columns[:2], rows], names=["__key", "__hash", "features"])

    keyed = documents.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text")
    )
    known = arrow_map(keyed, work, f"{kind(keyed, '__key')}, __hash bigint, features array<double>")
    one = known.groupBy("__key").agg(F.min_by("features", "__hash").alias("features"))
    folder = new_folder(spark, "statistics")
    one.join(marks(labels, label, key), "__key").select("features", F.col("__label").alias("label")).write.parquet(folder)
    rows = spark.read.parquet(folder)
    trees = boosting.fit_frame(rows, np.array(list(FEATURES.values())))
    if not len(trees.feature):
        return Rules(trees, 0.0)

    def score(batches):
        for batch in batches:
            features = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            yield pa.record_batch([pa.array(np.zeros(len(features), np.int32)), pa.array(trees.score(features))], names=["part", "value"])

    good = rows.where("label = 1")
    last = int(SPARE * (good.count() - 1))
    found = ranks.at_ranks(arrow_map(good, score, "part int, value double"), {0: np.array([last])})
    return Rules(trees, float(min(0.5, found[0][0])))


RESULT = {name: "bigint" for name in BASE} | {"base_failed": "boolean", "kept": "boolean", "score": "double"}


def assess(documents: DataFrame, rules: Rules, text: str = "text", result: str = "rules") -> DataFrame:
    """The documents with one more column: statistics, whether the limits fail, score and verdict. One map.

    A column of the documents that has the name of the result is replaced by it.
    """
    documents = documents.drop(result)

    def work(batches):
        for batch in slices(batches, text):
            base, features = statistics(batch.column(text))
            failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > MOST_REPEATED * base[:, 0])
            score = rules.trees.score(features)
            values = [*base.T, failed, ~failed & (score >= rules.threshold), score]
            added = pa.StructArray.from_arrays([pa.array(x) for x in values], names=list(RESULT))
            yield pa.record_batch([*batch.columns, added], names=[*batch.schema.names, result])

    return arrow_map(documents, work, with_struct(documents, result, RESULT))

"""Quality by compression: a zstandard dictionary of good texts and one of bad ones; the normalised difference of what a
text takes with each becomes a calibrated score.

The difference is (size with the bad dictionary - size with the good one) / sqrt(bytes of the text): both sizes are sums
over the text, so chance alone moves their difference by about that root, and a long text weighs no more than its evidence.
The score is a logistic function of this number alone.

Everything is fitted to bounded samples of labelled documents, chosen by a hash of their key: the dictionaries to at most
``MOST_TEXTS`` texts of each kind of at most ``LONGEST`` bytes (longer and empty ones are left out before the sample is
taken), the calibration to the sizes of at most ``MOST_SIZES`` others, of any length. A key that stands more than once is
one document there. Every whole text is scored. Null and empty texts have the score of difference 0; without labels of both
kinds all texts have the share of good labels. Further columns are passed on; the result is one column named by a
parameter.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm.columns import slices, utf8
from benchloom.llm.labelled import sample
from benchloom.llm.ship import arrow_map, with_struct

MOST_TEXTS = 2_000
LONGEST = 1 << 14
MOST_SIZES = 20_000
DICTIONARY = 1 << 16
LEVEL = 3
THRESHOLD = 0.3


class Classifier(NamedTuple):
    bad: bytes
    good: bytes
    slope: float
    constant: float

    def score(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(differences * self.slope + self.constant, -30, 30)))


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    texts = sorted(x for x in texts if x)
    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICTIONARY]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content) if content else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False)


def differences(column: pa.Array, bad: zstandard.ZstdCompressor, good: zstandard.ZstdCompressor) -> np.ndarray:
    """The normalised difference of each text."""
    data, offsets = utf8(column)
    view = memoryview(data)
    more = [len(bad.compress(view[a:b])) - len(good.compress(view[a:b])) for a, b in zip(offsets, offsets[1:])]
    return np.array(more, float) / np.sqrt(np.maximum(np.diff(offsets), 1))


def logistic(values: np.ndarray, truth: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """(slope, constant) of a logistic regression on one number, by Newton's steps."""
    centre, scale = values.mean(), max(values.std(), 1e-9)
    table = np.column_stack([np.clip((values - centre) / scale, -8, 8), np.ones(len(values))])
    weights, penalty = np.zeros(2), np.array([ridge, 1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(table @ weights, -30, 30)))
        slope = table.T @ (truth - p) - penalty * weights
        curve = (table * (p * (1 - p))[:, None]).T @ table + np.diag(penalty)
        weights = weights + np.clip(np.linalg.solve(curve, slope), -3, 3)
    return float(weights[0] / scale), float(weights[1] - weights[0] * centre / scale)


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Classifier:
    """Fit to the documents that ``labels`` covers."""
    documents = documents.select(key, text)
    half = F.pmod(F.xxhash64(F.col(key)), F.lit(2))
    short = documents.where(F.octet_length(text).between(1, LONGEST))
    texts: list[list[bytes]] = []
    for wanted in (0, 1):
        chosen = sample(short, labels.where((F.col(label) == wanted) & (half == 0)), label, key, text, MOST_TEXTS)
        texts.append([x.encode() for x in chosen.select("__text").toArrow().column("__text").to_pylist()])
    bad, good = map(dictionary, texts)

    def work(batches):
        pair = compressor(bad), compressor(good)
        for batch in slices(batches, "__text"):
            found = differences(batch.column("__text"), *pair)
            yield pa.record_batch([pa.array(found), batch.column("__label")], names=["difference", "label"])

    chosen = sample(documents, labels.where(half == 1), label, key, text, MOST_SIZES)
    got = arrow_map(chosen, work, "difference double, label int").toArrow()
    values, truth = got.column("difference").to_numpy(), got.column("label").to_numpy().astype(float)
    order = np.lexsort((truth, values))  # the order of arrival is not fixed
    values, truth = values[order], truth[order]
    if not bad or not good or len(np.unique(truth)) < 2:
        n, of_good = sum(map(len, texts)) + len(truth), len(texts[1]) + truth.sum()
        return Classifier(bad, good, 0.0, float(np.log((of_good + 1) / (n - of_good + 1))))
    return Classifier(bad, good, *logistic(values, truth))


def classify(documents: DataFrame, model: Classifier, text: str = "text", result: str = "quality") -> DataFrame:
    """The documents with one more column: the score, and whether it is at least ``THRESHOLD``. One map.

    A column of the documents that has the name of the result is replaced by it.
    """
    documents = documents.drop(result)

    def work(batches):
        pair = compressor(model.bad), compressor(model.good)
        for batch in slices(batches, text):
            score = model.score(differences(batch.column(text), *pair))
            added = pa.StructArray.from_arrays(
                [pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["score", "predicted"]
            )
            yield pa.record_batch([*batch.columns, added], names=[*batch.schema.names, result])

    return arrow_map(documents, work, with_struct(documents, result, {"score": "double", "predicted": "int"}))

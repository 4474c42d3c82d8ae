"""Byte-level BPE: texts to token ids and back to bytes.

The tiktoken library does the merges, from a rank file that every worker can open; its path and the pattern that splits
texts are parameters. A long text is encoded in chunks cut only where a match of the pattern must end, so the ids are
those of the whole text.

Null and empty texts have no ids. Ids are kept as little-endian unsigned 32-bit integers. Only the named columns are
read, so others may have any name; repeated rows give repeated results; row order is not kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from benchloom.llm.columns import slices
from benchloom.llm.ship import arrow_map, kind

#: Characters encoded at once; longer texts are cut at safe places.
CHUNK = 1 << 16

# A match that holds the character on the left ends here: before white space after none, before the last white space of
# a run (which the pattern leaves to what follows), between ASCII letters and digits, and before ASCII signs after those.
_SAFE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\s)(?=\s\S)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
    r"|(?<=[A-Za-z0-9])(?=[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])"
)


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per worker."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Pieces of ``text`` whose matches are those of the whole; about ``size`` long, longer where no cut is safe."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str, encoder: tiktoken.Encoding) -> bytes:
    """Ids of one text as little-endian unsigned 32-bit integers."""
    return b"".join(
        encoder.encode_to_numpy(piece, disallowed_special=()).astype("<u4").tobytes() for piece in chunks(text)
    )


def encode(documents: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids`` of every text; one map, no exchange."""

    def work(batches):
        encoder = encoding(ranks, pattern)
        for batch in slices(batches, text):
            ids = [token_ids(value or "", encoder) for value in batch.column(text).to_pylist()]
            yield pa.record_batch(
                [batch.column(key), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[key, "n_tokens", "ids"],
            )

    return arrow_map(documents.select(key, text), work, f"{kind(documents, key)}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, ranks: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key, n_tokens, ids, decoded``: the raw bytes of the ids, which need not be whole characters. Null: none."""

    def work(batches):
        encoder = encoding(ranks, pattern)
        for batch in batches:
            lists = [np.frombuffer(x or b"", "<u4") for x in batch.column(ids).to_pylist()]
            decoded = [encoder.decode_bytes(x.tolist()) for x in lists]
            yield pa.record_batch(
                [
                    batch.column(key),
                    pa.array([len(x) for x in lists], pa.int64()),
                    batch.column(ids),
                    pa.array(decoded, pa.binary()),
                ],
                names=[key, "n_tokens", "ids", "decoded"],
            )

    shape = f"{kind(encoded, key)}, n_tokens bigint, ids binary, decoded binary"
    return arrow_map(encoded.select(key, ids), work, shape)


def round_trip(documents: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids, decoded`` as :func:`decode` of :func:`encode` gives them, in one map: one encoding in each worker."""

    def work(batches):
        encoder = encoding(ranks, pattern)
        for batch in slices(batches, text):
            ids = [token_ids(value or "", encoder) for value in batch.column(text).to_pylist()]
            decoded = [encoder.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield pa.record_batch(
                [
                    batch.column(key),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(decoded, pa.binary()),
                ],
                names=[key, "n_tokens", "ids", "decoded"],
            )

    shape = f"{kind(documents, key)}, n_tokens bigint, ids binary, decoded binary"
    return arrow_map(documents.select(key, text), work, shape)

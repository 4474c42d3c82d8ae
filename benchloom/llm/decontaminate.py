"""Benchmark decontamination: which words of which documents stand in benchmark passages.

The benchmark is cut into blocks of bounded size, each a file of word windows in the shared folder. Every task gathers a
shard of whole documents, indexes its words (``FMIndex``), and searches the windows of one block after the other in it;
nothing is exchanged. A word that no window of the block holds can be in no occurrence, so the index keeps only runs of
the block's words that are long enough for its shortest window.

Words are ``[0-9a-z]`` and all characters above ASCII, A-Z in lower case. A window is ``WINDOW`` consecutive words of an
item; an item of fewer words, but not none, is one window. Null and empty texts have no words and are never hit; an item
without an id hits but is not listed; repeated items count once; an empty benchmark hits nothing. Only the named columns
are read; repeated documents give repeated rows.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from benchloom.llm.columns import LETTERS_DIGITS, Words, lower, slices, utf8
from benchloom.llm.fm_index import FMIndex
from benchloom.llm.shared import mapped, new_folder, write_file
from benchloom.llm.ship import arrow_map, with_struct

WINDOW = 13
#: Text of the benchmark in one block, and of the documents in one shard.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 2 << 20


def words(column: pa.Array) -> Words:
    data, offsets = utf8(column)
    return Words(lower(data), offsets, LETTERS_DIGITS)


def build_blocks(benchmark: DataFrame, key: str, text: str, window: int) -> list[str]:
    """Write the windows of the benchmark as files; returns where they are."""
    folder = new_folder(benchmark.sparkSession, "benchmark")
    size = benchmark.agg(F.sum(F.octet_length(text)).alias("size")).first().size or 0

    def work(batches):
        batches = list(batches)  # a block, whose size is bounded
        if sum(x.num_rows for x in batches):
            items = pa.Table.from_batches(batches).combine_chunks()
            place = f"{folder}/block-{TaskContext.get().partitionId():06d}"
            write_file(place, np.frombuffer(_block(items, key, text, window), np.uint8))
            yield pa.record_batch([pa.array([place])], names=["place"])

    blocks = arrow_map(benchmark.select(key, text).repartition(size // BLOCK_BYTES + 1), work, "place string")
    return sorted(row.place for row in blocks.collect())


def _block(items: pa.Table, key: str, text: str, window: int) -> bytes:
    found = words(items.column(text).combine_chunks())
    vocabulary, symbols = np.unique(found.hashes(), return_inverse=True)
    symbols = symbols.astype(np.int32) + 1
    item = found.documents()
    short = (found.counts < window) & (found.counts > 0)
    starts = np.concatenate((found.windows(window), found.first[:-1][short])).astype(np.int64)
    sizes = np.where(found.counts[item[starts]] < window, found.counts[item[starts]], window)
    table = np.zeros((len(starts), window), np.int32)
    for i in range(window):
        inside = i < sizes
        table[inside, i] = symbols[starts[inside] + i]
    table, which = np.unique(table, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.reshape(-1), item[starts]], axis=1), axis=0)
    out = io.BytesIO()
    np.savez(
        out,
        vocabulary=vocabulary,
        windows=table,
        sizes=(table > 0).sum(axis=1),
        first=np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)),
        items=pairs[:, 1],
        ids=np.frombuffer(_ipc(items.select([key])), np.uint8),
    )
    return out.getvalue()


def _ipc(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def occurrences(block: dict, found: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence of the block's windows in the documents of a shard."""
    none = np.empty(0, np.int64)
    if not len(block["windows"]) or not len(hashes):
        return none, none
    at = np.searchsorted(block["vocabulary"], hashes)
    at[at == len(block["vocabulary"])] = 0
    known = block["vocabulary"][at] == hashes
    # Runs of known words within a document, of at least the shortest window.
    heads = np.zeros(len(hashes), bool)
    heads[found.first[:-1][found.counts > 0]] = True
    begins = np.flatnonzero(known & (heads | ~np.concatenate(([False], known[:-1]))))
    stops = np.flatnonzero(known & np.concatenate((heads[1:] | ~known[1:], [True]))) + 1
    long = stops - begins >= block["sizes"].min()
    begins, sizes = begins[long], (stops - begins)[long]
    if not len(begins):
        return none, none
    total = np.cumsum(sizes + 1)
    place = np.arange(total[-1]) - np.repeat(total - sizes - 1, sizes + 1) + np.repeat(begins, sizes + 1)
    text = np.zeros(total[-1], np.int64)
    filled = np.ones(total[-1], bool)
    filled[total - 1] = False
    text[filled] = at[place[filled]] + 1
    index = FMIndex(text, len(block["vocabulary"]))
    windows, rows = [], []
    for size in np.unique(block["sizes"]):
        chosen = np.flatnonzero(block["sizes"] == size)
        low, high = index.search(block["windows"][chosen, :size].astype(np.int64))
        n = high - low
        windows.append(np.repeat(chosen, n))
        rows.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n))
    return np.concatenate(windows), place[index.locate(np.concatenate(rows))]


def hits(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    result: str = "hits",
) -> DataFrame:
    """The documents with one more column: ``n_words, n_hit, items, spans``.

    ``items`` are the different ids of items with a window in it; ``spans`` the merged runs of hit words, by the place of
    the first and of the one after the last. A column of the documents that has the name of the result is replaced by it.
    """
    documents = documents.drop(result)
    places = build_blocks(benchmark, item, item_text, window)
    item_type = benchmark.schema[item].dataType.simpleString()
    arrow_item = to_arrow_type(benchmark.schema[item].dataType)
    fields = {
        "n_words": "bigint",
        "n_hit": "bigint",
        "items": f"array<{item_type}>",
        "spans": "array<struct<start: bigint, end: bigint>>",
    }

    def shard(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        found = words(rows.column(text).combine_chunks())
        hashes, document = found.hashes(), found.documents()
        edges = np.zeros(len(hashes) + 1, np.int32)
        listed: list[set] = [set() for _ in range(rows.num_rows)]
        for place in places:
            block = np.load(io.BytesIO(mapped(place).tobytes()))
            block = {name: block[name] for name in block.files}
            windows, first = occurrences(block, found, hashes)
            np.add.at(edges, first, 1)
            np.add.at(edges, first + block["sizes"][windows], -1)
            if not len(windows):
                continue
            ids = pa.ipc.open_stream(block["ids"].tobytes()).read_all().column(0).to_pylist()
            pairs = np.unique(np.stack([document[first], windows], axis=1), axis=0)
            for d, w in pairs.tolist():
                listed[d].update(ids[i] for i in block["items"][block["first"][w] : block["first"][w + 1]])
        hit = np.cumsum(edges[:-1]) > 0
        heads = np.zeros(len(hit), bool)
        heads[found.first[:-1][found.counts > 0]] = True
        begins = np.flatnonzero(hit & (heads | ~np.concatenate(([False], hit[:-1]))))
        stops = np.flatnonzero(hit & np.concatenate((heads[1:] | ~hit[1:], [True]))) + 1 if len(hit) else begins
        owner = document[begins]
        base = found.first[owner]
        spans = pa.StructArray.from_arrays(
            [pa.array(begins - base, pa.int64()), pa.array(stops - base, pa.int64())], names=["start", "end"]
        )
        bounds = np.searchsorted(owner, np.arange(rows.num_rows + 1)).astype(np.int32)
        n_hit = np.bincount(document[hit], minlength=rows.num_rows)
        added = pa.StructArray.from_arrays(
            [
                pa.array(found.counts, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array([sorted(x - {None}) for x in listed], pa.list_(arrow_item)),
                pa.ListArray.from_arrays(pa.array(bounds), spans),
            ],
            names=list(fields),
        )
        columns = [column.combine_chunks() for column in rows.columns]
        return pa.record_batch([*columns, added], names=[*rows.column_names, result])

    def work(batches):
        held, size = [], 0
        for batch in slices(batches, text):
            held.append(batch)
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield shard(held)
                held, size = [], 0
        if held:
            yield shard(held)

    return arrow_map(documents, work, with_struct(documents, result, fields))


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """Whether a document counts as contaminated: a twentieth of its words or more are hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)

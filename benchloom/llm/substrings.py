"""Removal of word sequences that stood earlier: a count-min sketch first, then exact groups of what it lets through.

1. Every task counts its windows (``WINDOW`` consecutive words) in a sketch of two rows of cells and sends the cells that
   are not 0, packed by ranges of cells. The merged sketch never counts too little, so a window with a cell below 2
   stands nowhere else. Bits of the cells with 2 or more go to files in the shared folder.
2. A second pass looks every window up in the mapped bits and sends only those that seem repeated; grouped by their
   hash, they give a sorted array of the repeated windows with the first place of each, in files by ranges of hashes.
3. A third pass looks windows up there and takes out the words of all that have an earlier place.

Windows are told apart by 96 bits. The number of cells follows the bytes of the input and decides only how many windows
pass 2 sends. Before anything is sent, each task reduces equal cells and equal windows to one entry, so a passage in
very many documents is one entry of each task.

Words are ``[^\x20\x09-\x0D]+``. Null and empty texts, and texts shorter than a window, lose nothing. Keys are whole
numbers; null is before all others; rows of equal key count as one document. Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchloom.llm.columns import NOT_SPACE, U64, Words, rolling, slices, utf8
from benchloom.llm.shared import mapped, new_folder, write_file
from benchloom.llm.ship import arrow_map, kind

WINDOW = 20
ROWS = 2
#: Cells of one file of bits, and of the parts that a row of packed cells counts.
RANGE, PART = 1 << 24, 1 << 16
#: Windows that a task gathers before it sends their cells, and candidates before it sends them.
GATHERED = 3 << 20
NO_KEY = np.iinfo(np.int64).min


def windows(batch: pa.RecordBatch, text: str, size: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, first words of the windows, 64 bits, 32 more) of a slice of documents."""
    words = Words(*utf8(batch.column(text)), NOT_SPACE)
    at, hashes = words.windows(size), words.hashes()
    if not len(at):
        return words, at, np.empty(0, U64), np.empty(0, np.uint32)
    return words, at, rolling(hashes, size)[at], (rolling(hashes, size, 5)[at] >> U64(32)).astype(np.uint32)


def cells(one: np.ndarray, two: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each window in each row of the sketch; rows follow each other."""
    second = (one >> U64(32)) ^ (two.astype(U64) << U64(20))
    return [(one & U64(width - 1)).astype(np.int64), (second & U64(width - 1)).astype(np.int64) + width]


def sketch_width(documents: DataFrame, text: str) -> int:
    """Cells of a row: a power of two, half as many as the text has bytes at least."""
    size = documents.agg(F.sum(F.octet_length(text)).alias("size")).first().size or 0
    return 1 << max(16, int(size // 2).bit_length())


def build_sketch(documents: DataFrame, text: str, size: int, width: int) -> str:
    """Write the bits of the cells counted twice or more; returns their folder."""
    folder = new_folder(documents.sparkSession, "sketch")
    span = min(RANGE, width)

    def count(batches):
        held, n = [], 0

        def send():
            every = np.sort(np.concatenate(held))
            first = np.concatenate(([True], every[1:] != every[:-1]))
            unique = every[first]
            again = np.unique(every[~first])
            low, high = unique[0] // span, unique[-1] // span
            bounds = np.arange(low, high + 2) * span
            here, twice = np.searchsorted(unique, bounds), np.searchsorted(again, bounds)
            for i in range(high - low + 1):
                if here[i] < here[i + 1]:
                    yield (
                        int(low + i),
                        _packed(unique[here[i] : here[i + 1]] % span),
                        _packed(again[twice[i] : twice[i + 1]] % span),
                    )

        for batch in slices(batches, text):
            _, at, one, two = windows(batch, text, size)
            if len(at):
                held += cells(one, two, width)
                n += len(at)
            if n >= GATHERED:
                yield from _records(send())
                held, n = [], 0
        if n:
            yield from _records(send())

    def merge(batches):
        place, counts = None, None
        for batch in batches:
            for at, met, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != place:
                    if place is not None:
                        yield _write(place, counts)
                    place, counts = at, np.zeros(span, np.uint8)
                for found in (_unpacked(met), _unpacked(again)):
                    counts[found] = np.minimum(counts[found], 254) + 1
        if place is not None:
            yield _write(place, counts)

    def _write(place, counts):
        write_file(f"{folder}/bits-{place:08d}", np.packbits(counts >= 2, bitorder="little"))
        return pa.record_batch([pa.array([place], pa.int32())], names=["place"])

    packed = arrow_map(documents.select(text), count, "place int, met binary, again binary")
    merged = arrow_map(packed.repartition("place").sortWithinPartitions("place"), merge, "place int")
    merged.agg(F.count("*")).collect()
    return folder


def _packed(found: np.ndarray) -> bytes:
    counts = np.bincount(found // PART, minlength=RANGE // PART).astype("<u4")
    return counts.tobytes() + (found % PART).astype("<u2").tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    parts = RANGE // PART
    counts = np.frombuffer(blob, "<u4", parts)
    return np.repeat(np.arange(parts) * PART, counts) + np.frombuffer(blob, "<u2", offset=4 * parts)


def _records(rows):
    for place, met, again in rows:
        yield pa.record_batch(
            [pa.array([place], pa.int32()), pa.array([met], pa.binary()), pa.array([again], pa.binary())],
            names=["place", "met", "again"],
        )


def seems_repeated(folder: str, one: np.ndarray, two: np.ndarray, width: int) -> np.ndarray:
    """Whether the sketch counts a window twice or more."""
    span = min(RANGE, width)
    result = np.ones(len(one), bool)
    for row in cells(one, two, width):
        todo = np.flatnonzero(result)
        row = row[todo]
        files = row // span
        for place in np.unique(files):
            mine = np.flatnonzero(files == place)
            bits = mapped(f"{folder}/bits-{place:08d}")
            cell = row[mine] - place * span
            result[todo[mine]] = (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
    return result


def build_first_places(documents: DataFrame, key: str, text: str, size: int, width: int, sketch: str) -> tuple[str, int]:
    """Write the windows that stand in two places or more, each with its first; returns (folder, bits of a range)."""
    folder = new_folder(documents.sparkSession, "windows")
    bits = max(0, (width // (1 << 22)).bit_length() - 1)

    def gather(batches):
        held, n = [], 0
        for batch in slices(batches, text):
            words, at, one, two = windows(batch, text, size)
            keep = np.flatnonzero(seems_repeated(sketch, one, two, width))
            if len(keep):
                owner = words.documents()[at[keep]]
                held.append((one[keep], two[keep], keys_of(batch, key)[owner], at[keep] - words.first[owner], np.zeros(len(keep), bool)))
                n += len(keep)
            if n >= GATHERED // 2:
                yield from _ranges(_first(held), bits)
                held, n = [], 0
        if n:
            yield from _ranges(_first(held), bits)

    def group(batches):
        place, held, n = None, [], 0
        for batch in batches:
            for at, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != place:
                    if place is not None:
                        yield _write(place, _first(held))
                    place, held, n = at, [], 0
                held.append(_window_arrays(blob))
                n += len(held[-1][0])
                if n >= 2 * GATHERED:  # what tasks have in common is reduced as it comes
                    held = [_first(held)]
                    n = len(held[0][0])
        if place is not None:
            yield _write(place, _first(held))

    def _write(place, rows):
        repeated = rows[4]
        kept = [x[repeated] for x in rows[:4]]
        write_file(f"{folder}/windows-{place:08d}", kept[0], kept[2], kept[1], kept[3].astype("<u4"))
        return pa.record_batch([pa.array([place], pa.int32())], names=["place"])

    sent = arrow_map(documents.select(key, text), gather, "place int, windows binary")
    grouped = arrow_map(sent.repartition("place").sortWithinPartitions("place"), group, "place int")
    grouped.agg(F.count("*")).collect()
    return folder, bits


def keys_of(batch: pa.RecordBatch, key: str) -> np.ndarray:
    return batch.column(key).cast(pa.int64()).fill_null(NO_KEY).to_numpy(zero_copy_only=False)


def _first(held: list[tuple]) -> list[np.ndarray]:
    """One entry of each window: its first place, and whether there are others."""
    one, two, owner, start, more = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort((start, owner, two, one))
    one, two, owner, start, more = (x[order] for x in (one, two, owner, start, more))
    head = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    at = np.flatnonzero(head)
    place = (owner != owner[np.repeat(at, np.diff(np.append(at, len(one))))]) | (
        start != start[np.repeat(at, np.diff(np.append(at, len(one))))]
    )
    return [one[at], two[at], owner[at], start[at], np.logical_or.reduceat(more | place, at)]


def _ranges(rows: list[np.ndarray], bits: int):
    places = (rows[0] >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(rows[0]), np.int64)
    ends = np.flatnonzero(np.concatenate((places[1:] != places[:-1], [True]))) + 1
    for start, end in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
        one, two, owner, first, more = (x[start:end] for x in rows)
        blob = b"".join(
            (
                np.array([end - start], "<u8").tobytes(), one.tobytes(), owner.tobytes(), two.tobytes(),
                first.astype("<u4").tobytes(), more.tobytes(),
            )
        )
        yield pa.record_batch(
            [pa.array([int(places[start])], pa.int32()), pa.array([blob], pa.binary())], names=["place", "windows"]
        )


def _window_arrays(blob: bytes | np.ndarray) -> tuple:
    n = int(np.frombuffer(blob, "<u8", 1)[0])
    parts, at = [], 8
    for form in (U64, np.int64, np.uint32, np.uint32, bool):
        parts.append(np.frombuffer(blob, form, n, at))
        at += parts[-1].nbytes
    return parts[0], parts[2], parts[1], parts[3].astype(np.int64), parts[4]


def stands_earlier(folder: str, bits: int, one: np.ndarray, two: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each window's words also start at an earlier place."""
    result = np.zeros(len(one), bool)
    places = (one >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(one), np.int64)
    for place in np.unique(places):
        stored = mapped(f"{folder}/windows-{place:08d}")
        n = len(stored) // 24
        if not n:
            continue
        ones, owners = stored[: 8 * n].view(U64), stored[8 * n : 16 * n].view(np.int64)
        twos, starts = stored[16 * n : 20 * n].view(np.uint32), stored[20 * n :].view(np.uint32)
        todo = np.flatnonzero(places == place)
        at = np.searchsorted(ones, one[todo])
        while len(todo):
            inside = at < n
            todo, at = todo[inside], at[inside]
            same = ones[at] == one[todo]
            todo, at = todo[same], at[same]
            found = twos[at] == two[todo]
            mine, its = todo[found], at[found]
            result[mine] = (owners[its] != owner[mine]) | (starts[its] != start[mine])
            todo, at = todo[~found], at[~found] + 1
    return result


def remove(documents: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, n_words, n_removed, kept``: every text without the words of windows that stand earlier, words joined by
    one space."""
    width = sketch_width(documents, text)
    sketch = build_sketch(documents, text, window, width)
    folder, bits = build_first_places(documents, key, text, window, width, sketch)

    def work(batches):
        for batch in slices(batches, text):
            words, at, one, two = windows(batch, text, window)
            keep = np.flatnonzero(seems_repeated(sketch, one, two, width))
            owner = words.documents()[at[keep]]
            gone = keep[
                stands_earlier(folder, bits, one[keep], two[keep], keys_of(batch, key)[owner], at[keep] - words.first[owner])
            ]
            edges = np.zeros(len(words.starts) + 1, np.int32)
            edges[at[gone]] += 1
            np.add.at(edges, at[gone] + window, -1)
            removed = np.cumsum(edges[:-1]) > 0
            yield pa.record_batch(
                [
                    batch.column(key),
                    pa.array(words.counts, pa.int64()),
                    pa.array(np.bincount(words.documents()[removed], minlength=batch.num_rows), pa.int64()),
                    kept_texts(words, ~removed),
                ],
                names=[key, "n_words", "n_removed", "kept"],
            )

    shape = f"{kind(documents, key)}, n_words bigint, n_removed bigint, kept string"
    return arrow_map(documents.select(key, text), work, shape)


def kept_texts(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each document, joined by one space."""
    sizes = (words.ends - words.starts)[kept]
    owner = words.documents()[kept]
    last = np.concatenate((owner[1:] != owner[:-1], [True]))[: len(owner)]
    spaced = sizes + ~last
    ends = np.cumsum(spaced)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    chosen = np.zeros(len(words.data) + 1, np.int8)
    chosen[words.starts[kept]] += 1
    chosen[words.ends[kept]] -= 1
    filled = np.zeros(len(out) + 1, np.int8)
    heads = ends - spaced
    filled[heads] += 1
    filled[heads + sizes] -= 1
    out[np.cumsum(filled[:-1], dtype=np.int8).astype(bool)] = words.data[np.cumsum(chosen[:-1], dtype=np.int8).astype(bool)]
    lengths = np.bincount(owner, spaced, len(words.counts)).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.StringArray.from_buffers(len(words.counts), pa.py_buffer(offsets), pa.py_buffer(out))

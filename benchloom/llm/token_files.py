"""Token-id files in patched frame-of-reference blocks.

A dataset is a folder of Parquet files. Each row is a segment: whole documents, in ascending order of their key, of one
shard (a range of keys that one task wrote). Its ids stand in blocks of ``BLOCK``; ``block_starts`` is the index of the
blocks' first bytes and ``doc_starts`` of the documents' first ids, so one document or block can be cut out without
decoding the rest. A block is

    min uint32 | n uint16 | width uint8 | 0 uint8 | exceptions uint16 | 0 uint16
    n values less the minimum, their low ``width`` bits packed
    exceptions: places uint16, then whole differences uint32

all little-endian. The width is that of the ``PERCENTILE`` of the block's differences; longer ones are exceptions.

Every document ends with ``end_id``, so null and empty texts have one id. Documents with equal keys are ordered by a
hash of their text; null keys come first. Only the named columns are read.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from benchloom.llm.columns import U64, hash_pieces, slices, spread, utf8
from benchloom.llm.ship import arrow_map

BLOCK = 512
SEGMENT = 1 << 16
PERCENTILE = 90
#: Spans whose ids a worker remembers.
REMEMBERED = 2_000_000
#: Spans that are encoded as one text.
TOGETHER = 200

_HEAD = np.dtype([("low", "<u4"), ("n", "<u2"), ("width", "u1"), ("pad", "u1"), ("odd", "<u2"), ("pad2", "<u2")])


def pack(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """(blocks, their first bytes) of unsigned 32-bit ids."""
    parts, starts, at = [], [], 0
    for first in range(0, len(ids), BLOCK * 128):
        group = ids[first : first + BLOCK * 128].astype(np.uint32)
        full = len(group) // BLOCK * BLOCK
        for block in _packed(group[:full].reshape(-1, BLOCK)) + _packed(group[full:].reshape(1, -1)):
            parts.append(block)
            starts.append(at)
            at += len(block)
    return b"".join(parts), starts


def _packed(rows: np.ndarray) -> list[bytes]:
    if not rows.size:
        return []
    n = rows.shape[1]
    low = rows.min(axis=1)
    rest = rows - low[:, None]
    place = min(n - 1, n * PERCENTILE // 100)
    typical = np.partition(rest, place, axis=1)[:, place]
    widths = np.ceil(np.log2(typical.astype(float) + 1)).astype(int)
    out: list[bytes] = [b""] * len(rows)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        values = np.ascontiguousarray(rest[chosen])
        bytes_each = 2 if width <= 16 else 4
        planes = values.astype(f"<u{bytes_each}").view(np.uint8).reshape(len(chosen), n, bytes_each)
        bits = np.unpackbits(planes, axis=2, bitorder="little")
        packed = np.packbits(bits[:, :, :width].reshape(len(chosen), -1), axis=1, bitorder="little")
        odd = values >> np.uint32(width) > 0 if width < 32 else np.zeros(values.shape, bool)
        for i, block in enumerate(chosen):
            places = np.flatnonzero(odd[i])
            head = np.array([(low[block], n, width, 0, len(places), 0)], _HEAD)
            out[block] = b"".join(
                (head.tobytes(), packed[i].tobytes(), places.astype("<u2").tobytes(), values[i, places].astype("<u4").tobytes())
            )
    return out


def unpack(blocks: bytes, starts: list[int] | np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``starts``."""
    data = np.frombuffer(blocks, np.uint8)
    starts = np.asarray(starts, np.int64)
    if not len(starts):
        return np.empty(0, np.uint32)
    heads = data[starts[:, None] + np.arange(_HEAD.itemsize)].reshape(-1).view(_HEAD)
    n, width = heads["n"].astype(np.int64), heads["width"].astype(np.int64)
    sizes = (n * width + 7) // 8
    body, out = starts + _HEAD.itemsize, np.empty(int(n.sum()), np.uint32)
    ends = np.cumsum(n)
    for shape in np.unique(np.stack([n, width]), axis=1).T:
        chosen = np.flatnonzero((n == shape[0]) & (width == shape[1]))
        bits = np.unpackbits(data[body[chosen][:, None] + np.arange(sizes[chosen[0]])], axis=1, bitorder="little")
        bytes_each = 2 if shape[1] <= 16 else 4
        padded = np.zeros((len(chosen), shape[0], 8 * bytes_each), np.uint8)
        padded[:, :, : shape[1]] = bits[:, : shape[0] * shape[1]].reshape(len(chosen), shape[0], shape[1])
        values = np.packbits(padded.reshape(len(chosen), -1), axis=1, bitorder="little").view(f"<u{bytes_each}")
        out[(ends[chosen] - shape[0])[:, None] + np.arange(shape[0])] = values
    for block in np.flatnonzero(heads["odd"]):
        odd, at = int(heads["odd"][block]), int(body[block] + sizes[block])
        places = data[at : at + 2 * odd].view("<u2")
        out[int(ends[block] - n[block]) + places.astype(np.int64)] = data[at + 2 * odd : at + 6 * odd].view("<u4")
    return out + np.repeat(heads["low"], n)


class Encoder:
    """A tokenizer file, with the ids of the spans of text that this worker has met.

    A byte-level pattern never matches across a non-space followed by a space, so a text's ids are those of its spans
    from one such place to the next, and each different span needs the library once. Spans are told apart by 64 bits:
    ``known`` is numbered as they came, ``slots`` is an open hash table of those numbers plus one, and ``first`` and ``count``
    say where in ``store`` the ids of each stand.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        names = self.library.get_vocab(with_added_tokens=True)
        self.bytes_of = np.zeros(max(names.values()) + 1, np.int64)
        for name, number in names.items():
            self.bytes_of[number] = len(name)  # one character stands for one byte
        # The library finds these strings before it looks for words.
        for number, added in self.library.get_added_tokens_decoder().items():
            self.bytes_of[number] = len(added.content.encode())
        self.spans = cuts_at_spaces(self.library)
        self.forget()

    def forget(self) -> None:
        self.known, self.first, self.count = np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.store, self.used = np.empty(1 << 16, np.uint32), 0
        self.slots, self.keys = np.zeros(1 << 12, np.int32), np.empty(1 << 12, U64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each span, -1 for new ones."""
        mask = U64(len(self.slots) - 1)
        slot = (hashes & mask).astype(np.int64)
        found = self.slots[slot]
        # Those that meet another span look at the next slots, until one is their own or empty.
        open_ = np.flatnonzero((found > 0) & (self.keys[slot] != hashes))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(mask)
            found[open_] = self.slots[slot[open_]]
            open_ = open_[(found[open_] > 0) & (self.keys[slot[open_]] != hashes[open_])]
        return found.astype(np.int64) - 1

    def enter(self, hashes: np.ndarray) -> None:
        """Number new spans, all different, after those that are known."""
        base, self.known = len(self.known), np.concatenate((self.known, hashes))
        if 2 * len(self.known) > len(self.slots):
            size = 1 << (2 * len(self.known) - 1).bit_length()
            self.slots, self.keys = np.zeros(size, np.int32), np.empty(size, U64)
            base, hashes = 0, self.known
        mask = len(self.slots) - 1
        left, slot = np.arange(len(hashes)), (hashes & U64(mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[slot] == 0)
            self.slots[slot[free]] = base + left[free] + 1
            # Of several that took one slot one has it.
            lost = self.slots[slot] != base + left + 1
            self.keys[slot[~lost]] = hashes[left[~lost]]
            left, slot = left[lost], (slot[lost] + 1) & mask

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, plain: np.ndarray) -> None:
        """Remember the ids of new spans. Plain ones start with a space and end with none, so many are encoded as one
        text, which is cut by the bytes that each token stands for."""
        ids, counts = [], np.zeros(len(hashes), np.int64)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        hashes, starts, sizes = hashes[order], starts[order], sizes[order]
        n_plain = int(plain.sum())
        for a in range(0, n_plain, TOGETHER):
            b = min(a + TOGETHER, n_plain)
            text = data[spread(starts[a:b], sizes[a:b])].tobytes().decode()
            ids += self._ids([text])
            cuts = np.searchsorted(np.cumsum(self.bytes_of[ids[-1]]), np.cumsum(sizes[a:b])) + 1
            counts[a:b] = np.diff(cuts, prepend=0)
        others = [data[x : x + y].tobytes().decode() for x, y in zip(starts[n_plain:], sizes[n_plain:], strict=True)]
        ids += self._ids(others)
        counts[n_plain:] = [len(x) for x in ids[len(ids) - len(others) :]]
        new = np.concatenate(ids)
        if self.used + len(new) > len(self.store):
            self.store = np.concatenate((self.store[: self.used], np.empty(self.used + 2 * len(new), np.uint32)))
        self.store[self.used : self.used + len(new)] = new
        first = self.used + np.cumsum(counts) - counts
        self.used += len(new)
        self.enter(hashes)
        self.first = np.concatenate((self.first, first))
        self.count = np.concatenate((self.count, counts))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, their number in each) of UTF-8 texts."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if not self.spans:
            ids = self._ids([data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])])
            return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
        # Cut before a space after a byte that ends no white space; the heads of texts are cuts as well.
        solid = _ends_solid(data)
        cut = np.zeros(len(data), bool)
        cut[1:] = (data[1:] == 0x20) & solid[:-1]
        cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(np.append(starts, len(data)))
        plain = (data[starts] == 0x20) & solid[starts + sizes - 1]
        hashes = hash_pieces(data, sizes)
        if len(self.known) > REMEMBERED:
            self.forget()
        at = self.find(hashes)
        lacking = np.flatnonzero(at < 0)
        if len(lacking):
            _, chosen, which = np.unique(hashes[lacking], return_index=True, return_inverse=True)
            new = lacking[chosen]
            self.learn(hashes[new], data, starts[new], sizes[new], plain[new])
            at[lacking] = self.find(hashes[new])[which]
        counts = self.count[at]
        owner = np.searchsorted(offsets, starts, "right") - 1
        return (
            self.store[spread(self.first[at], counts)],
            np.bincount(owner, counts, len(offsets) - 1).astype(np.int64),
        )


def cuts_at_spaces(library: Tokenizer) -> bool:
    """Whether a text's ids are those of its spans: words are found by the byte-level pattern, nothing is changed before
    or after, and no added token holds or takes in white space. For any other file whole texts are encoded."""
    parts = json.loads(library.to_str())
    words = parts["pre_tokenizer"] or {}
    plain = all(
        not (re.search(r"\s", x["content"]) or x["lstrip"] or x["rstrip"] or x["single_word"]) for x in parts["added_tokens"]
    )
    return (
        plain
        and parts["normalizer"] is None
        and not parts["truncation"]
        and not parts["padding"]
        and words.get("type") == "ByteLevel"
        and words.get("use_regex", True)
        and not words.get("add_prefix_space")
    )


def _ends_solid(data: np.ndarray) -> np.ndarray:
    """Whether each byte surely ends a character that is no white space: those of Unicode are U+0085, U+00A0 and some
    whose first of three bytes is E1, E2 or E3."""
    solid = (data > 0x20) & (data != 0x7F)
    high = data >= 0x80
    solid[1:] &= ~(high[1:] & (data[:-1] == 0xC2))
    solid[2:] &= ~(high[2:] & (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
    return solid


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, once per worker."""
    return Encoder(path)


def write(
    documents: DataFrame, folder: str, tokenizer_file: str, end_id: int = 0, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, append ``end_id`` and write the files. One exchange, by ranges of the key."""
    shape = (
        f"shard int, segment int, first bigint, n_ids int, keys array<{documents.schema[key].dataType.simpleString()}>, "
        "doc_starts array<int>, block_starts array<int>, blocks binary"
    )

    def work(batches):
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        keys, ids, starts, held, key_type = [], [], [], 0, None

        def row():
            blocks, places = pack(np.concatenate(ids))
            return pa.record_batch(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([held], pa.int32()),
                    pa.array([keys], pa.list_(key_type)),
                    pa.array([starts], pa.list_(pa.int32())),
                    pa.array([places], pa.list_(pa.int32())),
                    pa.array([blocks], pa.binary()),
                ],
                names=["shard", "segment", "first", "n_ids", "keys", "doc_starts", "block_starts", "blocks"],
            )

        for batch in slices(batches, text, 1 << 20):
            key_type = batch.column(key).type
            every, counts = encoder(tokenizer_file).encode(*utf8(batch.column(text)))
            # The end id after each text.
            ends = np.cumsum(counts + 1)
            closed = np.full(len(every) + len(counts), end_id, np.uint32)
            inside = np.ones(len(closed), bool)
            inside[ends - 1] = False
            closed[inside] = every
            names, at = batch.column(key).to_pylist(), 0
            while at < len(names):
                # Whole texts up to the one that fills the segment.
                base = int(ends[at - 1]) if at else 0
                stop = min(len(names), int(np.searchsorted(ends, base + SEGMENT - held)) + 1)
                keys += names[at:stop]
                starts += (ends[at:stop] - counts[at:stop] - 1 - base + held).tolist()
                ids.append(closed[base : ends[stop - 1]])
                held += int(ends[stop - 1]) - base
                at = stop
                if held >= SEGMENT:
                    yield row()
                    segment, first = segment + 1, first + held
                    keys, ids, starts, held = [], [], [], 0
        if held:
            yield row()

    tie = F.xxhash64(F.col(text))
    ordered = documents.select(key, text).repartitionByRange(F.col(key), tie).sortWithinPartitions(F.col(key), tie)
    arrow_map(ordered, work, shape).write.parquet(folder)


def read(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids`` of every document in the files; ``start`` counts the ids of all before it.

    The sizes of the shards are one row for each task that wrote; their running sum is the only thing gathered.
    """
    segments = spark.read.parquet(folder)
    key_type = segments.schema["keys"].dataType.elementType.simpleString()

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["blocks"], row["block_starts"]).astype("<u4")
                bounds = [*row["doc_starts"], row["n_ids"]]
                pieces = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                n = len(pieces)
                yield pa.record_batch(
                    [
                        pa.array(row["keys"], batch.schema.field("keys").type.value_type),
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array([row["first"] + x for x in row["doc_starts"]], pa.int64()),
                        pa.array([len(x) // 4 for x in pieces], pa.int64()),
                        pa.array(pieces, pa.binary()),
                    ],
                    names=[key, "shard", "start", "n_tokens", "ids"],
                )

    documents = arrow_map(segments, work, f"`{key}` {key_type}, shard int, start bigint, n_tokens bigint, ids binary")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    offsets = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    # A row for each writing task: small enough to broadcast, so the ids are not exchanged.
    return documents.join(F.broadcast(offsets), "shard").select(key, (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")

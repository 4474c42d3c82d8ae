"""An interpolated modified Kneser-Ney bigram model, counted by Spark, kept in sorted arrays that workers map.

1. Tasks count the words of training documents and send them packed by ranges of their 64-bit hash; merged ranges are
   files of sorted hashes with counts. A word's number is its place in that order over all files.
2. A second pass counts pairs of numbers and sends them packed by the range of the first word (and ``SPLIT`` groups of
   the second, so that what follows a very frequent word is spread); merged ranges are files of sorted pairs with counts.
3. From the pairs come, for each word, with how many words it was followed once, twice and more often, and how many
   different words came before it; these go to files by ranges of numbers.
4. Scoring maps the files and looks up the different words and pairs of each slice of documents.

Tokens are words ``[^\x20\x09-\x0D]+``, A-Z in lower case, then one end. The end also stands before the first word, so
every token has a context, and a word's count is that of the pairs it begins. A pair has

    p(w | v) = max(c(vw) - D(c(vw)), 0) / c(v) + back(v) p(w),  back(v) = (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v)
    p(w) = max(b(w) - E(b(w)), 0) / B + rest / (V + 1)

with b(w) the different words before w, B their sum, D and E the modified discounts by count 1, 2 and 3 or more, and an
even share for each known word and one for all unknown ones. A context never met leaves p(w).

Null and empty texts are one end. Without training documents every token has probability one. Words are told apart by
64 bits, and there may be 2^32 of them. Only the named columns are read; repeated rows count as often as they stand.
"""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.columns import NOT_SPACE, U64, Words, constants, lower, slices, utf8
from benchloom.llm.shared import mapped, new_folder, write_file
from benchloom.llm.ship import arrow_map, kind

END = constants(1, 7)[0]
#: Tokens that a task counts before it sends.
GATHERED = 3 << 20
#: Groups of second words in a range of pairs.
SPLIT = 4
STATISTICS = ("once", "twice", "often", "before")


class Model(NamedTuple):
    folder: str
    bits: int  # words are in 2^bits ranges
    bases: np.ndarray  # number of the first word of each range, then the number of words
    tokens: int
    pairs: int  # different ones
    discounts: np.ndarray  # of pairs, by min(count, 3)
    lower_discounts: np.ndarray
    rest: float  # probability that the lower order gives to the even share
    files: frozenset[int]  # ranges that hold pairs


def tokens(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, first token of each document and the number of tokens)."""
    data, offsets = utf8(batch.column(text))
    words = Words(lower(data), offsets, NOT_SPACE)
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, U64)
    inside = np.ones(len(out), bool)
    inside[first[1:] - 1] = False
    out[inside] = words.hashes()
    return out, first


def store(uri: str, *columns: np.ndarray) -> None:
    """Write columns of whole numbers; those of 64 bits as they are, others as bytes with a list of larger ones."""
    parts = [np.array([len(columns[0])], np.int64)]
    for column in columns:
        if column.dtype == U64:
            parts.append(column)
            continue
        large = np.flatnonzero(column >= 255)
        small = np.minimum(column, 255).astype(np.uint8)
        parts += [np.array([len(large)], np.int64), large, column[large].astype(np.int64)]
        parts += [small, np.zeros(-len(small) % 8, np.uint8)]
    write_file(uri, *parts)


class Stored:
    """Columns written by ``store``, mapped."""

    def __init__(self, uri: str, keys: int, counts: int) -> None:
        data = mapped(uri)
        self.n, at = int(data[:8].view(np.int64)[0]), 8
        self.keys, self.counts = [], []
        for _ in range(keys):
            self.keys.append(data[at : at + 8 * self.n].view(U64))
            at += 8 * self.n
        for _ in range(counts):
            m = int(data[at : at + 8].view(np.int64)[0])
            at += 8
            place, value = data[at : at + 8 * m].view(np.int64), data[at + 8 * m : at + 16 * m].view(np.int64)
            at += 16 * m
            self.counts.append((data[at : at + self.n], place, value))
            at += self.n + -self.n % 8

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The places of keys, -1 for those that are not there."""
        at = np.searchsorted(self.keys[0], keys)
        at[at == self.n] = 0
        return np.where(self.keys[0][at] == keys, at, -1) if self.n else np.full(len(keys), -1)

    def count(self, column: int, at: np.ndarray) -> np.ndarray:
        small, place, value = self.counts[column]
        out = small[at].astype(np.int64)
        large = np.flatnonzero(out == 255)
        out[large] = value[np.searchsorted(place, at[large])]
        return out


stored = lru_cache(maxsize=4096)(Stored)


def _blobs(places: np.ndarray, *columns: np.ndarray):
    """A record for each run of equal places, its columns packed."""
    ends = np.flatnonzero(np.concatenate((places[1:] != places[:-1], [True]))) + 1 if len(places) else []
    start = 0
    for end in ends:
        blobs = [pa.array([column[start:end].tobytes()], pa.binary()) for column in columns]
        yield pa.record_batch(
            [pa.array([int(places[start])], pa.int64()), *blobs], names=["place", *"abcde"[: len(columns)]]
        )
        start = end


def _sums(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sorted different keys, and the sums of the other columns."""
    keys, *counts = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[heads], *(np.add.reduceat(x[order], heads) for x in counts)


def _merged(batches, forms, finish):
    """Sum the packed columns of each place, reducing as they come; ``finish`` gives what a place yields."""
    place, held, n, least = None, [], 0, GATHERED
    for batch in batches:
        for at, *blobs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != place:
                if place is not None:
                    yield from finish(place, *_sums(held))
                place, held, n, least = at, [], 0, GATHERED
            held.append(tuple(np.frombuffer(b, f).astype(g) for b, (f, g) in zip(blobs, forms, strict=True)))
            n += len(held[-1][0])
            if n >= least:
                held = [_sums(held)]
                n = len(held[0][0])
                least = max(GATHERED, 2 * n)
    if place is not None:
        yield from finish(place, *_sums(held))


def _counted(documents: DataFrame, text: str, keys_of, place_of) -> DataFrame:
    """Different keys of the documents, with counts, packed by place. ``place_of`` must not fall as keys rise."""

    def work(batches):
        held, n = [], 0

        def send():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return _blobs_of(keys, counts)

        for batch in slices(batches, text):
            held.append(keys_of(batch))
            n += len(held[-1])
            if n >= GATHERED:
                yield from send()
                held, n = [], 0
        if n:
            yield from send()

    def _blobs_of(keys, counts):
        places = place_of(keys)
        order = np.argsort(places, kind="stable")
        keys, counts, places = keys[order], counts[order], places[order]
        # Halves of the keys apart: the upper ones repeat and compress.
        yield from _blobs(places, (keys >> U64(32)).astype("<u4"), keys.astype("<u4"), counts.astype("<u4"))

    return arrow_map(documents.select(text), work, "place bigint, a binary, b binary, c binary")


def _joined_halves(batches):
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        for place, high, low, counts in rows:
            keys = (np.frombuffer(high, "<u4").astype(U64) << U64(32)) | np.frombuffer(low, "<u4")
            yield pa.record_batch(
                [pa.array([place], pa.int64()), pa.array([keys.tobytes()], pa.binary()), pa.array([counts], pa.binary())],
                names=["place", "a", "b"],
            )


def numbers(model: Model, hashes: np.ndarray) -> np.ndarray:
    """The number of each (different) word, -1 for unknown ones."""
    out = np.full(len(hashes), -1, np.int64)
    places = (hashes >> U64(64 - model.bits)).astype(np.int64)
    for place in np.unique(places):
        if model.bases[place] == model.bases[place + 1]:
            continue
        mine = np.flatnonzero(places == place)
        at = stored(f"{model.folder}/words-{place}", 1, 1).find(hashes[mine])
        out[mine] = np.where(at >= 0, at + model.bases[place], -1)
    return out


def _pairs(model: Model, batch: pa.RecordBatch, text: str) -> np.ndarray:
    hashes, first = tokens(batch, text)
    words, which = np.unique(hashes, return_inverse=True)
    number = numbers(model, words)[which].astype(U64)
    before = np.concatenate((number[-1:], number[:-1]))  # a text's last token is the end, as what stands before it
    return (before << U64(32)) | number


def _pair_place(model: Model, keys: np.ndarray) -> np.ndarray:
    first, second = (keys >> U64(32)).astype(np.int64), keys.astype(np.uint32).astype(np.int64)
    return (np.searchsorted(model.bases, first, "right") - 1) * SPLIT + second % SPLIT


def discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts by min(count, 3), from how often each count from 1 to 4 occurs."""
    n1, n2, n3, n4 = (float(x) for x in counts)
    plain = n1 / (n1 + 2 * n2) if n1 else 0.5
    found = [0.0]
    for i, (low, high) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
        found.append(min(max(i - (i + 1) * plain * high / low, 0.0), float(i)) if low and high else 0.5 * i)
    return np.array(found)


def fit(documents: DataFrame, train: Column, text: str = "text") -> Model:
    """Count the documents for which ``train`` holds and write the model to the shared folder."""
    folder = new_folder(documents.sparkSession, "kneser-ney")
    chosen = documents.where(train).select(text)
    size = chosen.agg(F.sum(F.octet_length(text)).alias("size")).first().size or 0
    bits = max(3, int(size >> 25).bit_length())
    n_ranges = 1 << bits

    def write_words(place, keys, counts):
        store(f"{folder}/words-{place}", keys, counts)
        yield pa.record_batch(
            [pa.array([x], pa.int64()) for x in (place, len(keys), int(counts.sum()))], names=["place", "n", "tokens"]
        )

    def merge_words(batches):
        yield from _merged(_joined_halves(batches), ((U64, U64), ("<u4", np.int64)), write_words)

    words = _counted(chosen, text, lambda b: tokens(b, text)[0], lambda k: (k >> U64(64 - bits)).astype(np.int64))
    words = words.repartition("place").sortWithinPartitions("place")
    # One row for each range.
    made = {r.place: r for r in arrow_map(words, merge_words, "place bigint, n bigint, tokens bigint").collect()}
    bases = np.concatenate(([0], np.cumsum([made[i].n if i in made else 0 for i in range(n_ranges)])))
    if bases[-1] >= 1 << 32:
        raise ValueError(f"{bases[-1]} different words; numbers of words have 32 bits")
    n_tokens = sum(r.tokens for r in made.values())
    model = Model(folder, bits, bases, n_tokens, 0, np.zeros(4), np.zeros(4), 0.0, frozenset())

    def write_pairs(place, keys, counts):
        store(f"{folder}/pairs-{place}", keys, counts)
        first, second = (keys >> U64(32)).astype(np.int64), keys.astype(np.uint32).astype(np.int64)
        kinds = np.bincount(np.minimum(counts, 5), minlength=6)
        yield pa.record_batch(
            [pa.array([-1], pa.int64()), *(pa.array([x], pa.binary()) for x in (kinds.astype("<i8").tobytes(), str(place).encode(), b"", b"", b""))],
            names=["place", *"abcde"],
        )
        heads = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
        level = np.minimum(counts, 3)
        sums = [np.add.reduceat((level == i).astype(np.int64), heads) for i in (1, 2, 3)]
        yield from _sent(first[heads], *sums, np.zeros(len(heads), np.int64))
        later, times = np.unique(second, return_counts=True)
        none = np.zeros(len(later), np.int64)
        yield from _sent(later, none, none, none, times)

    def _sent(number, *sums):
        places = np.searchsorted(bases, number, "right") - 1
        yield from _blobs(places, (number - bases[places]).astype("<u4"), *(x.astype("<u4") for x in sums))

    def merge_pairs(batches):
        yield from _merged(_joined_halves(batches), ((U64, U64), ("<u4", np.int64)), write_pairs)

    pairs = _counted(chosen, text, lambda b: _pairs(model, b, text), lambda k: _pair_place(model, k))
    pairs = pairs.repartition("place").sortWithinPartitions("place")
    columns = "place bigint, a binary, b binary, c binary, d binary, e binary"
    # Written, so that the pairs are counted once for the two things that are made of them.
    facts_of = new_folder(documents.sparkSession, "kneser-ney-facts")
    arrow_map(pairs, merge_pairs, columns).write.parquet(facts_of)
    facts = documents.sparkSession.read.schema(columns).parquet(facts_of)

    def write_statistics(place, number, *sums):
        n = int(bases[place + 1] - bases[place])
        dense = np.zeros((4, n), np.int64)
        dense[:, number.astype(np.int64)] = sums
        store(f"{folder}/statistics-{place}", *dense)
        kinds = np.bincount(np.minimum(dense[3], 5), minlength=6)
        yield pa.record_batch([pa.array([kinds.astype("<i8").tobytes()], pa.binary())], names=["kinds"])

    def merge_statistics(batches):
        forms = (("<u4", U64), *(("<u4", np.int64),) * 4)
        yield from _merged(batches, forms, write_statistics)

    spread = facts.where("place >= 0").repartition("place").sortWithinPartitions("place")
    kinds, files = np.zeros((2, 6), np.int64), set()
    for row in facts.where("place = -1").select("a", "b").collect():  # one row for each range, here and below
        kinds[0] += np.frombuffer(row.a, "<i8")
        files.add(int(row.b))
    for row in arrow_map(spread, merge_statistics, "kinds binary").collect():
        kinds[1] += np.frombuffer(row.kinds, "<i8")
    n_pairs, words_met = int(kinds[0].sum()), int(kinds[1][1:].sum())
    above, below = discounts(kinds[0][1:5]), discounts(kinds[1][1:5])
    taken = below[1] * kinds[1][1] + below[2] * kinds[1][2] + below[3] * (words_met - kinds[1][1] - kinds[1][2])
    return model._replace(
        pairs=n_pairs,
        discounts=above,
        lower_discounts=below,
        rest=float(taken / n_pairs) if n_pairs else 1.0,
        files=frozenset(files),
    )


def probabilities(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count in training, log10 probability) of every token of whole documents that follow each other."""
    words, which = np.unique(hashes, return_inverse=True)
    number = numbers(model, words)
    facts = np.zeros((5, len(words)), np.int64)
    known = np.flatnonzero(number >= 0)
    places = np.searchsorted(model.bases, number[known], "right") - 1
    for place in np.unique(places):
        mine = known[places == place]
        at = number[mine] - model.bases[place]
        facts[0, mine] = stored(f"{model.folder}/words-{place}", 1, 1).count(0, at)
        statistics = stored(f"{model.folder}/statistics-{place}", 0, 4)
        for i in range(4):
            facts[i + 1, mine] = statistics.count(i, at)
    count, once, twice, often, different = facts
    d, e = model.discounts, model.lower_discounts
    lower_order = np.maximum(different - e[np.minimum(different, 3)], 0) / max(model.pairs, 1)
    lower_order = lower_order + model.rest / (model.bases[-1] + 1)
    back = np.where(count > 0, (d[1] * once + d[2] * twice + d[3] * often) / np.maximum(count, 1), 1.0)

    before = np.concatenate((which[-1:], which[:-1]))
    ids, previous = number[which], number[before]
    met = np.flatnonzero((ids >= 0) & (previous >= 0))
    pairs, of = np.unique((previous[met].astype(U64) << U64(32)) | ids[met].astype(U64), return_inverse=True)
    times = np.zeros(len(pairs), np.int64)
    places = _pair_place(model, pairs)
    for place in np.unique(places):
        if int(place) not in model.files:
            continue
        mine = np.flatnonzero(places == place)
        file = stored(f"{model.folder}/pairs-{place}", 1, 1)
        found = file.find(pairs[mine])
        here = found >= 0
        times[mine[here]] = file.count(0, found[here])
    seen = np.zeros(len(hashes), np.int64)
    seen[met] = times[of]
    own = np.maximum(seen - d[np.minimum(seen, 3)], 0) / np.maximum(count[before], 1)
    return count[which], np.log10(own + back[before] * lower_order[which])


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, n_known, base_score, score, perplexity`` of every document.

    ``base_score`` adds log10((c + 1) / (N + V + 1)) over tokens, for comparison; ``perplexity`` is 10 to the negative
    mean of the log10 probabilities that make up ``score``.
    """
    whole = model.tokens + int(model.bases[-1]) + 1

    def work(batches):
        for batch in slices(batches, text):
            hashes, first = tokens(batch, text)
            counts, logs = probabilities(model, hashes)
            n = np.diff(first)
            total = np.add.reduceat(logs, first[:-1])
            base = np.add.reduceat(np.log10((counts + 1) / whole), first[:-1])
            known = np.add.reduceat((counts > 0).astype(np.int64), first[:-1])
            columns = [pa.array(x) for x in (n, known, base, total, 10 ** (-total / n))]
            yield pa.record_batch(
                [batch.column(key), *columns],
                names=[key, "n_tokens", "n_known", "base_score", "score", "perplexity"],
            )

    shape = f"{kind(documents, key)}, n_tokens bigint, n_known bigint, base_score double, score double, perplexity double"
    return arrow_map(documents.select(key, text), work, shape)

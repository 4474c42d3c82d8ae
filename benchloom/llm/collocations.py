"""Collocations: phrases of two to four words whose parts rarely stand without each other, by language.

1. Rabin-Karp fingerprints. The words of a slice are hashed, powers of an odd base weigh them, and a prefix sum of these
   products (modulo 2^64) gives the fingerprint of any run of words as one difference, scaled back by the base's inverse.
   Each task reduces equal fingerprints to (count, least address, check) and sends packed arrays by ranges of
   fingerprints. An address points to one occurrence: the hash of its text plus the number of its first word.
2. Words and pairs are counted in one pass; triples in a second, only where both their pairs are frequent; quadruples in a
   third, only where both their triples are. A frequent phrase has frequent parts, so none is lost. The frequent
   fingerprints set bits of a filter of bounded size, which may let others through; those are counted and dropped.
3. A pass over the texts writes out the phrases that stand at the addresses of frequent fingerprints, nothing else.
4. A fingerprint under which two checks (another 31 bits, of a second polynomial) were met is a collision. All its
   occurrences are then counted by their text in a further pass, which runs only if there are such fingerprints.
5. Scores, the removal of phrases within longer ones and the ranks are joins and windows over the frequent phrases.

A-Z are lower-cased. Texts are cut at ``[.,;:!?\x0A-\x0D]`` into pieces, and pieces into words ``[^\x20\x09]+``. Null and empty
texts have no words; a null language counts as ``und``; repeated rows count again; an empty table gives no rows. Texts of
any length are read whole. Only the named columns are read.

Ties in score go to the larger count, then to the phrase that is first in the order of UTF-8 bytes. A language with
millions of candidates is ranked in buckets first, of which each passes on no more than the rows asked for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchloom.llm.columns import U64, Words, byte_table, hash_pieces, lower, mix, slices, utf8
from benchloom.llm.components import written
from benchloom.llm.shared import mapped, new_folder, write_file
from benchloom.llm.ship import arrow_map

LONGEST = 4
LEAST = 30
ROWS = 2000
#: A candidate goes if a longer one around it has so many hundredths of its occurrences.
WITHIN = 80
SCALE = 2_000_000
#: Entries that a task gathers before it sends them, phrases that it remembers to have written, and bytes of text for
#: each range of fingerprints.
GATHERED, REMEMBERED = 3 << 19, 1 << 17
RANGE_BYTES = 8 << 20
#: Bits of one file of a filter, and the most files.
FILTER_BITS, FILTER_FILES = 1 << 27, 64
#: Bits of a fingerprint that are used; fewer only in tests of collisions.
PRINT_BITS = 64
#: Buckets of a language's candidates when they are ranked.
BUCKETS = 64

BREAK = byte_table((0x0A, 0x0D), *((ord(c), ord(c)) for c in ".,;:!?"))
IN_WORD = ~(BREAK | byte_table((0x20, 0x20), (0x09, 0x09)))

_BASE, _OTHER = U64(0xD1342543DE82EF95), U64(0xAF251AF3B0F025B5)
_SALT = U64(0x9E6C63D0876A9A47)


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0 … base^(n-1) and their inverses, modulo 2^64."""
    inverse = U64(pow(int(base), -1, 1 << 64))
    both = []
    for x in (base, inverse):
        line = np.full(n, x, U64)
        line[:1] = 1
        both.append(np.multiply.accumulate(line))
    return both[0], both[1]


class Grams:
    """The words of a slice of texts and the fingerprints of runs of them."""

    def __init__(self, batch: pa.RecordBatch, text: str, lang: str, bits: int = PRINT_BITS) -> None:
        self.bits = bits
        data, offsets = utf8(batch.column(text))
        self.data, self.offsets = lower(data), offsets
        self.words = words = Words(self.data, offsets, IN_WORD)
        self.n = len(words.starts)
        self.owner = words.documents()
        breaks = np.cumsum(BREAK[self.data], dtype=np.int64)
        piece = breaks[words.starts] if self.n else np.empty(0, np.int64)
        new = np.ones(self.n, bool)
        new[1:] = (piece[1:] != piece[:-1]) | (self.owner[1:] != self.owner[:-1])
        self.piece = np.cumsum(new)
        named = batch.column(lang).cast(pa.string()).fill_null("und").dictionary_encode()
        self.langs, self.lang = named.dictionary.to_pylist(), named.indices.to_numpy()
        digests = [hashlib.blake2b(x.encode(), digest_size=16).digest() for x in self.langs]
        salts = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
        self.salt = salts[self.lang[self.owner], 0] if self.n else np.empty(0, U64)
        self.other_salt = salts[self.lang[self.owner], 1] if self.n else np.empty(0, U64)
        hashes = words.hashes()
        self.sums = [self._prefix(hashes, _BASE), self._prefix(mix(hashes ^ _SALT), _OTHER)]

    @staticmethod
    def _prefix(hashes: np.ndarray, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        up, down = powers(base, len(hashes))
        return np.concatenate((np.zeros(1, U64), np.cumsum(hashes * up, dtype=U64))), down

    def places(self, size: int) -> np.ndarray:
        """Words at which ``size`` words of one piece start."""
        if self.n < size:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[size - 1 :] == self.piece[: self.n - size + 1])

    def _run(self, which: int, at: np.ndarray, size: int) -> np.ndarray:
        sums, down = self.sums[which]
        return (sums[at + size] - sums[at]) * down[at]

    def prints(self, at: np.ndarray, size: int) -> np.ndarray:
        """The fingerprint of the ``size`` words from each place, the language included."""
        found = mix(self._run(0, at, size) + self.salt[at])
        return found if self.bits == 64 else found & U64(((1 << self.bits) - 1) << (64 - self.bits))

    def checks(self, at: np.ndarray, size: int) -> np.ndarray:
        """31 more bits, never 0."""
        return (mix(self._run(1, at, size) + self.other_salt[at]) >> U64(32)).astype(np.uint32) | np.uint32(1)

    def addresses(self, at: np.ndarray) -> np.ndarray:
        """The occurrence: hash of the text plus the word's number."""
        sizes = np.diff(self.offsets)
        base = np.zeros(len(sizes), U64)
        some = np.flatnonzero(sizes)
        base[some] = hash_pieces(self.data, sizes[some])
        owner = self.owner[at]
        return base[owner] + (at - self.words.first[owner]).astype(U64)

    def phrase(self, at: int, size: int) -> str:
        """The words, joined by one space."""
        spans = zip(self.words.starts[at : at + size], self.words.ends[at : at + size], strict=True)
        return b" ".join(self.data[a:b].tobytes() for a, b in spans).decode()


def reduced(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One entry of each fingerprint, sorted: count, least address, check; the check is 0 once two were met."""
    prints, counts, addresses, checks = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(prints)
    prints, counts, addresses, checks = (x[order] for x in (prints, counts, addresses, checks))
    heads = np.flatnonzero(np.concatenate((np.ones(min(1, len(prints)), bool), prints[1:] != prints[:-1])))
    if not len(heads):
        return [prints, counts, addresses, checks]
    least = np.minimum.reduceat(checks, heads)
    least[least != np.maximum.reduceat(checks, heads)] = 0
    return [prints[heads], np.add.reduceat(counts, heads), np.minimum.reduceat(addresses, heads), least]


_FORMS = (U64, np.int64, U64, np.uint32)


def _packed(n: int, entries: list[np.ndarray], bits: int):
    """A row for each range of fingerprints; counts of 1, as most are, take no room."""
    places = (entries[0] >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(entries[0]), np.int64)
    ends = np.flatnonzero(np.concatenate((places[1:] != places[:-1], [True]))) + 1
    for start, end in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
        prints, counts, addresses, checks = (x[start:end] for x in entries)
        more = np.flatnonzero(counts > 1)
        head = np.array([end - start, len(more)], "<i8")
        blob = b"".join(x.tobytes() for x in (head, prints, addresses, checks, more.astype("<u4"), counts[more]))
        yield pa.record_batch(
            [pa.array([n], pa.int32()), pa.array([int(places[start])], pa.int64()), pa.array([blob], pa.binary())],
            names=["n", "place", "grams"],
        )


def _unpacked(blob: pa.Buffer) -> list[np.ndarray]:
    size, more = (int(x) for x in np.frombuffer(blob, "<i8", 2))
    parts, at = [], 16
    for form, n in ((U64, size), (U64, size), (np.uint32, size), (np.uint32, more), (np.int64, more)):
        parts.append(np.frombuffer(blob, np.uint8, n * np.dtype(form).itemsize, at).view(form))
        at += parts[-1].nbytes
    counts = np.ones(size, np.int64)
    counts[parts[3]] = parts[4]
    return [parts[0], counts, parts[1], parts[2]]


class Filter:
    """Bits of 64-bit keys in a few files of bounded size: never misses a key, may let others through."""

    def __init__(self, folder: str, files: int, bits: int) -> None:
        self.folder, self.files, self.bits = folder, files, bits

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the filter."""
        if not self.files:
            return np.zeros(len(keys), bool)
        file, bit = self.cells(keys)
        if self.files == 1:
            return self._bits(0, bit)
        result = np.zeros(len(keys), bool)
        for i in range(self.files):
            mine = np.flatnonzero(file == i)
            result[mine] = self._bits(i, bit[mine])
        return result

    def _bits(self, file: int, bit: np.ndarray) -> np.ndarray:
        stored = mapped(f"{self.folder}/bits-{file:03d}")
        return ((stored[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)

    def cells(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = mix(keys ^ _SALT)
        return (keys % U64(self.files)).astype(np.int64), (keys >> U64(32)).astype(np.int64) & (self.bits - 1)


def build_filter(keys: DataFrame, size: int) -> Filter:
    """A filter of the column ``key`` (whole numbers, about ``size`` rows), each file written by one task."""
    files = 0 if not size else min(FILTER_FILES, -(-size * 16 // FILTER_BITS))
    folder = new_folder(keys.sparkSession, "filter")
    made = Filter(folder, files, FILTER_BITS)
    if not files:
        return made

    def cells(batches):
        for batch in batches:
            file, bit = made.cells(batch.column(0).to_numpy().view(U64))
            yield pa.record_batch([pa.array(file, pa.int64()), pa.array(bit, pa.int64())], names=["file", "bit"])

    def write(batches):
        file, bits = None, None
        for batch in batches:
            of, bit = (x.to_numpy() for x in batch.columns)
            for i in np.unique(of):  # sorted, so files come one after the other
                if i != file:
                    if file is not None:
                        yield _write(file, bits)
                    file, bits = i, np.zeros(made.bits >> 3, np.uint8)
                np.bitwise_or.at(bits, bit[of == i] >> 3, np.uint8(1) << (bit[of == i] & 7).astype(np.uint8))
        if file is not None:
            yield _write(file, bits)

    def _write(file, bits):
        write_file(f"{folder}/bits-{file:03d}", bits)
        return pa.record_batch([pa.array([int(file)], pa.int64())], names=["file"])

    dealt = arrow_map(keys, cells, "file bigint, bit bigint").distinct()
    done = arrow_map(dealt.repartition("file").sortWithinPartitions("file"), write, "file bigint")
    done.agg(F.count("*")).collect()
    return made


def count_grams(documents: DataFrame, text: str, lang: str, sizes: tuple[int, ...], least: int, bits: int, frequent: Filter | None) -> DataFrame:
    """``n, print, address, check, f`` of the fingerprints of runs of so many words that are met ``least`` times or more;
    of longer runs only those are counted of which both parts without an end word may be frequent."""

    def gather(batches):
        held, n = {size: [] for size in sizes}, 0
        for batch in slices(batches, text):
            grams = Grams(batch, text, lang, PRINT_BITS)
            for size in sizes:
                at = grams.places(size)
                if frequent is not None and len(at):
                    part = grams.places(size - 1)
                    may = np.zeros(grams.n, bool)
                    may[part] = frequent.holds(grams.prints(part, size - 1))
                    at = at[may[at] & may[at + 1]]
                if len(at):
                    held[size].append([grams.prints(at, size), np.ones(len(at), np.int64), grams.addresses(at), grams.checks(at, size)])
                    n += len(at)
            if n >= GATHERED:
                held = {size: [reduced(x)] if x else [] for size, x in held.items()}
                n = sum(len(x[0][0]) for x in held.values() if x)
                if 2 * n >= GATHERED:
                    yield from send(held)
                    held, n = {size: [] for size in sizes}, 0
        yield from send({size: [reduced(x)] for size, x in held.items() if x})

    def send(held):
        for size, entries in held.items():
            if entries and len(entries[0][0]):
                yield from _packed(size, entries[0], bits)

    def merge(batches):
        place, held, n, most = None, [], 0, GATHERED
        for batch in batches:
            for size, at, blob in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2), strict=True):
                if (size, at) != place:
                    if held:
                        yield found(place[0], reduced(held))
                    place, held, n, most = (size, at), [], 0, GATHERED
                held.append(_unpacked(blob.as_buffer()))
                n += len(held[-1][0])
                if n >= most:
                    held = [reduced(held)]
                    n = len(held[0][0])
                    most = max(GATHERED, 2 * n)
        if held:
            yield found(place[0], reduced(held))

    def found(size, entries):
        prints, counts, addresses, checks = (x[entries[1] >= least] for x in entries)
        arrays = [np.full(len(prints), size), prints.view(np.int64), addresses.view(np.int64), checks.astype(np.int64), counts]
        return pa.record_batch([pa.array(x, pa.int64()) for x in arrays], names=["n", "print", "address", "check", "f"])

    sent = arrow_map(documents.select(text, lang), gather, "n int, place bigint, grams binary")
    dealt = sent.repartition(len(sizes) << bits, "n", "place").sortWithinPartitions("n", "place")
    return written(arrow_map(dealt, merge, "n bigint, print bigint, address bigint, check bigint, f bigint"), "grams")


def _keys(prints: np.ndarray, size: int) -> np.ndarray:
    return prints + U64(size * int(_SALT) & (1 << 64) - 1)


def write_out(documents: DataFrame, text: str, lang: str, longest: int, wanted: Filter) -> DataFrame:
    """``lang, n, print, address, phrase`` of what stands at the wanted addresses and of some other places; of each
    language a row for each task with its number of words, where n is 0 and the address is that number."""

    def work(batches):
        seen, totals = set(), {}
        for batch in slices(batches, text):
            grams, rows = Grams(batch, text, lang, PRINT_BITS), []
            for i, n in enumerate(np.bincount(grams.lang[grams.owner], minlength=len(grams.langs)) if grams.n else ()):
                totals[grams.langs[i]] = totals.get(grams.langs[i], 0) + int(n)
            for size in range(1, longest + 1):
                at = grams.places(size)
                if not len(at):
                    continue
                prints, addresses = grams.prints(at, size), grams.addresses(at)
                hit = np.flatnonzero(wanted.holds(mix(_keys(prints, size)) + addresses))
                for i, key, address in zip(at[hit].tolist(), prints[hit].view(np.int64).tolist(), addresses[hit].view(np.int64).tolist(), strict=True):
                    if (size, key, address) not in seen:
                        seen.add((size, key, address))
                        rows.append((grams.langs[grams.lang[grams.owner[i]]], size, key, address, grams.phrase(i, size)))
            if len(seen) > REMEMBERED:  # what is forgotten may be sent again
                seen = set()
            if rows:
                yield batch_of(rows)
        if totals:
            yield batch_of([(name, 0, 0, n, "") for name, n in totals.items() if n])

    def batch_of(rows):
        forms = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*rows, strict=True) if rows else [()] * 5
        return pa.record_batch([pa.array(list(x), form) for x, form in zip(columns, forms, strict=True)], names=["lang", "n", "print", "address", "phrase"])

    shape = "lang string, n bigint, print bigint, address bigint, phrase string"
    return written(arrow_map(documents.select(text, lang), work, shape), "phrases")


def count_texts(documents: DataFrame, text: str, lang: str, longest: int, mixed: Filter) -> DataFrame:
    """``lang, n, print, phrase, f`` of all places whose fingerprint may be a collision, counted by their words."""

    def work(batches):
        for batch in slices(batches, text):
            grams, counts = Grams(batch, text, lang, PRINT_BITS), {}
            for size in range(1, longest + 1):
                at = grams.places(size)
                prints = grams.prints(at, size) if len(at) else np.empty(0, U64)
                hit = np.flatnonzero(mixed.holds(_keys(prints, size)))
                for i, key in zip(at[hit].tolist(), prints[hit].view(np.int64).tolist(), strict=True):
                    row = (grams.langs[grams.lang[grams.owner[i]]], size, key, grams.phrase(i, size))
                    counts[row] = counts.get(row, 0) + 1
            if counts:
                names, sizes, keys, phrases = zip(*counts, strict=True)
                yield pa.record_batch(
                    [pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), pa.array(phrases, pa.string()), pa.array(list(counts.values()), pa.int64())],
                    names=["lang", "n", "print", "phrase", "f"],
                )

    rows = arrow_map(documents.select(text, lang), work, "lang string, n bigint, print bigint, phrase string, f bigint")
    return rows.groupBy("lang", "n", "print", "phrase").agg(F.sum("f").alias("f"))


def phrases(
    documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST
) -> tuple[DataFrame, DataFrame]:
    """(``lang, n, phrase, f`` of every run of up to ``longest`` words that is met ``least`` times or more,
    ``lang, words`` of every language with words)."""
    size = documents.agg(F.sum(F.octet_length(text)).alias("size")).first().size or 0
    bits = max(0, (size // RANGE_BYTES).bit_length())
    counted, frequent = count_grams(documents, text, lang, (1, 2), least, bits, None), None
    every = counted
    for n in range(3, longest + 1):
        last = counted.where(F.col("n") == n - 1)
        frequent = build_filter(last.select("print"), last.count())
        counted = count_grams(documents, text, lang, (n,), least, bits, frequent)
        every = every.union(counted)
    every = written(every.where(F.col("n") <= longest), "grams")

    def addressed(batches):
        for batch in batches:
            n, prints, address = (x.to_numpy().view(U64) for x in batch.columns)
            yield pa.record_batch([pa.array((mix(prints + n * _SALT) + address).view(np.int64))], names=["key"])

    wanted = build_filter(arrow_map(every.select("n", "print", "address"), addressed, "key bigint"), every.count())
    rows = write_out(documents, text, lang, longest, wanted)
    totals = rows.where("n = 0").groupBy("lang").agg(F.sum("address").alias("words"))
    texts = rows.where("n > 0").groupBy("n", "print", "address").agg(F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))
    named = texts.join(every.where("check != 0"), ["n", "print", "address"]).select("lang", "n", "phrase", "f")
    collisions = every.where("check = 0").select("n", "print")
    if found := collisions.count():

        def mixed(batches):
            for batch in batches:
                n, prints = (x.to_numpy().view(U64) for x in batch.columns)
                yield pa.record_batch([pa.array((prints + n * _SALT).view(np.int64))], names=["key"])

        exact = count_texts(documents, text, lang, longest, build_filter(arrow_map(collisions, mixed, "key bigint"), found))
        exact = exact.join(collisions, ["n", "print"], "left_semi").where(F.col("f") >= least)
        named = named.union(exact.select("lang", "n", "phrase", "f"))
    return written(named, "phrases"), totals


def wide(column: str) -> Column:
    """A count as a decimal: products of counts may pass 64 bits."""
    return F.col(column).cast("decimal(20,0)")


def score(found: DataFrame) -> DataFrame:
    """``lang, n, phrase, a, l, r, score`` of the phrases of two words or more, cut where the score is least."""
    parts = found.select("lang", F.col("phrase").alias("part"), "f")
    words = F.split("phrase", " ", -1)
    cut = found.where("n > 1").select("lang", "n", "phrase", F.col("f").alias("a"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("n").cast("int") - 1),
        lambda k: F.struct(
            F.array_join(F.slice(words, 1, k), " ").alias("head"),
            F.array_join(F.slice(words, k + 1, F.col("n").cast("int") - k), " ").alias("tail"),
        ),
    )).alias("k", "cut"))
    cut = cut.select("lang", "n", "phrase", "a", "k", F.col("cut.head").alias("head"), F.col("cut.tail").alias("tail"))
    cut = cut.join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cut = cut.join(parts.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    cut = cut.select("lang", "n", "phrase", "a", "k", "l", "r", F.expr(f"({SCALE} * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + r)").alias("score"))
    return cut.groupBy("lang", "n", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best")).select(
        "lang", "n", "phrase", "a", "best.l", "best.r", "best.score"
    )


def outermost(scored: DataFrame, within: int = WITHIN) -> DataFrame:
    """Without the candidates of which a longer one around them has ``within`` hundredths of the occurrences."""
    words = F.split("phrase", " ", -1)
    size = F.col("n").cast("int")
    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice(words, i, m), " ")),
    ))
    around = scored.where("n > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("around"))
    around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    joined = scored.join(around, ["lang", "phrase"], "left")
    gone = F.col("around").isNotNull() & (100 * wide("around") >= within * wide("a"))
    return joined.where(~gone).drop("around")


def ranked(candidates: DataFrame, rows: int = ROWS) -> DataFrame:
    """The first ``rows`` of each language, with ``rank``."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    first = candidates.withColumn("bucket", bucket)
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    first = first.where(F.col("rank") <= rows).drop("bucket", "rank")
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return last.where(F.col("rank") <= rows)


def collocations(
    documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, rows: int = ROWS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best candidates of each language."""
    found, totals = phrases(documents, text, lang, longest, least)
    best = ranked(outermost(score(found)), rows).drop("n")
    return best.join(totals.withColumnRenamed("words", "n"), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

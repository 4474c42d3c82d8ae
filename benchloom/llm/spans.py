"""Matches of patterns as places in code points, in DataFrame functions only.

Patterns are Java's; they must not match the empty text. Matches are the leftmost ones that do not overlap. The work is
in proportion to the text, and in a text with very many matches to their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Running sums are made by runs of so many values, since each step copies what it has gathered.
RUN = 256


def running_sums(values: Column) -> Column:
    """The sums of the first 1, 2, … values of an array of whole numbers."""

    def short(x: Column) -> Column:
        start = F.array(F.lit(0).cast("bigint"))
        sums = F.aggregate(x, start, lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
        return F.slice(sums, F.lit(2), F.size(x))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0).cast("bigint"), lambda acc, v: acc + v)

    runs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(values) / F.lit(RUN)).cast("int") - 1),
        lambda i: F.slice(values, i * RUN + 1, F.lit(RUN)),
    )
    offsets = short(F.transform(runs, total))
    long = F.flatten(F.zip_with(runs, offsets, lambda run, end: F.transform(short(run), lambda x: x + end - total(run))))
    return F.when(F.size(values) <= RUN, short(values)).otherwise(long)


def running_maxima(values: Column) -> Column:
    """The largest of the first 1, 2, … values of an array of whole numbers, none negative."""

    def short(x: Column) -> Column:
        start = F.array(F.lit(0).cast("bigint"))
        tops = F.aggregate(x, start, lambda acc, v: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), v))))
        return F.slice(tops, F.lit(2), F.size(x))

    runs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(values) / F.lit(RUN)).cast("int") - 1),
        lambda i: F.slice(values, i * RUN + 1, F.lit(RUN)),
    )
    tops = short(F.transform(runs, F.array_max))
    long = F.flatten(F.zip_with(runs, F.concat(F.array(F.lit(0).cast("bigint")), F.slice(tops, F.lit(1), F.size(tops) - 1)), lambda run, before: F.transform(short(run), lambda x: F.greatest(x, before))))
    return F.when(F.size(values) <= RUN, short(values)).otherwise(long)


#: Code points of a block of text.
BLOCK = 2048


def blocks(text: Column) -> Column:
    """The text in blocks, so that a piece from its middle is found without a walk from its start."""
    last = F.floor((F.length(text) - 1) / F.lit(BLOCK)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: text.substr(i * BLOCK + 1, F.lit(BLOCK)))
    return F.when(F.length(text) > BLOCK, cut).otherwise(F.array(text))


def piece(blocked: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive) of a text in blocks."""
    first = F.floor(start / F.lit(BLOCK)).cast("int")
    last = F.floor((end - 1) / F.lit(BLOCK)).cast("int")
    joined = F.array_join(F.slice(blocked, first + 1, last - first + 1), "")
    return F.when(end > start, joined.substr((start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))).otherwise("")


def matches(text: Column, pattern: str, context: bool = False) -> Column:
    """``array<struct<start, end, found, before>>``: every match with the text between it and the one before it; with
    ``context`` the text from the second match before it on, that match included.

    ``start`` counts code points from 0 and ``end`` is exclusive. Null for null.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(found)), found, lambda gap, match: F.struct(gap.alias("before"), match.alias("found"))
    )
    ends = running_sums(F.transform(pairs, lambda p: (F.length(p["before"]) + F.length(p["found"])).cast("bigint")))
    if context:
        # Arrays moved by one and two places, not looked up by place: what a function over an array takes from outside
        # is evaluated for every element.
        whole = F.transform(pairs, lambda p: F.concat(p["before"], p["found"]))
        one, two = (F.slice(F.concat(F.array(*[F.lit("")] * n), whole), F.lit(1), F.size(found)) for n in (1, 2))
        earlier = F.zip_with(two, one, lambda a, b: F.concat(a, b))
        pairs = F.zip_with(
            earlier, pairs, lambda e, p: F.struct(F.concat(e, p["before"]).alias("before"), p["found"].alias("found"))
        )
    placed = F.zip_with(
        pairs,
        ends,
        lambda p, end: F.struct(
            (end - F.length(p["found"])).alias("start"), end.alias("end"), p["found"].alias("found"), p["before"].alias("before")
        ),
    )
    kind = "array<struct<start: bigint, end: bigint, found: string, before: string>>"
    # Most texts have no match; for them nothing but the search is evaluated.
    return F.when(F.size(found) > 0, placed).otherwise(F.array()).cast(kind)


def places(found: Column, kind: str, order: int) -> Column:
    """Matches as ``array<struct<start, order, kind, end>>``, which sorts by start and then as kinds are listed."""
    return F.transform(
        found,
        lambda m: F.struct(m["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), m["end"].alias("end")),
    )


PLACES = "array<struct<start: bigint, order: int, kind: string, end: bigint>>"


def sweeps(*keys: str) -> tuple[WindowSpec, WindowSpec]:
    """For each place its predecessors in the text, and its successors, which are those before it in the reverse order:
    both windows grow row by row, so they are linear."""
    rising = Window.partitionBy(*keys).orderBy("start", "order", "end")
    falling = Window.partitionBy(*keys).orderBy(F.desc("start"), F.desc("order"), F.desc("end"))
    return tuple(x.rowsBetween(Window.unboundedPreceding, -1) for x in (rising, falling))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of places, sorted, joined by commas."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def digest(found: DataFrame, kinds: tuple[str, ...], key: str = "doc_id") -> DataFrame:
    """The number of base spans of each kind, a hash of their list, and the list of all spans."""

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        key, *map(number, kinds), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )

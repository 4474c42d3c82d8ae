"""Documents whose sets of 5-word shingles have a Jaccard similarity of at least 0.8: classes, links, one of each class.

1. Documents with equal sets are one node with a number of copies.
2. Each node has a label in each of ``TREES`` tries: the minima of its set under ``DIGITS`` hash functions, one digit
   each. Labels are sorted over the whole cluster, so that the nodes below any node of a trie are neighbours, however
   many they are. Matching starts with whole labels, and the prefix is shortened until the recall is reached, which is
   measured: for every node as many altered copies as fit, each without another part of the shingles and so just at the
   threshold, are looked up in all tries (``reach``). First the prefix of all nodes gets shorter until ``RECALL`` of the
   copies of all nodes are met, and a pair at the threshold is expected to be met as often. Then each node that still
   loses a copy of its own gets shorter prefixes, until it meets them all (``own``). Two nodes are linked if they share
   the prefix that one of them asks for. A run of nodes is linked to its first node.
3. Candidates are compared exactly: a component is cut by set size (sets whose sizes differ by more than a fourth can't be
   similar) and then into blocks of bounded size, and each pair of blocks is one piece of work. It yields one row for
   each node with a link: how many documents it is linked to there, and one node that it is linked with, directly or
   through others. No pairs are written.
4. Components of those links are the classes.

Words are ``[^\x20\x09-\x0D]+``, unchanged; a text of one to four words has one shingle. Null and empty texts have none and
are alone. Sets and shingles are told apart by 64-bit hashes. ``class_id`` is the smallest key of the class (null where all
are null); ``n_links`` counts the other documents that are similar to a document, its copies and repeated rows included.
Keys may be of any ordered type; only the named columns are read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchloom.llm.columns import NOT_SPACE, U64, Words, constants, mix, rolling, slices, utf8
from benchloom.llm.components import components, written
from benchloom.llm.ship import arrow_map, kind, spare

SHINGLE = 5
THRESHOLD = 0.8
TREES = 24
DIGITS = 6
DIGIT_BITS = 10
RECALL = 0.9999
#: Sets and shingles in a block.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 18


def expected(threshold: float, digits: int, trees: int = TREES) -> float:
    """The probability that a pair at the threshold shares a prefix of so many digits in some trie."""
    return 1 - (1 - threshold**digits) ** trees


def depth(threshold: float, measured: list[float], recall: float = RECALL) -> int:
    """Digits of the prefix; ``measured`` has the share of copies that prefixes of 1, 2, … digits meet."""
    digits = len(measured)
    while digits > 1 and min(expected(threshold, digits), measured[digits - 1]) < recall:
        digits -= 1
    return digits


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of the different shingles of a slice of texts, by document."""
    words = Words(*utf8(column), NOT_SPACE)
    hashes, owner = words.hashes(), words.documents()
    at = words.windows(size)
    owners, found = [owner[at]], [rolling(hashes, size)[at]] if len(at) else [np.empty(0, U64)]
    for n in range(1, size):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            owners.append(short)
            found.append(rolling(hashes, n)[words.first[short]] ^ U64(n))
    owner, found = np.concatenate(owners), np.concatenate(found)
    _, first = np.unique(mix(found ^ mix(owner.astype(U64) + U64(1))), return_index=True)
    first = first[np.argsort(owner[first], kind="stable")]
    return owner[first], found[first]


def set_hashes(owner: np.ndarray, found: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each set, its size); no set has hash 0 but the empty one."""
    counts = np.bincount(owner, minlength=n)
    sums = np.zeros(n, U64)
    some = np.flatnonzero(counts)
    if len(some):
        heads = (np.cumsum(counts) - counts)[some]
        sums[some] = mix(np.add.reduceat(mix(found ^ U64(0x5851F42D4C957F2D)), heads)) | U64(1)
    return sums.view(np.int64), counts


def labels(owner: np.ndarray, found: np.ndarray, counts: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(label of each document in each trie, the longest prefix that each of its altered copies shares with it).

    ``found`` are the hashes of all documents, by document. A copy lacks a part of them that leaves it similar; the minima
    of a copy follow from those of the parts. -1 stands where a document has fewer copies.
    """
    order = np.lexsort((found, owner))  # the parts are a matter of the set alone, not of where it stands
    found = found[order]
    some = np.flatnonzero(counts)
    n = counts[some]
    heads = (np.cumsum(counts) - counts)[some]
    copies = round(1 / (1 - threshold))
    part = np.floor(n * (1 - threshold) + 1e-9).astype(np.int64)
    whole = np.where(part > 0, np.minimum(n // np.maximum(part, 1), copies), 0)
    places = np.arange(copies + 1)
    exists = (places < whole[:, None]) | ((places == whole[:, None]) & (part * whole < n)[:, None])
    starts = (heads[:, None] + part[:, None] * places)[exists]
    rows, none = np.arange(len(some)), ~U64(0)
    label, reach = np.zeros((len(counts), TREES), np.int64), np.full((len(counts), copies), -1, np.int8)
    longest = np.zeros((len(some), copies), np.int8)
    shift = U64(64 - DIGIT_BITS)
    for tree, factors in enumerate(constants(TREES * DIGITS, 11).reshape(TREES, DIGITS)):
        alive, length = np.ones(longest.shape, bool), np.zeros(longest.shape, np.int8)
        for factor in factors:
            least = np.full(exists.shape, none)
            least[exists] = np.minimum.reduceat(found * factor, starts)
            at = least.argmin(axis=1)
            digit = mix(least[rows, at]) >> shift
            least[rows, at] = none
            changed = (mix(least.min(axis=1)) >> shift) != digit
            alive &= ~((at[:, None] == places[:-1]) & changed[:, None])
            length += alive
            label[some, tree] = (label[some, tree] << DIGIT_BITS) | digit.astype(np.int64)
        np.maximum(longest, length, out=longest)
    reach[some] = np.where(places[:-1] < whole[:, None], longest, -1)
    return label, reach


def sketches(documents: DataFrame, key: str, text: str, size: int, threshold: float) -> DataFrame:
    """``key, set, n, labels, reach`` of every document."""

    def work(batches):
        for batch in slices(batches, text):
            n = batch.num_rows
            owner, found = shingles(batch.column(text), size)
            sets, counts = set_hashes(owner, found, n)
            if len(found):
                label, reach = labels(owner, found, counts, threshold)
            else:
                label, reach = np.zeros((n, TREES), np.int64), np.zeros((n, 0), np.int8)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
                for x in (label, reach)
            ]
            yield pa.record_batch(
                [batch.column(key), pa.array(sets), pa.array(counts, pa.int64()), *lists],
                names=["key", "set", "n", "labels", "reach"],
            )

    shape = f"key {documents.schema[key].dataType.simpleString()}, `set` bigint, n bigint, labels array<bigint>, reach array<tinyint>"
    return arrow_map(documents.select(key, text), work, shape)


def measure(nodes: DataFrame, threshold: float) -> tuple[int, int]:
    """(digits of the prefix of all nodes, the fewest that one of them needs). One row comes to the driver."""
    met = [F.sum(F.size(F.filter("reach", lambda x, d=d: x >= d))) for d in range(DIGITS + 1)]
    copies, *shares = nodes.agg(*met).first()
    digits = depth(threshold, [x / copies if copies else 1.0 for x in shares])
    least = nodes.agg(F.min("own")).first()[0]
    return digits, digits if least is None else min(digits, least)


#: Kinds of rows: a link in a run of the common prefix, a first or last run of a partition, a link in a run of a shorter
#: prefix, a node that asks for it.
LINK, EDGE, LONGER, ASKED = range(4)


def forest_links(nodes: DataFrame, digits: int, fewest: int) -> DataFrame:
    """``a, b``: each node with the first of its runs: of nodes that share ``digits`` digits in a trie, or fewer where one
    of the run asks for it, ``fewest`` at least. Sorted over the whole cluster."""
    asked = F.least("own", F.lit(digits)).alias("own")
    tries = nodes.select("set", asked, F.posexplode("labels").alias("tree", "label"))
    ordered = tries.repartitionByRange("tree", "label", "set").sortWithinPartitions("tree", "label", "set")
    names = ["a", "b", "tree", "level", "prefix", "kind"]

    def prefix(label, level):
        return label >> (DIGIT_BITS * (DIGITS - level))

    def rows(a, b, tree, level, prefixes, what):
        columns = (a, b, tree, np.broadcast_to(level, len(a)), prefixes, np.broadcast_to(what, len(a)))
        return pa.record_batch([pa.array(np.asarray(x, np.int64)) for x in columns], names=names)

    def runs(batches):
        last, heads = None, {}
        for batch in batches:
            node, tree, label, own = (batch.column(x).to_numpy() for x in ("set", "tree", "label", "own"))
            if not len(node):
                continue
            for level in range(digits, fewest - 1, -1):
                part = prefix(label, level)
                goes_on = last is not None and (last[0], prefix(last[1], level)) == (tree[0], part[0])
                new = np.concatenate(([not goes_on], (tree[1:] != tree[:-1]) | (part[1:] != part[:-1])))
                at = np.maximum.accumulate(np.where(new, np.arange(len(node)), -1))
                head = np.where(at >= 0, node[at], heads.get(level, 0))
                if level == digits:
                    begins, inner, what = new, np.flatnonzero(head != node), LINK
                else:  # the others of a run are linked to its first by the common prefix
                    inner, what = np.flatnonzero(begins & (head != node)), LONGER
                if len(inner):
                    yield rows(head[inner], node[inner], tree[inner], level, part[inner], what)
                if last is None:
                    yield rows(node[:1], node[:1], tree[:1], level, part[:1], EDGE)
                heads[level] = head[-1]
            short = np.flatnonzero(own < digits)
            if len(short):
                yield rows(node[short], node[short], tree[short], own[short], prefix(label[short], own[short]), ASKED)
            last = (tree[-1], label[-1])
        for level, head in heads.items():
            yield rows([head], [head], [last[0]], level, [prefix(last[1], level)], EDGE)

    found = written(arrow_map(ordered, runs, ", ".join(f"{x} bigint" for x in names)), "forest")
    # A run that goes over the end of a partition: the first nodes of its parts, two rows a level for each partition.
    run = ["tree", "level", "prefix"]
    edges = found.where(F.col("kind") == EDGE)
    heads = edges.groupBy(*run).agg(F.min("a").alias("head"))
    over = edges.join(heads, run).select(F.col("head").alias("a"), "b", *run)
    links = found.where(F.col("kind") == LINK).select("a", "b").union(over.where(F.col("level") == digits).select("a", "b"))
    if fewest < digits:
        wanted = found.where(F.col("kind") == ASKED).select(*run).distinct()
        longer = found.where(F.col("kind") == LONGER).select("a", "b", *run).union(over.where(F.col("level") < digits))
        links = links.union(longer.join(wanted, run, "left_semi").select("a", "b"))
    return links.where("a != b")


def band(n: Column, threshold: float) -> Column:
    """Sets of bands more than one apart can't be similar."""
    return F.floor(F.log(n.cast("double")) / F.lit(-np.log(threshold)) + 1e-9)


def similar(documents: DataFrame, nodes: DataFrame, clusters: DataFrame, key: str, text: str, size: int, threshold: float) -> DataFrame:
    """``node, links, other``: nodes with links, how many documents each is linked to, and a node joined to it; a node
    has a row for each piece of work that found a link."""
    members = nodes.join(clusters, nodes["set"] == clusters["node"]).select(
        "set", "key", "n", "copies", "root", band(F.col("n"), threshold).alias("band")
    )
    members = written(members, "members")
    groups = members.groupBy("root", "band").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    groups = groups.select("root", "band", blocks.cast("int").alias("blocks"), F.col("sets"))
    above = groups.select("root", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = groups.select("root", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    groups = groups.join(above, ["root", "band"], "left").join(below, ["root", "band"], "left")
    # A table of its own, so that the join below reads both sides afresh and Spark can split a large component in it.
    groups = written(groups, "groups")
    alone = (F.col("sets") == 1) & F.col("above").isNull() & F.col("below").isNull()
    placed = members.join(groups.where(~alone), ["root", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    )

    def others(count: str) -> Column:
        return F.sequence(F.lit(0), F.col(count) - 1)

    none = F.array().cast("array<struct<band: bigint, up: boolean, a: int, b: int, left: boolean>>")

    def pieces(count: str, at: Column, up: bool, a, b, left) -> Column:
        made = F.transform(
            others(count),
            lambda x: F.struct(at.alias("band"), F.lit(up).alias("up"), a(x).alias("a"), b(x).alias("b"), left(x).alias("left")),
        )
        return F.when(F.col(count).isNotNull(), made).otherwise(none)

    own = F.col("block")
    work = F.concat(
        pieces("blocks", F.col("band"), False, lambda x: F.least(own, x), lambda x: F.greatest(own, x), lambda x: own <= x),
        pieces("above", F.col("band"), True, lambda x: own, lambda x: x, lambda x: F.lit(True)),
        pieces("below", F.col("band") - 1, True, lambda x: x, lambda x: own, lambda x: F.lit(False)),
    )
    # Two bands of one set each are one piece only; a block of one set has nothing to compare with itself.
    work = F.filter(work, lambda w: ~((F.col("sets") == 1) & ~w["up"]))
    placed = placed.select("key", "set", "copies", "root", work.alias("work"))
    texts = documents.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    texts = texts.join(placed, F.col("__key").eqNullSafe(F.col("key"))).drop("__key", "key")

    def sets(batches):
        for batch in slices(batches, "text"):
            owner, found = shingles(batch.column("text"), size)
            hashes, counts = set_hashes(owner, found, batch.num_rows)
            bounds = np.concatenate(([0], np.cumsum(counts)))
            same = hashes == batch.column("set").to_numpy()  # not so for another text under the same key
            content = [found[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            rest = [batch.column(x) for x in ("set", "copies", "root", "work")]
            yield pa.record_batch(
                [*rest, pa.array(content, pa.binary())], names=["set", "copies", "root", "work", "content"]
            ).filter(pa.array(same))

    shape = ", ".join([*(kind(texts, x) for x in ("set", "copies", "root", "work")), "content binary"])
    # Rows repeated under one key are one node.
    sent = arrow_map(texts, sets, shape).select("set", "copies", "root", F.explode("work").alias("w"), "content")
    sent = sent.select("root", "w.*", "set", "copies", "content")
    order = ["root", "band", "up", "a", "b"]
    limit = Fraction(str(threshold))

    def compare(batches):
        piece, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != piece:
                    if len(held) > 1:
                        yield from _compared(held, piece, limit)
                    piece, held = row[:5], []
                if not held or held[-1][1] != row[6]:
                    held.append(row[5:])
        if len(held) > 1:
            yield from _compared(held, piece, limit)

    dealt = sent.repartition(*order).sortWithinPartitions(*order, "left", "set")
    return arrow_map(dealt, compare, "node bigint, links bigint, other bigint")


def _compared(rows: list[tuple], piece: tuple, limit: Fraction):
    """Links between the two sides of a piece, or among all where the piece is one block."""
    left = np.array([x[0] for x in rows])
    node, copies = np.array([x[1] for x in rows]), np.array([x[2] for x in rows])
    found = [np.frombuffer(x[3], U64) for x in rows]
    sizes = np.array([len(x) for x in found])
    _, _, up, a, b = piece
    within = not up and a == b
    first = np.arange(len(rows)) if within else np.flatnonzero(left)
    second = np.arange(len(rows)) if within else np.flatnonzero(~left)
    if not len(first) or not len(second):
        return
    # The sets of the second side that hold each shingle.
    every = np.concatenate([found[i] for i in second])
    holder = np.repeat(np.arange(len(second)), sizes[second])
    order = np.argsort(every, kind="stable")
    every, holder = every[order], holder[order]
    links, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in first:
        low, high = np.searchsorted(every, found[i], "left"), np.searchsorted(every, found[i], "right")
        n = high - low
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
        common = np.bincount(holder[places], minlength=len(second))
        union = sizes[i] + sizes[second] - common
        close = second[common * limit.denominator >= union * limit.numerator]
        close = close[close > i] if within else close
        links[i] += copies[close].sum()
        links[close] += copies[i]
        for j in close:
            x, y = top(i), top(j)
            if x != y:
                parent[max(x, y)] = min(x, y)
    linked = np.flatnonzero(links)
    if len(linked):
        others = node[[top(i) for i in linked]]
        yield pa.record_batch(
            [pa.array(node[linked]), pa.array(links[linked]), pa.array(others)], names=["node", "links", "other"]
        )


def classes(
    documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD
) -> DataFrame:
    """``key, class_id, n_links, set`` of every document; ``set`` is the hash of its shingles."""
    found = written(sketches(documents, key, text, size, threshold), "sketches")
    nodes = found.where("n > 0").groupBy("set").agg(
        F.min("key").alias("key"),
        F.count("*").alias("copies"),
        *(F.first(x).alias(x) for x in ("n", "labels", "reach")),
    )
    met = F.filter("reach", lambda x: x >= 0)
    own = F.greatest(F.coalesce(F.array_min(met).cast("int"), F.lit(DIGITS)), F.lit(1))
    nodes = written(nodes.withColumn("own", own), "nodes")
    clusters = components(forest_links(nodes, *measure(nodes, threshold)))
    links = written(similar(documents, nodes.drop("labels", "reach", "own"), clusters, key, text, size, threshold), "links")
    joined = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    totals = links.groupBy(F.col("node").alias("set")).agg(F.sum("links").alias("links"))
    info = (
        nodes.select("set", "key", "copies")
        .join(joined.withColumnRenamed("node", "set"), "set", "left")
        .join(totals, "set", "left")
        .select("set", "key", "copies", F.coalesce("root", "set").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    )
    least = info.groupBy("root").agg(F.min("key").alias("class_id"))
    info = info.join(least, "root").select("set", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return found.join(info, "set", "left").select(
        F.col("key").alias(key),
        F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("key")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "set",
    )


def one_of_each(
    documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: float = THRESHOLD
) -> DataFrame:
    """The documents without those of which a similar one with a smaller key stays; of rows with equal key and text one
    stays. Different texts under one key stay or go together: the key stays if one of them is the first of its class."""
    owner, row = spare(documents, "__key"), spare(documents, "__row")
    stay = classes(documents, key, text, size, threshold).where(F.col(key).eqNullSafe(F.col("class_id")))
    stay = stay.select(F.col(key).alias(owner)).distinct()
    kept = documents.join(stay, documents[key].eqNullSafe(F.col(owner)), "left_semi")
    same = Window.partitionBy(key, F.xxhash64(text)).orderBy(F.lit(0))
    return kept.withColumn(row, F.row_number().over(same)).where(F.col(row) == 1).drop(row)

"""URL filter: rules by host and path, and for all other urls a tree of path templates for each host.

Urls become (host, segments of the path). Digits and hexadecimal names in segments are variable by their form; what lies
deeper than ``DEPTH`` segments is one segment. Equal paths are one row with counts of its pages: blocked, allowed by a
label, and unlabelled. Then, level by level from the host down, for all hosts at once:

1. *Wildcards.* A node with ``WIDE`` children or more is variable there: children with at most ``RARE`` times their even
   share of its pages become one child, ``*``.
2. *Similar branches.* The other children are grouped by their commonest kind of next segment and commonest label. Those
   whose distributions over both differ from their group's, by Jensen and Shannon's divergence less what chance makes
   of so few pages, by ``TOLERANCE`` at most are merged, named after the first of them.

A path of such names is a template. It is rejected if its smoothed purity, (blocked + STRENGTH / 2) / (blocked + allowed +
STRENGTH), is at least ``PURITY``; so a template without labels, or with one or two blocked pages, is not.

All of it is joins and sums over rows of distinct paths, a level at a time, each written to the shared folder. Sums are
combined before they are sent; the side of a join that may be hot (one host, one path) is dealt out by a salt, the other
side repeated for each. A literal segment ``*`` counts as the wildcard.

Null urls and such without ``://`` have empty host and path, hence one template; repeated rows count again; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.components import written

DEPTH = 6
WIDE, RARE = 16, 2
TOLERANCE = 0.02
STRENGTH, PURITY = 2, 0.8
SALTS = 16
#: Kinds of segments: no further one, an empty one, digits, with digits, hexadecimal, with a dot, other.
KINDS = 7
BLOCK, ALLOW = "block", "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the ``(verdict, host/path)`` rules that fits; null where none does. The list
    becomes part of the plan, so it should be short."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The segments of a path, variable forms masked, at most ``DEPTH`` and one for all deeper ones."""
    every = F.split(path, "/", -1)
    every = F.slice(every, 2, F.greatest(F.size(every) - 1, F.lit(0)))
    masked = F.transform(
        F.slice(every, 1, DEPTH),
        lambda s: F.when(s.rlike("^[0-9]+$"), "#")
        .when(s.rlike("^[0-9A-Fa-f-]{8,}$") & s.rlike("[0-9]"), "<hex>")
        .otherwise(F.regexp_replace(s, "[0-9]+", "#")),
    )
    return F.when(F.size(every) > DEPTH, F.concat(masked, F.array(F.lit("<deep>")))).otherwise(masked)


def kind_of(segment: Column) -> Column:
    """The kind of a segment, null being none."""
    return (
        F.when(segment.isNull(), 0)
        .when(segment == "", 1)
        .when(segment == "#", 2)
        .when(segment == "<hex>", 4)
        .when(F.contains(segment, F.lit(".")), 5)
        .when(F.contains(segment, F.lit("#")), 3)
        .otherwise(6)
    )


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """A left join on ``keys``: the left side, where a key may be hot, dealt out by ``salt``, the right one repeated."""
    many = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).join(many, [*keys, "salt"], "left").drop("salt")


def divergence(one: str, other: str) -> Column:
    """Jensen and Shannon's divergence of two columns of counts, in nats."""

    def shares(counts: str) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
        return F.transform(counts, lambda x: x / total)

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log(2 * p / (p + q))).otherwise(F.lit(0.0))

    terms = F.zip_with(shares(one), shares(other), lambda p, q: (part(p, q) + part(q, p)) / 2)
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def commonest(counts: str) -> Column:
    """The first place with the largest count."""
    return F.array_position(counts, F.array_max(counts))


def named_children(paths: DataFrame, level: int) -> DataFrame:
    """``host, template, segment, name`` of the children, at a level, that do not keep their own name."""
    following = kind_of(F.get("segments", F.lit(level + 1)))
    children = (
        paths.where(F.size("segments") > level)
        .groupBy("host", "template", F.get("segments", F.lit(level)).alias("segment"))
        .agg(
            F.sum("pages").alias("pages"),
            F.array(*(F.sum(F.when(following == i, F.col("pages")).otherwise(0)) for i in range(KINDS))).alias("next"),
            F.array(F.sum("blocked"), F.sum("allowed"), F.sum(F.expr("pages - blocked - allowed"))).alias("labels"),
        )
    )
    children = written(children, "children")
    node = ["host", "template"]
    wide = children.groupBy(*node).agg(F.count("*").alias("kids"), F.sum("pages").alias("all_pages"))
    children = salted_join(children, wide.where(F.col("kids") >= WIDE), node, F.col("segment"))
    variable = F.col("kids").isNotNull() & (F.col("pages") * F.col("kids") <= RARE * F.col("all_pages"))
    children = children.select(
        *node, "segment", "pages", "next", "labels", F.coalesce(variable, F.lit(False)).alias("variable"),
        commonest("next").alias("next_most"), commonest("labels").alias("label_most"),
    )
    children = written(children, "children")
    alike = [*node, "next_most", "label_most"]
    fixed = children.where("not variable")

    def added(counts: str, n: int) -> Column:
        return F.array(*(F.sum(F.get(counts, F.lit(i))) for i in range(n)))

    pooled = fixed.groupBy(*alike).agg(added("next", KINDS).alias("pool_next"), added("labels", 3).alias("pool_labels"), F.count("*").alias("group"))
    near = salted_join(fixed, pooled.where("group > 1"), alike, F.col("segment")).where("group > 1")

    def close(counts: str, pool: str, cells: int) -> Column:
        return divergence(counts, pool) <= TOLERANCE + (cells - 1) / (8 * F.col("pages"))

    near = written(near.where(close("next", "pool_next", KINDS) & close("labels", "pool_labels", 3)).select(*alike, "segment"), "children")
    first = near.groupBy(*alike).agg(F.min("segment").alias("first"), F.count("*").alias("group")).where("group > 1").drop("group")
    merged = salted_join(near, first, alike, F.col("segment")).where("first is not null")
    return (
        children.where("variable")
        .select(*node, "segment", F.lit("*").alias("name"))
        .union(merged.select(*node, "segment", F.concat(F.lit("{"), "first", F.lit(",…}"))))
    )


def grow(pages: DataFrame, url: str = "url", label: str = "label") -> DataFrame:
    """``host, segments, template, pages, blocked, allowed``: the distinct paths with their templates. ``label`` is
    block, allow or null."""
    paths = (
        pages.select(host_of(F.col(url)).alias("host"), segments(path_of(F.col(url))).alias("segments"), F.col(label).alias("label"))
        .groupBy("host", "segments")
        .agg(F.count("*").alias("pages"), F.count_if(F.col("label") == BLOCK).alias("blocked"), F.count_if(F.col("label") == ALLOW).alias("allowed"))
        .withColumn("template", F.lit(""))
    )
    paths = written(paths, "paths")
    deepest = paths.agg(F.max(F.size("segments")).alias("n")).first().n or 0
    for level in range(deepest):
        named = named_children(paths, level)
        here = F.get("segments", F.lit(level))
        paths = salted_join(paths.withColumn("segment", here), named, ["host", "template", "segment"], F.col("segments"))
        below = F.concat("template", F.lit("/"), F.coalesce("name", "segment"))
        paths = paths.withColumn("template", F.when(F.col("segment").isNull(), F.col("template")).otherwise(below))
        paths = written(paths.drop("segment", "name"), "paths")
    return paths


def templates(paths: DataFrame) -> DataFrame:
    """``host, template, pages, blocked, allowed, purity, rejected``."""
    sums = paths.groupBy("host", "template").agg(*(F.sum(x).alias(x) for x in ("pages", "blocked", "allowed")))
    purity = (F.col("blocked") + STRENGTH / 2) / (F.col("blocked") + F.col("allowed") + STRENGTH)
    return sums.withColumn("purity", purity).withColumn("rejected", purity >= PURITY)


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key, host, path, rule, verdict`` of every page. The rules' own verdicts are the labels that the tree learns
    from; what no rule fits is blocked if its template is rejected."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, says = rule_of(host, path, rules)
    read = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), rule.alias("rule"), says.alias("label"))
    paths = grow(pages.select(F.col(url).alias("url"), says.alias("label")))
    bad = templates(paths).where("rejected").select("host", "template")
    bad = salted_join(paths, bad.withColumn("bad", F.lit(True)), ["host", "template"], F.col("segments")).where("bad")
    others = read.where("rule is null").withColumn("segments", segments(F.col("path")))
    others = salted_join(others, bad.select("host", "segments", "bad"), ["host", "segments"], F.struct("key", "path"))
    learnt = F.when(F.col("bad"), BLOCK).otherwise(ALLOW)
    columns = [F.col("key").alias(key), "host", "path", "rule"]
    return read.where("rule is not null").select(*columns, F.col("label").alias("verdict")).union(others.select(*columns, learnt.alias("verdict")))

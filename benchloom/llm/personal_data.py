"""Personal data in texts: seeds by their form, then what stands where they stand.

DataFrame functions only. Seeds are e-mail addresses, IPv4 addresses, payment cards (14 to 19 digits with a right check
digit) and international phone numbers (10 to 15 digits). The last two words of the text before an entity, whatever their
length, are its lexical pattern; a word that is joined to more than two earlier matches of the same form begins with the
second of them. Other tokens of any length that look like identifiers (four digits or more, or an @) are candidates.
Over the graph of patterns and tokens, until the accepted patterns stay the same (``MOST_ROUNDS`` at most): a pattern's confidence for a kind is the mean confidence of the different tokens after it, a token's that
at least one of its accepted patterns is right. A pattern is accepted from ``PRECISION`` and ``SUPPORT`` on. Candidates after
an accepted pattern are reported as ``found_`` and the kind.

The graph has one edge for each different pair, summed before it is exchanged, so a frequent pattern or token is no hot
spot but one row of each task. Null and empty texts have no spans. Rows have numbers of their own, so those with equal
keys, or repeated, keep apart. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.components import written
from benchloom.llm.ship import spare
from benchloom.llm.spans import PLACES, blocks, matches, piece, running_maxima, sweeps

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Kinds in the order in which they are listed; those found by context come after them.
KINDS = ("email", "ip", "card", "phone")
TOKEN = r"(?<![A-Za-z0-9@._%+/-])(?=[A-Za-z._%+/-]*+[0-9@])[A-Za-z0-9@._%+/-]{4,}+"

MOST_ROUNDS = 20
PRECISION = 0.6
SUPPORT = 3.0
#: What an accepted pattern is worth for a token.
TRUST = 0.9
CANDIDATE = len(KINDS)
PART = "array<struct<start: bigint, order: int, kind: string, end: bigint, token: string, pattern: string>>"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _is_ip(text: Column) -> Column:
    def fits(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(text, r"\."), fits)


def _is_card(text: Column) -> Column:
    number = digits(text)
    return F.length(number).between(14, 19) & F.call_function("luhn_check", number)


def seeds(text: Column) -> dict[str, Column]:
    """The matches of each kind."""
    return {
        "email": matches(text, EMAIL, True),
        "ip": F.filter(matches(text, IP, True), lambda m: _is_ip(m["found"])),
        "card": F.filter(matches(text, CARD, True), lambda m: _is_card(m["found"])),
        "phone": F.filter(matches(text, PHONE, True), lambda m: F.length(digits(m["found"])).between(10, 15)),
    }


def pattern(before: Column) -> Column:
    """The last two words, in lower case, of what stands before an entity, with one space between them."""
    near = F.lower(F.substring(before, -80, 80))
    two = F.regexp_extract(near, r"\s(\S++\s++\S++)\s*+$", 1)
    every = F.filter(F.split(F.lower(before), r"\s+", -1), lambda w: w != "")
    # The words of the whole text before it only where two don't end within 80 characters.
    last = F.array_join(F.slice(every, F.greatest(F.size(every) - 1, F.lit(1)), F.lit(2)), " ")
    return F.when(two != "", F.regexp_replace(two, r"\s+", " ")).otherwise(last)


def parts(text: Column) -> Column:
    """Seeds and candidates of a text, each with its token and its pattern."""
    tokens = F.filter(
        F.transform(matches(text, TOKEN, True), lambda m: m.withField("found", F.regexp_replace(m["found"], "[._%+/-]+$", ""))),
        lambda m: (F.length(digits(m["found"])) >= 4) | m["found"].contains("@"),
    )

    def part(matched: Column, kind: str, order: int) -> Column:
        return F.transform(
            matched,
            lambda m: F.struct(
                m["start"].alias("start"),
                F.lit(order).alias("order"),
                F.lit(kind).alias("kind"),
                (m["start"] + F.length(m["found"])).alias("end"),
                F.lower(m["found"]).alias("token"),
                pattern(m["before"]).alias("pattern"),
            ),
        )

    found = seeds(text) | {"candidate": tokens}
    return F.concat(*(part(matched, kind, order) for order, (kind, matched) in enumerate(found.items()))).cast(PART)


def occurrences(rows: DataFrame) -> DataFrame:
    """Seeds, and candidates that overlap none, of rows ``row, parts``."""
    exploded = rows.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    seed = F.col("order") < CANDIDATE
    rows_before, rows_after = sweeps("row")
    behind = F.max(F.when(seed, F.col("end"))).over(rows_before) > F.col("start")
    ahead = F.min(F.when(seed, F.col("start"))).over(rows_after) < F.col("end")
    free = ~(F.coalesce(behind, F.lit(False)) | F.coalesce(ahead, F.lit(False)))
    return exploded.withColumn("free", free).where((seed | F.col("free")) & (F.col("pattern") != "")).drop("free")


def learn(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted patterns ``pattern, kind, confidence``, tokens ``token, kind, belief``) from the occurrences."""
    seed = F.col("order") < CANDIDATE
    edges = written(found.select("pattern", "token").distinct(), "edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    sure = written(found.where(seed).select("token", "kind").distinct().withColumn("belief", F.lit(1.0)), "beliefs")
    beliefs, accepted, before = sure, None, None
    for _ in range(MOST_ROUNDS):
        sums = edges.join(beliefs, "token").groupBy("pattern", "kind").agg(F.sum("belief").alias("support"))
        confidence = (F.col("support") / F.col("n")).alias("confidence")
        scored = sums.where(F.col("support") >= SUPPORT).join(sizes, "pattern").select("pattern", "kind", confidence)
        best = scored.where(F.col("confidence") >= PRECISION).groupBy("pattern").agg(
            F.max_by(F.struct("kind", "confidence"), F.struct("confidence", "kind")).alias("best")
        )
        accepted = written(best.select("pattern", "best.*"), "patterns")
        mark = F.sum(F.xxhash64("pattern", "kind").cast("decimal(20,0)"))
        state = accepted.agg(F.count("*").alias("n"), mark.alias("mark")).first()
        if state == before:
            break
        before = state
        doubt = F.exp(F.sum(F.log(1 - TRUST * F.least("confidence", F.lit(1.0)))))
        induced = edges.join(accepted, "pattern").groupBy("token", "kind").agg((1 - doubt).alias("belief"))
        beliefs = written(
            sure.unionByName(induced).groupBy("token", "kind").agg(F.max("belief").alias("belief")), "beliefs"
        )
    return accepted, beliefs


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, version, base, spans`` of every document: seeds, and those with what contexts found, sorted.

    ``version`` is a hash of the text, which tells rows of equal key apart.
    """
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.xxhash64(text).alias("version"),
        parts(F.coalesce(text, F.lit(""))).alias("parts"),
    )
    rows = written(rows, "personal-parts")
    found = written(occurrences(rows), "occurrences")
    accepted, beliefs = learn(found)
    unseen = found.where(F.col("order") == CANDIDATE).drop("kind").join(accepted, "pattern")
    unseen = unseen.join(beliefs.where(F.col("belief") >= 0.5), ["token", "kind"])
    place = F.struct(
        "start", F.lit(CANDIDATE).alias("order"), F.concat(F.lit("found_"), "kind").alias("kind"), "end"
    )
    discovered = unseen.groupBy("row").agg(F.collect_list(place).alias("more"))
    base = F.transform(
        F.filter("parts", lambda p: p["order"] < CANDIDATE),
        lambda p: F.struct(p["start"].alias("start"), p["order"].alias("order"), p["kind"].alias("kind"), p["end"].alias("end")),
    )
    base = F.array_sort(base).cast(PLACES)
    every = F.array_sort(F.concat(base, F.coalesce("more", F.array().cast(PLACES))))
    return rows.join(discovered, "row", "left").select(
        F.col("key").alias(key), "version", base.alias("base"), every.alias("spans")
    )


def masked(text: Column, spans: Column, blocked: Column) -> Column:
    """The text with each span, or run of spans that overlap, as the kind of its first in brackets. Spans are sorted.

    ``spans``, and ``blocked``, the text in blocks, must be columns that stand already: they are read for every span.
    """
    # What is covered before each span: up to 0 before the first, then the furthest end so far.
    ends = running_maxima(F.transform(spans, lambda s: s["end"]))
    until = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(ends, F.lit(1), F.size(ends) - 1))
    pieces = F.zip_with(
        spans,
        until,
        lambda s, done: F.when(
            s["start"] >= done,
            F.concat(
                piece(blocked, done, s["start"]),
                F.lit("["), F.upper(F.regexp_replace(s["kind"], "^found_", "")), F.lit("]"),
            ),
        ).otherwise(F.lit("")),
    )
    rest = piece(blocked, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(text)


def redact(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with personal data masked in ``text``; null texts stay null."""
    owner, version, places, pieces = (spare(documents, x) for x in ("__key", "__version", "__spans", "__blocks"))
    spans = find(documents, key, text).where(F.size("spans") > 0).select(
        F.col(key).alias(owner), F.col("version").alias(version), F.col("spans").alias(places)
    )
    # Rows repeated have the same spans.
    spans = spans.groupBy(owner, version).agg(F.first(places).alias(places))
    same = documents[key].eqNullSafe(F.col(owner)) & (F.xxhash64(documents[text]) == F.col(version))
    cut = F.when(F.col(places).isNotNull(), blocks(documents[text]))
    joined = documents.join(spans, same, "left").withColumn(pieces, cut)
    covered = masked(documents[text], F.col(places), F.col(pieces))
    clean = F.when(F.col(places).isNull(), documents[text]).otherwise(covered)
    return joined.select(*(clean.alias(c) if c == text else documents[c] for c in documents.columns))

"""Secrets in texts: strong ones by their form, weak ones where complementary parts of a credential stand together.

DataFrame functions only. Strong kinds, as listed: ``assign`` (a value of 8 characters or more given to password, secret,
token or api key), ``access`` (an access identifier of 16 or more) and ``hex`` (32 hexadecimal digits or more). Weak parts
are identifiers (a value given to user, login, account, client id or key id; a temporary access identifier), secrets (40
characters of base 64 with a digit, a capital and a small letter; a value given to pwd, pass, passphrase or pin) and
endpoints (an address with a scheme, a cloud host). The scope of a part reaches ``REACH`` code points to both sides. A weak
identifier is reported if a secret, strong or weak, lies in its scope; a weak secret if an identifier or an endpoint does;
an endpoint if both do.

The interval join of parts with the scopes of others runs over each text's parts in order: the furthest end of a part
before, and the next start of one after, decide. So it is linear in the parts, however many stand together.

Null and empty texts have no spans. Every row has a number of its own, so rows with equal keys, or repeated, keep apart.
Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchloom.llm.components import written
from benchloom.llm.spans import PLACES, matches, places, sweeps

REACH = 300

_VALUE = "[A-Za-z0-9+/_.=-]+"
_GIVEN = r"[\"']?\x20*[:=]\x20*[\"']?"
ASSIGN = rf"(?i)(?:password|passwd|secret|token|api_?key){_GIVEN}({_VALUE})"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"

WEAK_ID = (
    rf"(?i:(?<![a-z0-9])(?:user(?:name)?|login|account|client_?id|(?:access_?)?key_?id|access_?key){_GIVEN}"
    rf"[a-z0-9._@+-]{{3,}})|ASIA[A-Z0-9]{{12,}}"
)
WEAK_SECRET = (
    r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])(?=[A-Z0-9+/]{0,39}[a-z])"
    r"[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_.=-])"
    rf"|(?i:(?<![a-z0-9])(?:pwd|pass|passphrase|pin){_GIVEN}[a-z0-9+/_.=-]{{4,}})"
)
ENDPOINT = (
    r"(?i)(?:(?<![a-z0-9])(?:https?|ftp|s3|jdbc:[a-z]{1,12}|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)"
    r"://[a-z0-9.-]++)|(?<![a-z0-9.-])[a-z0-9-]{1,63}(?:\.[a-z0-9-]{1,63}){0,3}\.amazonaws\.com"
)
#: Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")


def parts(text: Column) -> Column:
    """All strong spans and weak parts of a text."""
    value = F.length
    found = {
        "assign": F.filter(matches(text, ASSIGN), lambda m: value(F.regexp_extract(m["found"], ASSIGN, 1)) >= 8),
        "access": F.filter(matches(text, ACCESS), lambda m: value(m["found"]) >= 16),
        "hex": matches(text, HEX),
        "linked_id": matches(text, WEAK_ID),
        "linked_secret": matches(text, WEAK_SECRET),
        "linked_endpoint": matches(text, ENDPOINT),
    }
    return F.concat(*(places(found[kind], kind, order) for order, kind in enumerate(KINDS))).cast(PLACES)


def linked(rows: DataFrame) -> DataFrame:
    """``row, spans``: the weak parts that are reported, of rows ``row, parts``."""
    weak = F.exists("parts", lambda p: p["order"] > 2)
    exploded = rows.where(weak).select("row", F.explode("parts").alias("p")).select("row", "p.*")
    before, after = sweeps("row")

    def near(*kinds: str) -> Column:
        of = F.col("kind").isin(*kinds)
        behind = F.max(F.when(of, F.col("end"))).over(before) >= F.col("start") - REACH
        ahead = F.min(F.when(of, F.col("start"))).over(after) <= F.col("end") + REACH
        return F.coalesce(behind, F.lit(False)) | F.coalesce(ahead, F.lit(False))

    met = exploded.select(
        "*",
        near("access", "linked_id").alias("id"),
        near("assign", "hex", "linked_secret").alias("secret"),
        near("linked_endpoint").alias("endpoint"),
    )
    report = (
        ((F.col("kind") == "linked_id") & F.col("secret"))
        | ((F.col("kind") == "linked_secret") & (F.col("id") | F.col("endpoint")))
        | ((F.col("kind") == "linked_endpoint") & F.col("id") & F.col("secret"))
    )
    return met.where(report).groupBy("row").agg(F.collect_list(F.struct("start", "order", "kind", "end")).alias("links"))


def find(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, base, spans`` of every document: strong spans, and those with the reported weak parts, sorted."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), parts(F.coalesce(text, F.lit(""))).alias("parts")
    )
    rows = written(rows, "secret-parts")
    links = linked(rows)
    joined = rows.join(links, "row", "left")
    strong = F.array_sort(F.filter("parts", lambda p: p["order"] <= 2))
    every = F.array_sort(F.concat(strong, F.coalesce("links", F.array().cast(PLACES))))
    return joined.select(F.col("key").alias(key), strong.alias("base"), every.alias("spans"))

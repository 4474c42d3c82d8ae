"""Masking and URI queries over the text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from benchloom.catalogue.base import register, table
from benchloom.catalogue.publication import size_text_sql
from benchloom.functions import text
from benchloom.functions.sizes import format_bytes

# The rules stated for RE2; bracketed hosts and upper-case schemes do not occur in the given texts.
WORDS = "token|secret|password|credential|authorization|access[._-]?key|api[._-]?key|private[._-]?key|cookie|signature"
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
VALUE = rf"[^{WS},;\"''}}]+"
URL_STOP = rf"{WS}<>\"''"
URL_SQL = (
    rf"([A-Za-z][A-Za-z0-9+.-]*://)(?:[^{URL_STOP}/?#]*@)?([^{URL_STOP}/?#]*)([^{URL_STOP}?#]*)[^{URL_STOP}]*"
)
BEARER_SQL = rf"(?i)\bBearer[{WS}]+{VALUE}"
ASSIGN_SQL = (
    rf"(?i)([\p{{L}}\p{{N}}_.-]*(?:{WORDS})[\p{{L}}\p{{N}}_.-]*[\"'']?[{WS}]*[:=][{WS}]*[\"'']?)"
    rf"(?:Bearer[{WS}]+)?{VALUE}"
)
ASSIGNED_SQL = rf"(?i)({WORDS})[\p{{L}}\p{{N}}_.-]*[\"'']?[{WS}]*[:=][{WS}]*[\"'']?{VALUE}"


def redact_sql(column: str) -> str:
    out = f"regexp_replace({column}, '{URL_SQL}', '\\1\\2\\3', 'g')"
    out = f"regexp_replace({out}, '{BEARER_SQL}', 'Bearer [REDACTED]', 'g')"
    out = f"regexp_replace({out}, '{ASSIGN_SQL}', '\\1[REDACTED]', 'g')"
    return f"regexp_replace({out}, '[\\x00-\\x08\\x0b-\\x1f]', '?', 'g')"


@register(
    "format_bytes",
    "doc_id:i small:s square:s huge:s",
    f"""SELECT doc_id, {size_text_sql('n_chars')} AS small, {size_text_sql('(n_chars * n_chars * 64)')} AS square,
               {size_text_sql('(n_chars * n_chars * 1000003)')} AS huge FROM documents""",
)
def _(spark, folder):
    n = F.col("n_chars")
    return table(spark, folder, "documents").select(
        "doc_id",
        format_bytes(n).alias("small"),
        format_bytes(n * n * 64).alias("square"),
        format_bytes(n * n * 1000003).alias("huge"),
    )


@register(
    "safe_uri",
    "page_id:i plain:s signed:s",
    """SELECT page_id, regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') AS plain,
              regexp_replace(regexp_replace(url, '#.*$', ''), '\\?.*$', '') AS signed
       FROM pages""",
)
def _(spark, folder):
    url = F.col("url")
    # The same page behind a signed link with credentials: what is left must be the plain address.
    signed = F.concat(
        F.regexp_replace(url, "^(https?://)", "$1user:p%40ss@"), F.lit("?sig="), F.md5("html"), F.lit("#top")
    )
    return table(spark, folder, "pages").select(
        "page_id", text.safe_uri(url).alias("plain"), text.safe_uri(signed).alias("signed")
    )


@register(
    "durable_uri",
    "page_id:i problem:s",
    r"""SELECT page_id, CASE
               WHEN lower(split_part(url, ':', 1)) IN ('file', 'local', 'memory') THEN 'local'
               WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/[^?#]+') THEN 'incomplete'
               WHEN regexp_matches(url, '\?[^#]') OR regexp_matches(url, '#.') OR
                    regexp_matches(url, '^[a-z]+://[^/?#]*@') THEN 'unstable' ELSE 'none' END AS problem
        FROM (SELECT page_id, CASE page_id % 5
                 WHEN 0 THEN url WHEN 1 THEN replace(url, 'https://', 'file://') WHEN 2 THEN url || '?sig=1'
                 WHEN 3 THEN url || '#part' ELSE regexp_replace(url, '(://[^/]*).*$', '\1/') END AS url
              FROM pages) AS p""",
)
def _(spark, folder):
    kind, url = F.col("page_id") % 5, F.col("url")
    variant = (
        F.when(kind == 0, url)
        .when(kind == 1, F.replace(url, F.lit("https://"), F.lit("file://")))
        .when(kind == 2, F.concat(url, F.lit("?sig=1")))
        .when(kind == 3, F.concat(url, F.lit("#part")))
        .otherwise(F.regexp_replace(url, "(://[^/]*).*$", "$1/"))
    )
    return table(spark, folder, "pages").select(
        "page_id", F.coalesce(text.uri_problem(variant), F.lit("none")).alias("problem")
    )


@register("redact_documents", "doc_id:i redacted:s", f"SELECT doc_id, {redact_sql('text')} AS redacted FROM documents")
def _(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.redact_text(F.col("text")).alias("redacted"))


@register(
    "redact_conversations",
    "conv_id:i turn:i redacted:s",
    "SELECT conv_id, turn, "
    + redact_sql(
        "replace(replace('https://u:p@' || role || '.example.com/a?sig=' || turn || '#f ' || text || "
        "chr(27) || ' password: \"hunter' || turn || '\" key opaque&secret opaque%26secret authorization = Bearer ' "
        "|| md5(text), 'opaque%26secret', '[REDACTED]'), 'opaque&secret', '[REDACTED]')"
    )
    + " AS redacted FROM conversations",
)
def _(spark, folder):
    # Every turn is wrapped in a link with credentials, a password, a known secret and a bearer token.
    wrapped = F.concat(
        F.lit("https://u:p@"), "role", F.lit(".example.com/a?sig="), "turn", F.lit("#f "), "text", F.char(F.lit(27)),
        F.lit(' password: "hunter'), "turn", F.lit('" key opaque&secret opaque%26secret authorization = Bearer '),
        F.md5("text"),
    )
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", text.redact_text(wrapped, ["opaque&secret"]).alias("redacted")
    )


@register(
    "redact_pages",
    "page_id:i redacted:s",
    f"SELECT page_id, {redact_sql('html')} AS redacted FROM pages",
)
def _(spark, folder):
    return table(spark, folder, "pages").select("page_id", text.redact_text(F.col("html")).alias("redacted"))


@register(
    "redact_props",
    "event_id:i k:s session_token:s note:s user_id:i",
    """SELECT event_id, json_extract_string(props, '$.k') AS k, '[REDACTED]' AS session_token,
              event_type || ' https://host/' || user_id AS note, user_id FROM events""",
)
def _(spark, folder):
    document = F.struct(
        F.from_json("props", "map<string,string>").alias("props"),
        F.create_map(F.lit("Session-Token"), F.col("user_id"), F.lit("plain"), F.col("event_id")).alias("numbers"),
        F.array(F.concat("event_type", F.lit(" https://u:p@host/"), "user_id", F.lit("?sig=x"))).alias("notes"),
        F.col("user_id"),
    )
    events = table(spark, folder, "events").select("event_id", document.alias("doc"))
    return text.redact_document(events, "doc").select(
        "event_id",
        F.col("doc.props")["k"].alias("k"),
        F.col("doc.numbers")["Session-Token"].alias("session_token"),
        F.col("doc.notes")[0].alias("note"),
        F.col("doc.user_id"),
    )


@register(
    "find_secrets",
    "doc_id:i word:s hits:i",
    f"""SELECT doc_id, word, count(*) AS hits
        FROM (SELECT doc_id, lower(unnest(regexp_extract_all(text, '{ASSIGNED_SQL}', 1))) AS word FROM documents
              UNION ALL
              SELECT doc_id, 'bearer' FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{BEARER_SQL}')) AS b
                                            FROM documents) AS x) AS w
        GROUP BY doc_id, word""",
)
def _(spark, folder):
    return text.find_secrets(table(spark, folder, "documents"), "doc_id", "text")


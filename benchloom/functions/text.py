"""Masking of secrets in text, URI clean-up and URI checks as column expressions.

Everything here is built-in JVM expressions over the whole value: no UDF, no prefix of the text. The
patterns avoid a leading ``[\\w.-]*``: with it, one long unbroken run of word characters would make a
backtracking matcher quadratic in the length of the run.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = "[REDACTED]"
BAD_URI = "[invalid/redacted URI]"

# Words that mark a key as secret, and the characters that end a secret value.
SECRET_WORDS = (
    "token|secret|password|credential|authorization|access[._-]?key|api[._-]?key|private[._-]?key|cookie|signature"
)
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
VALUE = rf"[^{SPACE},;\"'}}]+"
SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*"
URL_STOP = rf"{SPACE}<>\"'"

SECRET_KEY = rf"(?iu)(?:{SECRET_WORDS})"
URL = rf"{SCHEME}://[^{URL_STOP}]+"
URL_PARTS = rf"({SCHEME}://)(?:[^{URL_STOP}/?#]*@)?([^{URL_STOP}/?#]*)([^{URL_STOP}?#]*)[^{URL_STOP}]*"
ODD_URL = rf"(?:[A-Z][A-Za-z0-9+.-]*|{SCHEME}[A-Z][A-Za-z0-9+.-]*)://|://[^{URL_STOP}/?#]*[\[\]]|:///"
BEARER = rf"(?iu)(?<![{WORD}])Bearer[{SPACE}]+{VALUE}"
ASSIGNMENT = (
    rf"(?iu)((?:{SECRET_WORDS})[{WORD}.-]*[\"']?[{SPACE}]*[:=][{SPACE}]*[\"']?)(?:Bearer[{SPACE}]+)?{VALUE}"
)
ASSIGNED_WORD = rf"(?iu)({SECRET_WORDS})[{WORD}.-]*[\"']?[{SPACE}]*[:=][{SPACE}]*[\"']?{VALUE}"
CONTROL = r"[\x00-\x08\x0b-\x1f]"


def safe_uri(uri: Column) -> Column:
    """Drop userinfo, query and fragment and lower the scheme; a URI that cannot be split becomes a fixed text."""
    clean = F.translate(F.regexp_replace(uri, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    scheme = F.lower(F.regexp_extract(clean, rf"^({SCHEME}):", 1))
    rest = F.regexp_replace(clean, rf"^{SCHEME}:", "")
    netloc = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    host = F.regexp_extract(netloc, r"([^@]*)$", 1)
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    # A host in brackets must be an IP literal, and nothing but a port may follow it.
    bad = netloc.rlike(r"[\[\]]") & ~netloc.rlike(
        r"^(?:[^\[\]]*@)?\[(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.%\w]*|[vV][0-9A-Fa-f]+\.[^\[\]@]+)\](?::[^\[\]@]*)?$"
    )
    # Schemes whose text keeps "//" when the authority is empty.
    slashes = scheme.isin("http", "https", "file", "ftp", "sftp") & ((path == "") | path.startswith("/"))
    body = (
        F.when(host != "", F.concat(F.lit("//"), host, path))
        .when(path.startswith("//"), F.concat(F.lit("//"), path))
        .when(slashes, F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    joined = F.when(scheme != "", F.concat(scheme, F.lit(":"), body)).otherwise(body)
    return F.when(uri.isNull(), F.lit(None).cast("string")).when(bad, F.lit(BAD_URI)).otherwise(joined)


def safe_urls_in(text: Column) -> Column:
    """Apply :func:`safe_uri` to every URL inside a text.

    Plain URLs need one replacement. Only a text with an upper-case scheme, an empty authority or a
    bracketed host takes the general way, which cuts the text at its URLs and joins it again.
    """
    general = F.concat_ws(
        "",
        F.zip_with(
            F.split(text, URL, -1),
            F.regexp_extract_all(text, F.lit(URL), F.lit(0)),
            lambda between, url: F.concat(between, F.coalesce(safe_uri(url), F.lit(""))),
        ),
    )
    plain = F.regexp_replace(text, URL_PARTS, "$1$2$3")
    return F.when(~F.contains(text, F.lit("://")), text).when(text.rlike(ODD_URL), general).otherwise(plain)


def known_secrets(*values: str) -> list[str]:
    """Secrets in plain and percent-encoded form, longest first."""
    forms = {form for value in values if value for form in (value, quote(value, safe=""))}
    return sorted(forms, key=lambda form: (-len(form), form))


def secret_values(properties: dict) -> list[str]:
    """Values kept under secret-like keys of a (nested) property map, to pass to :func:`redact_text`."""
    import re

    found = []
    for key, value in properties.items():
        if isinstance(value, dict):
            found += secret_values(value)
        elif isinstance(value, str) and re.search(SECRET_WORDS, str(key), re.IGNORECASE):
            found.append(value)
    return found


# Plain words, one of which every match of a pattern contains. Looking for a word is much cheaper than
# matching, and few texts hold one.
KEY_HINTS = ("token", "secret", "password", "credential", "authorization", "key", "cookie", "signature")
BEARER_HINTS = ("bearer",)
# Letters outside ASCII that stand for "s", "k" and "i" when case is ignored.
FOLDED = ("\u017f", "\u212a", "\u0130", "\u0131")


def _may_match(text: Column, hints: tuple[str, ...]) -> Column:
    """False only for texts that no pattern with these hints can match."""
    lowered = F.lower(text)
    found = [F.contains(lowered, F.lit(hint)) for hint in hints]
    found += [F.contains(text, F.lit(letter)) for letter in FOLDED]
    out = found[0]
    for condition in found[1:]:
        out = out | condition
    return out


def redact_text(text: Column, secrets: list[str] | tuple[str, ...] = ()) -> Column:
    """Mask known secrets, then URLs, bearer tokens and ``key=value`` secrets, then control characters."""
    out = text
    for secret in known_secrets(*secrets):
        out = F.replace(out, F.lit(secret), F.lit(MASK))
    out = safe_urls_in(out)
    # Neither step can bring in a hint that the text did not have, so the hints are looked up once.
    masked = F.regexp_replace(F.regexp_replace(out, BEARER, f"Bearer {MASK}"), ASSIGNMENT, f"$1{MASK}")
    out = F.when(_may_match(text, KEY_HINTS + BEARER_HINTS), masked).otherwise(out)
    return F.regexp_replace(out, CONTROL, "?")


def redact_value(value: Column, dtype: T.DataType, secrets: list[str] | tuple[str, ...] = ()) -> Column:
    """Mask a nested value. The expression follows the schema, so nothing is inspected row by row in Python."""
    if isinstance(dtype, T.StringType):
        return redact_text(value, secrets)
    if isinstance(dtype, T.StructType):
        import re

        fields = [
            (
                F.lit(MASK)
                if re.search(SECRET_WORDS, field.name, re.IGNORECASE)
                else redact_value(value.getField(field.name), field.dataType, secrets)
            ).alias(field.name)
            for field in dtype.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: redact_value(item, dtype.elementType, secrets))
    if isinstance(dtype, T.MapType):
        inner = dtype.valueType

        # Values keep their type, so that nesting stays. A value under a secret key becomes the mask where it is text;
        # another type can't hold the mask, and its value goes.
        hidden = F.lit(MASK) if isinstance(inner, T.StringType) else F.lit(None).cast(inner)
        plain = not isinstance(inner, (T.StringType, T.StructType, T.ArrayType, T.MapType))

        def masked(key: Column, item: Column) -> Column:
            if plain:  # numbers and dates are shown as text, as the mask is one
                return F.when(key.cast("string").rlike(SECRET_KEY), F.lit(MASK)).otherwise(item.cast("string"))
            return F.when(key.cast("string").rlike(SECRET_KEY), hidden).otherwise(redact_value(item, inner, secrets))

        return F.transform_values(value, masked)
    return value


def redact_document(df, column: str, secrets: list[str] | tuple[str, ...] = ()):
    """Replace a struct, map, array or string column by its masked form."""
    return df.withColumn(column, redact_value(F.col(column), df.schema[column].dataType, secrets))


def find_secrets(df, key: str, column: str):
    """Which rows hold secret-like assignments or bearer tokens: ``(key, word, hits)``.

    Only the key and the short word leave the scan; the text itself is never shuffled.
    """
    words = F.transform(
        F.regexp_extract_all(F.col(column), F.lit(ASSIGNED_WORD), F.lit(1)), lambda word: F.lower(word)
    )
    bearers = F.transform(
        F.regexp_extract_all(F.col(column), F.lit(BEARER), F.lit(0)), lambda _: F.lit("bearer")
    )
    return (
        df.where(_may_match(F.col(column), KEY_HINTS + BEARER_HINTS))
        .select(key, F.explode(F.concat(words, bearers)).alias("word"))
        .groupBy(key, "word")
        .agg(F.count("*").alias("hits"))
    )


def uri_problem(uri: Column) -> Column:
    """Why a location is not durable: ``invalid``, ``local``, ``incomplete``, ``unstable``; null if it is fine."""
    clean = F.translate(F.regexp_replace(uri, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    scheme = F.lower(F.regexp_extract(clean, rf"^({SCHEME}):", 1))
    rest = F.regexp_replace(clean, rf"^{SCHEME}:", "")
    netloc = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(rest, r"#([\s\S]*)$", 1)
    host = F.regexp_extract(netloc, r"([^@]*)$", 1)
    user = F.regexp_extract(netloc, r"^([\s\S]*)@", 1)
    port = F.regexp_extract(F.regexp_replace(host, r"^[^\[]*\[[^\]]*\]", ""), r":([\s\S]*)$", 1)
    number = F.coalesce(port.try_cast("int"), F.lit(65536))
    bad_port = (port != "") & ~(port.rlike("^[0-9]+$") & (number <= 65535))
    unbalanced = F.contains(netloc, F.lit("[")) != F.contains(netloc, F.lit("]"))
    return (
        F.when(uri.isNull(), F.lit("invalid"))
        .when(bad_port | unbalanced, F.lit("invalid"))
        .when((scheme == "") | scheme.isin("file", "local", "memory"), F.lit("local"))
        .when((netloc == "") | (path == "") | (path == "/"), F.lit("incomplete"))
        .when((query != "") | (fragment != "") | ~user.isin("", ":"), F.lit("unstable"))
    )


def is_durable_uri(uri: Column) -> Column:
    return uri_problem(uri).isNull()

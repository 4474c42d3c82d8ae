import pytest
from pyspark.sql import functions as F

from benchloom.functions import sizes, text


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "value, secrets, expected",
    [
        (
            "opaque&secret opaque%26secret https://u:p@h/path?sig=secret#frag",
            ["opaque&secret"],
            "[REDACTED] [REDACTED] https://h/path",
        ),
        ("Bearer ABC123", [], "Bearer [REDACTED]"),
        ("\x1b[31mevil\x00", [], "?[31mevil?"),
        (
            "raw top-secret-credential https://u:p@h/a?signature=123",
            ["top-secret-credential"],
            "raw [REDACTED] https://h/a",
        ),
        ('"client_secret": "abc", x', [], '"client_secret": "[REDACTED]", x'),
        ("Authorization: Bearer abc.def rest", [], "Authorization: [REDACTED] rest"),
        ("my-api.key = 12;next", [], "my-api.key = [REDACTED];next"),
        ("a\tb\nc\rd", [], "a\tb\nc?d"),
        ("HTTPS://User@Host/Path?x", [], "https://Host/Path"),
        ("see http://[::1]:80/a?b and http://[bad/x?y end", [], "see http://[::1]:80/a and [invalid/redacted URI] end"),
        ("token" + "x" * 50_000 + "=value", [], "token" + "x" * 50_000 + "=[REDACTED]"),
        ("\u017fecret=a to\u212aen=b cook\u0131e=c \u017fPAIN=d", [], "\u017fecret=[REDACTED] to\u212aen=[REDACTED] cook\u0131e=[REDACTED] \u017fPAIN=d"),
        ("PASSWORD\u00a0=\u00a0x\u00a0y", [], "PASSWORD\u00a0=\u00a0[REDACTED]\u00a0y"),
        ("plain", [], "plain"),
    ],
)
def test_redaction(spark, value, secrets, expected):
    assert one(spark, value, lambda c: text.redact_text(c, secrets)) == expected


def test_null_stays_null(spark):
    assert one(spark, None, text.redact_text) is None
    assert one(spark, None, text.safe_uri) is None


@pytest.mark.parametrize(
    "uri, expected",
    [
        ("https://u:p@h/path?sig=1#f", "https://h/path"),
        ("s3://bucket/a b", "s3://bucket/a b"),
        ("S3://b@c@d/k?x", "s3://d/k"),
        ("/tmp/a?x#y", "/tmp/a"),
        ("mailto:a@b?subject=x", "mailto:a@b"),
        ("https:///p", "https:///p"),
        ("http://[::1/a", text.BAD_URI),
        ("", ""),
    ],
)
def test_safe_uri(spark, uri, expected):
    assert one(spark, uri, text.safe_uri) == expected


@pytest.mark.parametrize(
    "uri, problem",
    [
        ("/tmp/a.parquet", "local"),
        ("file:///tmp/a", "local"),
        ("FILE:///tmp/a", "local"),
        ("memory://x/a", "local"),
        ("local://x/a", "local"),
        ("s3://x", "incomplete"),
        ("s3://x/", "incomplete"),
        ("https://u:p@x/a", "unstable"),
        ("https://x/a?secret=z", "unstable"),
        ("s3://x/a#f", "unstable"),
        ("https://x:bad/a", "invalid"),
        ("https://x:99999/a", "invalid"),
        ("s3://bucket/table/data/a.parquet", None),
        ("https://host/a.parquet", None),
        ("https://host:8443/a.parquet", None),
        ("abfs://x/a", None),
        ("gs://b/a", None),
        ("s3://my_bucket/k", None),
        ("s3://b/a?", None),
    ],
)
def test_durable_uri(spark, uri, problem):
    assert one(spark, uri, text.uri_problem) == problem


@pytest.mark.parametrize(
    "size, expected",
    [
        (0, "0.0 B"),
        (1023, "1023.0 B"),
        (1024, "1.0 KiB"),
        (1280, "1.2 KiB"),
        (1792, "1.8 KiB"),
        (216_327_991, "206.3 MiB"),
        (1024**5, "1.0 PiB"),
        (5000 * 1024**5, "5000.0 PiB"),
    ],
)
def test_format_bytes(spark, size, expected):
    df = spark.createDataFrame([(size,)], "n bigint")
    assert df.select(sizes.format_bytes(F.col("n"))).first()[0] == expected


def test_document(spark):
    df = spark.sql(
        "select named_struct('message', 'Bearer x1', 's3.secret-access-key', 'abc', 'nested', array('token=1'), "
        "'run_id', 'r', 'rows', 10, 'props', map('Auth-Token', 1, 'n', 2)) as doc"
    )
    row = text.redact_document(df, "doc").first()["doc"]
    assert row["message"] == "Bearer [REDACTED]"
    assert row["s3.secret-access-key"] == "[REDACTED]"
    assert row["nested"] == ["token=[REDACTED]"]
    assert (row["run_id"], row["rows"]) == ("r", 10)
    assert row["props"] == {"Auth-Token": "[REDACTED]", "n": "2"}


def test_learned_secrets(spark):
    found = text.secret_values({"uri": "x", "auth": {"client-secret": "s1"}, "Token": "s2", "n": {"m": {"cookie": "s3"}}})
    assert sorted(found) == ["s1", "s2", "s3"]
    assert one(spark, "s1 and s3", lambda c: text.redact_text(c, found)) == "[REDACTED] and [REDACTED]"


def test_find_secrets(spark):
    df = spark.createDataFrame([(1, "token = a, TOKEN: b Bearer q"), (2, "none")], "id int, t string")
    found = {(r["id"], r["word"]): r["hits"] for r in text.find_secrets(df, "id", "t").collect()}
    assert found == {(1, "token"): 2, (1, "bearer"): 1}


def test_nested_map_values_keep_their_type(spark):
    df = spark.sql(
        "select map('plain', named_struct('password', 'x', 'n', 1), 'my_token', named_struct('password', 'y', 'n', 2)) as a, "
        "map('k', map('secret', 'v', 'note', 'token=abc')) as b, map('api_key', array('x'), 'list', array('secret=1')) as c"
    )
    for column in df.columns:
        df, kind = text.redact_document(df, column), df.schema[column].dataType
        assert df.schema[column].dataType.simpleString() == kind.simpleString()
    row = df.first()
    assert row.a["plain"].password == "[REDACTED]" and row.a["plain"].n == 1 and row.a["my_token"] is None
    assert row.b["k"]["secret"] == "[REDACTED]" and "abc" not in row.b["k"]["note"]
    assert row.c["api_key"] is None and row.c["list"] == ["secret=[REDACTED]"]

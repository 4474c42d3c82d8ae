"""The URL filter against plain definitions."""

import brute
import numpy as np

from benchloom.llm import url_filter
from benchloom.llm.queries import URL_RULES

SHAPE = "page_id bigint, url string, html string, host string, path string, rule string, label string, template string, salt int, key int"
RULES = [*URL_RULES, ("block", "shop.io/x/spam"), ("allow", "shop.io/x/spam/good"), ("block", "b.org/p/1")]


def table(spark, rows):
    return spark.createDataFrame([(*row, "h", "h", "p", "r", "l", "t", 1, 2) for row in rows], SHAPE).repartition(3)


def rows():
    draw = np.random.default_rng(6)
    found = [
        None, "", "no scheme", "x://", "http://A.Example.COM", "http://a.example.com?x=/de/", "HTTP://net/", "http://net",
        "http://b.net/#x", "http://xnet/", "http://www.example.net/en/1?p=2", "http://example.net/EN/1", "s://o.org/fr/", "s://org/fr",
        "a://b://c/d", "http://é.org/ü/7//", "http://u.org/" + "a/" * 40 + "9", "http://v.org/" + "z" * 30_000 + "?" + "q" * 30_000,
        "http://h.org/\n/a", "http://h.org/deadbeef99/0f8fad5b-d9cb-469f-a165-70867728950e/f2.html",
    ] * 2
    for i in range(400):  # one host with branches alike, branches that are not, and names met once
        lang = str(draw.choice(["en", "fr", "es", "pt"]))
        found.append(f"https://shop.io/{lang}/{i}" + (".html" if i % 3 == 0 else ""))
        found.append(f"https://shop.io/x/{['spam', 'spam/good', 'fine'][i % 3]}{'' if i % 2 else f'/{i}'}")
        found.append(f"https://shop.io/p/{'abcdefghijklmnopqrst'[i % 20]}{chr(97 + i // 20)}/view" if i % 5 else "https://shop.io/p/home/view")
        found.append(f"https://m{i % 4}.example.com/{lang if i % 7 else 'de'}/{i}/")
        found.append(f"https://b.org/p/{i}")
    found += ["https://b.org/p/1"] * 300
    return [(i if i % 50 else None, url) for i, url in enumerate(found)]


def by_text(found):
    return sorted(found, key=repr)


def test_verdicts(spark):
    given = rows()
    got = url_filter.judge(table(spark, given), RULES)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = brute.url_verdicts(given, RULES)
    assert by_text(tuple(r) for r in got.collect()) == by_text(wanted)
    # Pages that no rule fits are blocked where their template is.
    assert any(rule is None and verdict == "block" for *_, rule, verdict in wanted)


def test_templates(spark):
    given = [(i, f"http://h.org/{w}/{i}") for i, w in enumerate(["en", "fr", "es", "de"] * 30)]
    given += [(i, f"http://h.org/tag/{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(100)]
    paths = url_filter.grow(table(spark, given).select("url", url_filter.F.lit(None).cast("string").alias("label")))
    found = {r.template: (r.pages, r.rejected) for r in url_filter.templates(paths).collect()}
    assert found == {"/{de,…}/#": (120, False), "/tag/*": (100, False)}


def test_nothing(spark):
    assert url_filter.judge(table(spark, []), RULES).count() == 0
    alone = url_filter.judge(table(spark, [(None, None)]), []).collect()
    assert [tuple(r) for r in alone] == [(None, "", "", None, "allow")]


def test_given_pages(spark):
    from benchloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()]
    got = QUERIES["op12_url_filter"](spark, folder).collect()
    assert by_text(map(tuple, got)) == by_text(brute.url_verdicts(given, URL_RULES))

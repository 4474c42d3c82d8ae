"""The registered queries of this subpackage: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchloom.llm import (
    bpe,
    collocations,
    compression,
    decontaminate,
    jaccard,
    language_model,
    personal_data,
    quality_rules,
    secret_links,
    spans,
    substrings,
    token_files,
    url_filter,
    whitening,
)
from benchloom.llm.shared import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text to ids and back, as digests of both."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, folder, "documents"), *ranks)
    return bpe.decode(encoded, *ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every text as ids in files, and what the files give back."""
    files = new_folder(spark, "tokens")
    token_files.write(table(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The words of every document that stand in benchmark passages."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.hits(documents, table(spark, folder, "benchmark")).select("doc_id", "hits.*")
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


ORACLES["op4_benchmark_decontamination"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
     b AS (SELECT item_id, regexp_extract_all(lower_az, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
           FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
     sizes AS (SELECT DISTINCT least(len(w), 13) AS n FROM b WHERE len(w) > 0),
     wins AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
              FROM (SELECT item_id, w, least(len(w), 13) AS n,
                           unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
     places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
                FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
     occ AS (SELECT doc_id, item_id, i, n FROM places JOIN wins USING (n, phrase)),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
             FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
     its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
             FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every text without the 20-word windows that stand earlier."""
    kept = substrings.remove(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op8_substring_dedup"] = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
     wins AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS phrase
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
     later AS (SELECT doc_id, i FROM wins QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) > 1),
     gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
     words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
              FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    rules = quality_rules.fit(documents, table(spark, folder, "labels"))
    return quality_rules.assess(documents, rules).select("doc_id", "rules.*")


def checksum(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo a number; a key that is null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


@query
def op7_compression_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; a fifth of the labels is held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = checksum("doc_id", 5) == 0
    model = compression.fit(documents, table(spark, folder, "labels").where(~held_out))
    return compression.classify(documents, model).select("doc_id", held_out.alias("held_out"), "quality.*")


@query
def op5_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document under a model of six sevenths of them."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = checksum("doc_id", 7) == 2
    model = language_model.fit(documents, ~held_out)
    return language_model.score(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


@query
def op2_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document."""
    return jaccard.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


ORACLES["op2_ngram_jaccard"] = """
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + least(len(w), 5) - 1], ' ')) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
           GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
cls AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
cnt AS (SELECT a AS doc_id, count(*) AS k FROM link GROUP BY a)
SELECT doc_id, class_id, coalesce(k, 0) AS n_links FROM cls LEFT JOIN cnt USING (doc_id)
"""


@query
def op6_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    return spans.digest(secret_links.find(table(spark, folder, "documents")), secret_links.KINDS[:3])


@query
def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return spans.digest(personal_data.find(table(spark, folder, "documents")), personal_data.KINDS)


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op13_collocations"] = """
WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(low, '[.,;:!?\\x0A-\\x0D]')) AS piece
                FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                                      'abcdefghijklmnopqrstuvwxyz') AS low FROM documents)),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
     sizes AS (SELECT unnest([1, 2, 3, 4]) AS size),
     grams AS (SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
               FROM w, sizes WHERE len(w) >= size),
     f AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
     words AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
     cuts AS (SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS p FROM f WHERE size > 1),
     scored AS (SELECT c.lang, c.size, c.phrase, c.a, k, x.f AS l, y.f AS r,
                       CAST((2000000::HUGEINT * c.a) // (x.f + y.f) AS BIGINT) AS score
                FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:k], ' ')
                            JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')),
     best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     inner_ AS (SELECT lang, a AS around, array_to_string(p[i : i + m - 1], ' ') AS phrase
                FROM (SELECT lang, a, size, string_split(phrase, ' ') AS p, m, unnest(range(1, size - m + 2)) AS i
                      FROM (SELECT *, unnest(range(2, size)) AS m FROM best WHERE size > 2))),
     longer AS (SELECT lang, phrase, max(around) AS around FROM inner_ GROUP BY ALL),
     kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase)
              WHERE around IS NULL OR 100::HUGEINT * around < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN words USING (lang) QUALIFY rank <= 2000
"""


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every embedding."""
    embeddings = table(spark, folder, "embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


#: Fixed values of the query's contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page."""
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)

"""The pipeline as a whole, stage by stage, over the smallest given tables."""

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from benchloom.llm import bpe

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        assert len(after) == len(rows) and after <= set(before)
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            limits = {k for k, t in before.items() if (s := brute.statistics(t))[0] >= 20 and 100 * s[4] <= 30 * s[0]}
            assert after <= limits
            good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
            assert good & limits <= after
        elif name == "near_duplicates":
            assert after == {k for k, c, _ in brute.similar_classes(list(before.items())) if k == c}
        elif name == "decontamination":
            hits = {k: brute.window_hits(t, items) for k, t in before.items()}
            assert after == {k for k, (n, hit, _) in hits.items() if not hit or 20 * hit < n}
        elif name == "personal_data":
            assert after == set(before)
            for r in rows:
                assert r.n_chars == len(r.text)
                assert (r.text == before[r.doc_id]) == (not brute.personal(before[r.doc_id]))
                assert not brute.personal(r.text)
        else:
            encoder = bpe.encoding(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
            for r in rows:
                assert np.frombuffer(r.ids, "<u4").tolist() == encoder.encode_ordinary(before[r.doc_id])
                assert r.decoded_sha256 == brute.sha(before[r.doc_id])


def test_run_has_the_rows_of_its_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).select(F.count_distinct("doc_id")).first()[0] > 100

"""The pipeline over small data, stage by stage and against plain versions of its stages."""

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sirenlog.llm import packing, quality, repeats, secret_scan, simhash
from tests.llm.test_repeats import plain_ranges
from tests.llm.test_secret_scan import plain_spans
from tests.llm.test_simhash import plain_kept

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = sorted((r.doc_id, r.text) for r in quality.assess(docs, model).filter("kept").collect())
    rows = [rows[k] for k in plain_kept(rows)]
    data, ranges = plain_ranges(rows, "first")
    texts = [repeats.without(d, repeats.whole_characters(d, s)).decode() for d, s in zip(data, ranges)]
    rows = [(i, t) for (i, _), t in zip(rows, texts) if t]
    final = {}
    for i, text in rows:
        parts, at = [], 0
        for _, a, b in plain_spans(text):
            if a >= at:
                parts += [text[at:a], secret_scan.REDACTED]
            at = max(at, b)
        final[i] = len(("".join([*parts, text[at:]]) if parts else text).encode().split())
    out = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.n_words for r in out} == final and len(out) == len(final)
    count, total = Counter(), Counter()
    for n in final.values():
        step = 1 << max(0, n.bit_length() - packing.GRID_BITS)
        count[-(-n // step) * step] += 1
        total[-(-n // step) * step] += n
    values = sorted(count)
    limits = packing.bucket_limits(np.array(values), np.array([count[v] for v in values]),
                                   np.array([total[v] for v in values]), 16)
    assert sorted({r.bucket_length for r in out}) == limits


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).withColumns(
        {c: F.lit("mine") for c in ("row", "key", "mark", "kept", "found", "ranges", "blob_id", "fingerprint")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        assert out.filter("found <> 'mine' OR ranges <> 'mine' OR row <> 'mine'").count() == 0


def test_stages_on_odd_and_empty_tables(spark, documents, odd_rows):
    for rows in (odd_rows, []):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, documents(rows), SF_DIR).count() <= len(rows)


def test_simhash_stage_leaves_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = simhash.keep_one(docs).select("doc_id")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert sorted(r[0] for r in kept.collect()) == [rows[k][0] for k in plain_kept(rows)]

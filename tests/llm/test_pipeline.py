"""The pipeline's stages, each on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from tallyshelf.llm import decontaminate, pieces, quality
from tests.llm.cases import SF_DIR, docs_frame
from tests.llm.test_duplicate_operators import classes_by_hand, kept_by_hand


def test_stages_do_what_their_operators_find(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [
        "quality_rules", "near_duplicates", "repeated_passages", "benchmark_decontamination", "piece_encoding"
    ]

    good = stages["quality_rules"](spark, docs, SF_DIR).cache()
    kept = {r.doc_id for r in quality.judge_quality(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == docs.columns and len(kept) < docs.count()

    single = stages["near_duplicates"](spark, good, SF_DIR).cache()
    firsts = {c for _, c in classes_by_hand([(r.doc_id, r.text) for r in good.collect()])}
    assert sorted(r.doc_id for r in single.collect()) == sorted(firsts) and single.schema == docs.schema

    fresh = stages["repeated_passages"](spark, single, SF_DIR).cache()
    before = {r.doc_id: r for r in single.collect()}
    gone = {k: n for k, _, n, _, _ in kept_by_hand([(k, r.text) for k, r in before.items()], 50)}
    assert sum(gone.values()) > 0
    for row in fresh.collect():
        old = before.pop(row.doc_id)
        assert (row.lang, row.source, row.n_chars) == (old.lang, old.source, len(row.text))
        assert (row.text == old.text) == (gone[row.doc_id] == 0)
    assert not before and fresh.dtypes == docs.dtypes

    clean = stages["benchmark_decontamination"](spark, fresh, SF_DIR).cache()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    dirty = {r.doc_id for r in decontaminate.find_items(fresh, items).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in fresh.collect()} - dirty

    tokens = stages["piece_encoding"](spark, clean, SF_DIR)
    texts = {r.doc_id: r.text for r in clean.collect()}
    v = pieces.vocabulary(pieces.VOCABULARY)
    for row in tokens.collect():
        assert row.round_trip and pieces.decode_ids(np.array(row.ids), v) == texts[row.doc_id]
        assert row.n_tokens == len(row.ids) and (row.n_tokens > 0) == bool(texts[row.doc_id])


def test_stages_bear_odd_rows(spark):
    docs = docs_frame(spark).withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long")})
    kept = docs
    for name, stage in corpus_pipeline.STAGES[1:4]:
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns, name
    rows = kept.collect()
    assert len(rows) == len({r.doc_id for r in rows}) and all(r.chunk == "und" for r in rows)
    assert corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs.limit(0), SF_DIR).collect() == []


def test_the_whole_run(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert found and all(r.round_trip for r in found)

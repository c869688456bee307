"""The pipeline's stages one after the other, and its registration."""

import re
from collections import Counter

import __spark_entry__ as driver
import corpus_pipeline
from tidemart.llm.common import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stored(stage(spark, kept[-1], FOLDER), name))
        assert kept[-1].columns == columns, name
    first, known, alone, clean, mixed = [k.collect() for k in kept]
    assert {r["doc_id"] for r in known} == {r["doc_id"] for r in first if re.search(r"[^\W\d_]", r["text"] or "")}
    assert 0 < len(alone) < len(known) and len({r["text"] for r in alone}) == len(alone)
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in alone}
    assert not any(re.search(r"[a-z]@[a-z]+\.[a-z]", r["text"]) for r in clean)
    assert set(Counter(r["doc_id"] for r in mixed).values()) <= {1, 2, 3}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[-1], FOLDER).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        assert docs.count() == 0


def test_registered():
    names = driver.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))

"""The pipeline's stages, each judged on its own input."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from test_packing import check
from test_simhash import brute as near

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")


def test_stages(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(DATA))
        out.write.parquet(f"{tmp_path}/{name}")
        seen.append((docs, out := spark.read.parquet(f"{tmp_path}/{name}")))
        docs = out
    columns = seen[0][0].columns
    assert all(out.columns == columns for _, out in seen[:-1])
    texts = [[(r.doc_id, r.text, r.source) for r in out.collect()] for _, out in seen[:-1]]
    assert {i for i, _, _ in texts[0]} < {r.doc_id for r in seen[0][0].collect()}
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t)
    assert sorted(strip(t) for _, t, _ in texts[1]) == sorted({strip(t) for _, t, _ in texts[0]})
    classes = near([(i, t) for i, t, _ in texts[1]])
    assert sorted(i for i, _, _ in texts[2]) == sorted({c for _, _, c in classes})
    have = {i: len(t.split()) for i, t, _ in texts[2]}
    taken = {}
    for i, t, _ in texts[3]:
        taken[i] = taken.get(i, 0) + len(t.split())
    assert all(n <= 2 * have[i] for i, n in taken.items()) and sum(taken.values()) == pytest.approx(1.5 * sum(have.values()), rel=0.03)
    # A document taken in two passes is two rows here; numbered, they can be checked like others.
    rows = [(k, t, s) for k, (_, t, s) in enumerate(texts[3])]
    renamed = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from tickloom.llm import packing

    check(rows, packing.pack(renamed).collect())


def test_run(spark):
    assert corpus_pipeline.run(spark, str(DATA)).count() > 0 and corpus_pipeline.ORACLE_SQL is None

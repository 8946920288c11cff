"""The pipeline's stages, and queries that other tests reach only through their operators, on odd tables."""

import base64
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import exact_dedup, warc

KINDS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ["id", "row", "key", "part", "gone", "_gone", "fp", "component", "kept", "size", "taken", "shard", "score", "queue", "shared", "label", "norm", "digest"]


def labels(spark, root, n=40):
    rows = [(k, int(k % 3 != 0), 0) for k in range(n)]
    spark.createDataFrame(rows, "doc_id long, quality long, toxic long").write.mode("overwrite").parquet(f"{root}/labels.parquet")


def documents(spark):
    good = "The committee met on the second day and agreed on a plan for the coming season in some detail number"
    rows = [(k, f"{good} {k} {'x' * (k % 5)} with words {k * 7}." if k % 3 else f"$$ !! {k} @@ ## zz zz zz zz {k}", "en", None if k % 7 == 0 else f"s{k % 3}", 1) for k in range(40)]
    rows += [(None, None, None, None, None), (None, f"{good} 1 x with words 7.", "en", "s1", None), (50, "", "en", "s1", 0), (51, None, "en", None, 0), (52, " \n\t ", None, "s1", 3), (7, rows[7][1], "en", "s1", 1), (53, "word " * 60_000, "en", "s2", 300_000)]
    return spark.createDataFrame(rows, KINDS).repartition(5)


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_a_stage_takes_nulls_repeats_long_texts_and_any_column(spark, tmp_path, name, stage):
    labels(spark, tmp_path)
    docs = documents(spark)
    plain = stage(spark, docs, str(tmp_path)).collect()
    clash = docs.withColumns({c: F.lit(5) for c in CLASHES})
    out = stage(spark, clash, str(tmp_path))
    rows = out.collect()
    assert len(rows) == len(plain) > 0
    if name == corpus_pipeline.STAGES[-1][0]:
        assert {(r.doc_id, r.start, r.length) for r in rows} == {(r.doc_id, r.start, r.length) for r in plain}
        return
    assert out.columns == clash.columns and all(r[c] == 5 for r in rows for c in CLASHES)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text is None, r.text or "")
    # What stays, of rows that are alike in all the stage looks at, may be any of them.
    assert sorted(map(key, rows)) == sorted(map(key, plain))


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_a_stage_takes_an_empty_table(spark, tmp_path, name, stage):
    labels(spark, tmp_path)
    assert stage(spark, documents(spark).limit(0), str(tmp_path)).collect() == []


def test_op2_query(spark, tmp_path):
    rows = [(k, "u", f"<p>{k % 9}</p>") for k in range(60)] + [(100, None, None), (101, "u", ""), (102, "u", "é" * 3000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit(1)).write.parquet(f"{tmp_path}/pages.parquet")
    df = warc.op2_warc_writer(spark, str(tmp_path))
    got = sorted(tuple(r) for r in df.collect())
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(last.get(h or "", -1), i)
    want = []
    for i, _, h in rows:
        h = h or ""
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append((i, len(h.encode()), digest, *(("response", None) if last[h] == i else ("revisit", last[h]))))
    assert got == sorted(want)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cur = con.execute(warc.ORACLE)
    assert [d[0] for d in cur.description] == df.columns and sorted(cur.fetchall()) == got


def test_op3_query(spark, tmp_path):
    rows = [(k, f" te xt{k % 8}" + " " * (k % 3)) for k in range(50)] + [(100, None), (101, ""), (102, " \t\n"), (103, "z" * 500_000), (104, "z " * 500_000)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("x")).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in exact_dedup.op3_exact_dedup(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({exact_dedup.ORACLE})").fetchall())
    assert len(got) == 55 and {r[1] for r in got if r[0] in (103, 104)} == {104}

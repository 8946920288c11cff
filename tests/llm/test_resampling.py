"""Importance resampling against n-grams as strings, and against its SQL."""

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path
from zlib import crc32

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import resampling

DATA = Path("/root/testdata/sf0.001")
KINDS = "doc_id long, text string"


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def buckets_of(text):
    w = words_of(text)
    return [crc32(" ".join(w[i : i + g]).encode()) % 10_000 for g in (1, 2, 3) for i in range(len(w) - g + 1)]


def brute(docs, targets):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets_of(text))
    for text in targets:
        t.update(buckets_of(text))
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        found = buckets_of(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(text)) >= 20])
    long_enough = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(long_enough[: 5 * len(long_enough) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAZé漢ß09 \n-_\x00\x7f\u0085\xa0 "), max_size=60), st.integers(1, 9))
def test_features(text, most):
    before, resampling.SLICE = resampling.SLICE, most
    resampling.slices.__defaults__ = (most,)
    try:
        got = Counter(b for _, f in resampling.features(text.encode()) for b in f.tolist())
        assert sum(n for n, _ in resampling.features(text.encode())) == len(words_of(text))
    finally:
        resampling.SLICE = before
        resampling.slices.__defaults__ = (before,)
    assert got == Counter(buckets_of(text))


def test_random_tables(spark):
    rng = random.Random(4)
    vocab = ["Alpha", "beta", "γάμμα", "délta", "e1", "42", "zeta", "éta"]
    docs = [(k, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocab, k=rng.choice([0, 3, 19, 20, 21, 60])))) for k in range(300)]
    docs += [(None, docs[5][1]), (None, None), (7, docs[7][1]), (7, docs[7][1]), (900, ""), (901, "... --- !!!")]
    targets = [" ".join(rng.choices(vocab[:3], k=30)) for _ in range(5)] + [None, ""]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], KINDS + ", score long, bucket string").repartition(7)
    got = found(resampling.resampled(df, spark.createDataFrame([(x, 1) for x in targets], "text string, n long")))
    assert got == brute(docs, targets)
    assert [r[4] for r in sorted((r for r in got if r[4]), key=lambda r: r[4])] == list(range(1, 1 + 5 * sum(len(words_of(t)) >= 20 for _, t in docs) // 100))


def test_equal_scores_go_to_the_smaller_identifier(spark, monkeypatch):
    monkeypatch.setattr(resampling, "noise", lambda doc_id, seed=42: 0)
    docs = [(k, "a " * 25) for k in range(100)]
    rows = spark.createDataFrame(docs, KINDS).repartition(9)
    got = {r.id: r.rank for r in resampling.resampled(rows, rows.limit(3)).collect() if r.rank}
    assert got == {k: k + 1 for k in range(5)}


def test_empty_tables_and_long_texts(spark):
    none = spark.createDataFrame([], KINDS)
    assert found(resampling.resampled(none, none)) == []
    docs = [(1, "Wörd " * 600_000), (2, "x" * 3_000_000), (3, "a b c")]
    assert found(resampling.resampled(spark.createDataFrame(docs, KINDS), none)) == brute(docs, [])


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    targets = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    df = resampling.op13_importance_resampling(spark, str(DATA))
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = found(df)
    assert got == brute(docs, targets)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    assert sorted(con.execute(resampling.ORACLE).fetchall(), key=repr) == got

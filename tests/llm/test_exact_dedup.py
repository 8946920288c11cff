import hashlib
import re

from pyspark.sql import functions as F

from tickloom.llm import exact_dedup as ed


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for (i, t), n in zip(rows, norm):
        groups.setdefault(n, []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for (i, t), n in zip(rows, norm):
        best = min(groups[n])
        out.append((i, best[3], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()))
    return out, {n: min(g)[3] for n, g in groups.items()}


def data():
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a\x0bb\x0c"), (8, "a b"), (9, "é😀"), (10, "é 😀"), (None, "null id"), (11, "nullid"), (12, "long " * 50_000), (13, "long" * 50_000)]
    prefix = "the same first characters of a text " * 3
    rows += [(100 + k, prefix + str(k % 5)) for k in range(60)]
    return rows + [(1000 + k, "hot copy") for k in range(400)] + [(50, "twice"), (50, "twice"), (51, "twice ")]


def test_matches_brute_force_over_many_partitions(spark):
    rows = data()
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS digest", "1 AS part", "2 AS run", "3 AS id").repartition(9)
        found = ed.exact_dedup(docs).cache()
        got = [(r.id, r.keep_id, r.group_size, r.text_sha256) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want, keep = brute(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = [r.id for r in found.where("kept").collect()]
    assert sorted(map(str, kept)) == sorted(map(str, keep.values()))  # one row a group, though rows repeat
    found.unpersist()


def test_stage_keeps_columns_and_text(spark):
    docs = spark.createDataFrame([(1, "x y", "en", "s", 3), (2, "xy", "en", None, 2), (3, None, None, "s", None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = ed.dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.select("doc_id", F.coalesce("text", F.lit("-"))).collect()) == [(1, "x y"), (3, "-")]
    assert ed.dedup_stage(spark, docs.limit(0), "").count() == 0

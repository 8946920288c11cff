import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickloom.llm import simhash
from tickloom.llm.components import components


def brute(rows, radius=4):
    import re

    fps = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sh = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    for k, (i, _) in enumerate(rows):  # rows of one identifier are one document
        for j in range(k):
            if i is not None and rows[j][0] == i:
                a, b = comp[k], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    least = {}
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return {(i, f"{f:016x}", least.get(c)) for (i, _), f, c in zip(rows, fps, comp, strict=True)}


def rows():
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(300)]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO"), (5, "É é É")]
    for k in range(30):
        base = [words[i] for i in rng.integers(0, 300, 120)]
        for c in range(4):
            other = list(base)
            for i in rng.integers(0, 120, c * 2):
                other[i] = "x" + str(rng.integers(0, 9))
            out.append((10 + 4 * k + c, " ".join(other)))
    return out + [(500, "long " * 40_000)]


def test_matches_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("id", F.lit("clash"))
    got = simhash.near_duplicates(docs).select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component").collect()
    assert {tuple(r) for r in got} == brute(data)


@pytest.mark.parametrize("bucket", [3, 20_000])
def test_covering_finds_every_pair(spark, bucket):
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.integers(0, 2**63, 60)]
    for f in fps[:40]:
        flips = rng.choice(64, rng.integers(1, 7), replace=False)
        fps.append(f ^ sum(1 << int(b) for b in flips))
    fps = list(dict.fromkeys(fps))
    entries = spark.createDataFrame([(i, simhash._signed(f)) for i, f in enumerate(fps)], "id long, fp long")
    got = {r.node: r.component for r in components(simhash.links(entries, 4, bucket)).collect()}
    comp = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    assert [got.get(i, i) for i in range(len(fps))] == comp


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 150))


def test_empty_table_and_stage(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    docs = spark.createDataFrame([(4, "a b c d e"), (2, "a b c d e"), (9, "quite another text here")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.simhash_stage(spark, docs, "").collect()) == [2, 9]
    clash = docs.withColumn("_gone", F.lit(2)).withColumn("gone", F.lit(2)).withColumn("id", F.lit(2))
    out = simhash.simhash_stage(spark, clash, "")
    assert out.columns == clash.columns and sorted(r.doc_id for r in out.collect()) == [2, 9]


def test_null_and_repeated_identifiers(spark):
    """A row without an identifier between two documents links them; so does an identifier with several texts."""
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in rng.integers(0, 400, 200)]
    chain = [list(words)]
    for _ in range(12):
        step = list(chain[-1])
        step[rng.integers(0, 200)] = f"x{rng.integers(0, 99)}"
        chain.append(step)
    texts = [" ".join(c) for c in chain]
    data = [(1 if k == 0 else 9 if k == 12 else None, t) for k, t in enumerate(texts)]
    data += [(20, "alone with this text of some words"), (21, "another text that nothing else is like at all"), (20, "another text that nothing else is like at all")]
    data += [(None, "only rows without an identifier have this text"), (None, "only rows without an identifier have this text"), (30, texts[0]), (30, texts[0])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = simhash.near_duplicates(docs).select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component").collect()
    assert {tuple(r) for r in got} == brute(data) and len(got) == len(data)
    assert {c for i, _, c in brute(data) if i == 9} == {1}


def test_query(spark, tmp_path):
    data = [*rows(), (None, "One two"), (3, "One two")]
    spark.createDataFrame([(*r, "x") for r in data], "doc_id long, text string, fingerprint string").write.parquet(f"{tmp_path}/documents.parquet")
    df = simhash.op5_simhash_covering(spark, str(tmp_path))
    assert df.columns == ["doc_id", "fingerprint", "component_id"]
    got = df.collect()
    assert {tuple(r) for r in got} == brute(data) and len(got) == len(data)

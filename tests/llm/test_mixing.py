from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tickloom.llm import mixing


@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(size, key):
    assert sorted(mixing.permute(np.arange(size), size, key).tolist()) == list(range(size))


def shared(sizes, weights=(5, 2, 1)):
    """Exact targets: the level at which sources, fullest first, use up one and a half times all words."""
    order = sorted(range(len(sizes)), key=lambda i: Fraction(2 * sizes[i], weights[i % 3]))
    left, out = Fraction(3 * sum(sizes), 2), [Fraction(0)] * len(sizes)
    for k, i in enumerate(order):
        w = weights[i % 3]
        out[i] = min(Fraction(2 * sizes[i]), left * w / sum(weights[j % 3] for j in order[k:]))
        left -= out[i]
    return [float(x) for x in out]


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 5, 0, 300], [0, 0], [7], [1, 1, 1, 5000, 2, 900, 40, 40, 40]])
def test_targets(spark, sizes):
    table = spark.createDataFrame([((0, f"s{i:02}"), n) for i, n in enumerate(sizes)], "source struct<absent:int,name:string>, size long").repartition(3)
    got = [r.target for r in mixing.planned(table).orderBy("rank").collect()]
    assert got == pytest.approx(shared(sizes))


def test_running(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), i, int(v)) for i, (g, v) in enumerate(zip(rng.choice(5, 2000, p=[0.8, 0.05, 0.05, 0.05, 0.05]), rng.integers(0, 50, 2000)))]
    got = mixing.running(spark.createDataFrame(rows, "g long, i long, v long").repartition(5), "g", ["i"], "v", "at").collect()
    sums, want = defaultdict(int), {}
    for g, i, v in rows:
        want[i] = sums[g]
        sums[g] += v
    assert {r.i: r["at"] for r in got} == want


def test_draws_in_groups(spark):
    plan = spark.createDataFrame([(i, 10 * (i + 1)) for i in range(23)], "rank long, slots long")
    counts, total = mixing.drawn(plan, 100, 1, group=4)
    got = counts.collect()
    assert total == 2760 and {s: sum(r.slots for r in got if r.shard == s) for s in range(28)} == {s: 100 for s in range(28)}
    assert {r["rank"]: r.slots for r in got if r.shard == 28} == {i: 10 * (i + 1) for i in range(23)}


def test_same_result_in_another_layout(spark, tmp_path):
    docs = spark.createDataFrame(data(), "doc_id long, text string, source string")
    docs.repartition(1).write.parquet(f"{tmp_path}/one/documents.parquet")
    docs.repartition(7).write.parquet(f"{tmp_path}/more/documents.parquet")
    one, more = (sorted(map(str, mixing.op4_source_mixing(spark, f"{tmp_path}/{d}").collect())) for d in ("one", "more"))
    assert one == more


def data():
    rng = np.random.default_rng(0)
    rows = [(i, " \n".join(f"d{i}w{k}" for k in range(rng.integers(0, 300))), ["b", "a", None, "c", "b"][i % 5]) for i in range(300)]
    return rows + [(7, "repeated row", "a"), (7, "repeated row", "a"), (None, "x y", "b"), (901, None, "a"), (902, "long " * 30_000, "c"), (903, "alone", "z")]


def test_mix(spark, tmp_path):
    rows = data()
    spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 AS size", "2 AS target").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op4_source_mixing(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.op4_source_mixing(spark, str(tmp_path)).collect()))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, _ in rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    names = ["a", "b", "c", "z", None]
    aims = dict(zip(names, shared([sizes[s] for s in names])))
    by_target = defaultdict(int)
    for r in got:
        assert r.taken <= 2 * r.size
        by_target[r.target, r.source_size] += r.taken
    for s in names:
        assert abs(by_target[aims[s], sizes[s]] - aims[s]) <= 0.51, s


def test_stage_takes_what_the_mix_says(spark):
    rows = data()
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mixing_stage(spark, docs, "")
    assert out.columns == docs.columns
    rows_, taken = mixing.mix(docs)
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == sum(r.words for r in taken.collect())
    whole = {t for _, t, _ in rows}
    assert any(r.text in whole for r in out.collect())
    assert mixing.mixing_stage(spark, docs.limit(0), "").count() == 0

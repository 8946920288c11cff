"""Interval joins, price impact, rank correlations, sketches and moments against plain Python."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import impact, intervals, normalize, quotes, rank_ic, sketches

DAY = datetime.date(2024, 1, 16)
TRADES = "symbol string, trade_date date, seq long, ts_recv_ns long, price_nano long, size long"
QUOTES = "symbol string, trade_date date, seq long, ts_recv_ns long, bid_px_nano long, bid_sz long, ask_px_nano long, ask_sz long"


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_overlapping_intervals(spark, width):
    rng = np.random.default_rng(2)
    points = [(k, str(rng.choice(["a", "b"])), int(rng.integers(-50, 400))) for k in range(300)]
    spans = [(k, str(rng.choice(["a", "b", "c"])), s := int(rng.integers(-60, 380)), s + int(rng.choice([0, 1, 5, 40, 300]))) for k in range(80)]
    p = spark.createDataFrame(points, "id long, k string, at long").repartition(3)
    s = spark.createDataFrame(spans, "span long, k string, low long, high long").repartition(3)
    hits = {(i, j) for i, k, at in points for j, q, low, high in spans if k == q and low <= at < high}
    got = [(r.id, r.span) for r in intervals.interval_join(p, s, ["k"], "at", "low", "high", width, "inner").collect()]
    assert len(got) == len(hits) and set(got) == hits
    left = intervals.interval_join(p, s, ["k"], "at", "low", "high", width).collect()
    assert {(r.id, r.span) for r in left} == hits | {(i, None) for i, _, _ in points if i not in {h for h, _ in hits}}


def test_quotes_in_force_are_as_of_quotes(spark):
    rng = np.random.default_rng(6)
    days = [DAY, DAY + datetime.timedelta(1)]
    base = {d: int(datetime.datetime(d.year, d.month, d.day, 14, 30, tzinfo=datetime.UTC).timestamp()) * 10**9 for d in days}
    q = [("S", d, k, base[d] + int(rng.integers(0, 200)) * 10**9, 10**11, 1, 10**11 + int(rng.choice([-1, 1, 2])) * 10**7, k) for d in days for k in range(150)]
    t = [("S", d, 1000 + k, base[d] + int(rng.integers(-20, 220)) * 10**9, 10**11, 5) for d in days for k in range(200)]
    quoted, traded = spark.createDataFrame(q, QUOTES).repartition(3), spark.createDataFrame(t, TRADES).repartition(3)
    got = intervals.quotes_in_force(traded, quoted)
    want = quotes.as_of_quotes(traded, quoted).select(got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    none = spark.createDataFrame([], QUOTES)
    assert {r.quote_ts for r in intervals.quotes_in_force(traded, none).collect()} == {None}


def test_buckets_are_as_many_as_intervals(spark):
    spans = spark.createDataFrame([(k, 0, k * k) for k in range(1, 200)], "i long, low long, high long")
    width = intervals.mean_length(spans, "low", "high")
    assert spans.select(F.sum(F.expr(f"(high - 1) div {width} - low div {width} + 1"))).first()[0] <= 2 * 199 + 1


def ticks(spark, rows):
    return spark.createDataFrame([("S", DAY, k, k, p, n) for k, (p, n) in enumerate(rows)], TRADES).repartition(3)


def test_tick_test(spark):
    got = {r.seq: r.tick_sign for r in impact.with_tick_test(ticks(spark, [(p, 1) for p in (5, 5, 6, 6, 6, 4, 4, 7, 7)])).collect()}
    assert [got[k] for k in range(9)] == [0, 0, 1, 1, 1, -1, -1, 1, 1]


def test_kyle_lambda_is_the_slope(spark):
    rng = np.random.default_rng(9)
    rows = [(10**11 + int(rng.integers(-50, 50)) * 10**7, int(rng.integers(-300, 300))) for _ in range(120)] + [(10**11, 50)] * 20
    got = {r.seq: r.kyle_lambda for r in impact.with_kyle_lambda(ticks(spark, rows), F.col("size"), 10).collect()}
    price, volume = (np.array(c, float) for c in zip(*rows, strict=True))
    change = np.diff(price, prepend=price[0]) * 1e-9
    for k in range(len(rows)):
        v, x = volume[k - 9 : k + 1], change[k - 9 : k + 1]
        if k < 9 or np.ptp(v) == 0:
            assert got[k] is None
        else:
            assert got[k] == pytest.approx(np.polyfit(v, x, 1)[0], rel=1e-9, abs=1e-15)


def test_rank_ic_with_ties_and_nulls(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    rows = [(DAY + datetime.timedelta(int(d)), float(rng.integers(0, 6)), float(rng.normal()), None if rng.random() < 0.1 else float(rng.integers(0, 4)), 1.0) for d in range(5) for _ in range(60)]
    df = spark.createDataFrame(rows, "trade_date date, a double, b double, y double, flat double").repartition(4)
    got = {(r.trade_date, r.feature): (r.n, r.ic) for r in rank_ic.rank_ic(df, ["a", "b", "flat"], "y").collect()}
    frame = pd.DataFrame(rows, columns=["d", "a", "b", "y", "flat"]).dropna()
    for d, day in frame.groupby("d"):
        for f in ("a", "b"):
            assert got[d, f] == (len(day), pytest.approx(np.corrcoef(day[f].rank(), day["y"].rank())[0, 1]))
        assert got[d, "flat"] == (len(day), None)


def test_bootstrap_is_reproducible_and_covers(spark):
    rng = np.random.default_rng(1)
    rows = [(DAY + datetime.timedelta(d), "f", 50, float(rng.normal(0.1, 0.05))) for d in range(60)] + [(DAY, "g", 5, None)]
    df = spark.createDataFrame(rows, "trade_date date, feature string, n long, ic double")
    one, two, three = (rank_ic.bootstrap(x, seed=s).collect() for x, s in ((df, 7), (df.repartition(5), 7), (df, 8)))
    (r,) = one
    assert (r.feature, r.blocks) == ("f", 60) and (r.low, r.high) == pytest.approx((two[0].low, two[0].high)) and r.low != three[0].low
    half = 1.96 * np.std([x[3] for x in rows[:60]]) / 60**0.5
    assert r.low < r.mean_ic < r.high and (r.high - r.low) / 2 == pytest.approx(half, rel=0.3)
    weights = spark.range(20_000).select(rank_ic.poisson_weight(1, F.col("id"), F.lit("x")).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert weights[0] == pytest.approx(1, abs=0.03) and weights[1] == pytest.approx(1, abs=0.05)


def test_sketches_merge_like_one_pass(spark):
    rng = np.random.default_rng(5)
    days = [DAY + datetime.timedelta(d) for d in range(4)]
    rows = [(s, d, k, k, int(p), int(n)) for s in ("A", "B") for d in days for k, (p, n) in enumerate(zip(rng.integers(0, 3000, 2000), rng.integers(1, 5000, 2000), strict=True))]
    df = spark.createDataFrame(rows, TRADES).repartition(4)
    daily = sketches.daily_sketches(df)
    (r,) = sketches.estimates(sketches.merged(daily, F.lit("all").alias("all"))).collect()
    sizes = np.sort([x[5] for x in rows])
    assert r.trades == 16_000 and abs(r.distinct_prices - len({x[4] for x in rows})) <= 0.065 * 3000
    for rank, got in ((0.1, r.size_10), (0.5, r.size_50), (0.9, r.size_90)):
        assert abs(np.searchsorted(sizes, got) / 16_000 - rank) < 0.03


def test_moments_of_the_training_days_scale_all(spark):
    rng = np.random.default_rng(4)
    names = ("u", "v")
    rows = [("S", DAY + datetime.timedelta(int(d)), b, float(rng.normal(1e6 + d, 2)), float("nan") if b == 3 else float(rng.integers(0, 9))) for d in range(6) for b in range(40)]
    df = spark.createDataFrame(rows, "symbol string, trade_date date, bin_idx long, u double, v double").repartition(4)
    cut = DAY + datetime.timedelta(3)
    train = np.array([r[3:] for r in rows if r[1] <= cut])
    m = {r.feature: r for r in normalize.merged_moments(normalize.day_moments(df.where(F.col("trade_date") <= F.lit(cut)), names)).collect()}
    for k, f in enumerate(names):
        x = train[:, k][~np.isnan(train[:, k])]
        assert (m[f].n, m[f].mean, m[f].m2) == (len(x), pytest.approx(x.mean(), rel=1e-14), pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-9))
    got = {(r.trade_date, r.bin_idx): (r.u, r.v) for r in normalize.globally_normalized(df, F.col("trade_date") <= F.lit(cut), features=names).collect()}
    x = train[:, 0]
    for _, d, b, u, _ in rows:
        assert got[d, b][0] == pytest.approx((u - x.mean()) / x.std(), abs=1e-6)
    none = normalize.globally_normalized(df, F.lit(False), features=names).select("u", "v").distinct().collect()
    assert [tuple(r) for r in none] == [(None, None)]

"""The day plan against the record-at-a-time model, on random streams with every kind of oddity."""

import datetime

import numpy as np
import pytest

from tickloom.config import Config
from tickloom.plans import day
from tickloom.schema import EVENTS, FEATURES
from model import UNDEFINED, run_day

DAY = datetime.date(2024, 1, 16)
OPEN = int(datetime.datetime(2024, 1, 16, 14, 30, tzinfo=datetime.UTC).timestamp()) * 10**9
CLOSE = OPEN + 23_400 * 10**9


def stream(seed, late):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 400))
    step = rng.choice([1, 1, 5, 40, 400], n) * rng.choice([0, 10**8, 10**9, 3 * 10**9], n)
    ts = OPEN - int(rng.integers(0, 300)) * 10**9 + np.cumsum(step)
    if late:
        ts = ts - rng.choice([0, 0, 0, 2 * 10**9, 90 * 10**9], n)
    if n and rng.random() < 0.5:
        ts[-int(rng.integers(1, 30)) :] += 30_000 * 10**9
    if n > 5:
        ts[2], ts[3] = OPEN, OPEN
    if not late:
        ts = np.sort(ts)
    rows = []
    for i, t in enumerate(ts.tolist()):
        bid = 100_000_000_000 + int(rng.integers(-20, 20)) * 10_000_000
        ask = bid + int(rng.choice([-1, 0, 1, 1, 2, 3])) * 10_000_000
        kind = rng.random()
        rows.append(
            dict(
                symbol="S", trade_date=DAY, seq=i * 3, ts_event_ns=t, ts_recv_ns=t, action=str(rng.choice(["T", "T", "A", "C"])), side="N", flags=0,
                price_nano=int(rng.choice([0, -5, UNDEFINED])) if kind < 0.05 else bid + int(rng.integers(-5, 30)) * 1_000_000 + int(rng.choice([0, 400_000])),
                size=int(rng.choice([0, 1, 50, 100, 12_000])), bid_px_nano=UNDEFINED if rng.random() < 0.05 else bid, bid_sz=int(rng.integers(0, 5)), ask_px_nano=ask, ask_sz=int(rng.integers(0, 5)), publisher_id=int(rng.choice([81, 82, 83, 82, 88, 89, 93, 999])),
            )
        )
    return rows


def settings(seed):
    rng = np.random.default_rng(seed + 1000)
    return dict(bin=int(rng.choice([10, 60, 600])), warmup=int(rng.choice([0, 1, 3])), gaps=int(rng.choice([2, 3, 10])), detect=bool(rng.random() < 0.7), burst=int(rng.choice([2, 3, 5])))


@pytest.mark.parametrize("seed", range(8))
def test_feature_bins(spark, seed):
    """Several symbols a run: each has a day of its own, so nothing may leak between them."""
    s = settings(seed)
    cfg = Config().with_(sampling={"bin_size_seconds": s["bin"]}, validation={"warmup_bins": s["warmup"], "close_detection_gap_bins": s["gaps"], "auto_detect_close": s["detect"], "burst_threshold": s["burst"], "min_trades_per_bin": 2})
    days = {f"S{k}": [r | {"symbol": f"S{k}"} for r in stream(seed * 100 + k, False)] for k in range(6)}
    events = spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for rows in days.values() for r in rows], EVENTS).repartition(5)
    got = {}
    for r in day.feature_bins(events, cfg).collect():
        got.setdefault(r.symbol, []).append(r)
    for name, rows in days.items():
        want = run_day(rows, OPEN, CLOSE, s["bin"] * 10**9, s["warmup"], s["gaps"], s["detect"], 2, burst_k=s["burst"])
        have = sorted(got.get(name, []), key=lambda r: r.bin_idx)
        assert [(r.bin_idx, r.bin_end_ns, r.is_gap, r.is_final) for r in have] == [w[:4] for w in want], (name, s)
        for r, w in zip(have, want):
            assert r.mid_price == pytest.approx(w[4], abs=1e-12)
            for f, x in zip(FEATURES, w[5]):
                assert r[f] == pytest.approx(x, rel=1e-9, abs=1e-9), (name, r.bin_idx, f)


def test_late_records(spark):
    cfg = Config().with_(validation={"warmup_bins": 0})
    rows = stream(77, True)
    events = spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)
    want = run_day(rows, OPEN, CLOSE, 60 * 10**9, 0)
    have = sorted(day.feature_bins(events, cfg, times_in_order=False).collect(), key=lambda r: r.bin_idx)
    assert len(have) == len(want)
    for r, w in zip(have, want):
        assert (r.bin_idx, r.bin_end_ns) == w[:2]
        for f, x in zip(FEATURES, w[5]):
            assert r[f] == pytest.approx(x, rel=1e-9, abs=1e-9), (r.bin_idx, f)


def test_empty_day(spark):
    assert day.feature_bins(spark.createDataFrame([], EVENTS), Config()).count() == 0

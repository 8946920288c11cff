"""Streaming bins: watermarked output in append mode, against the batch plan."""

import datetime

from tickloom.config import Config
from tickloom.operators.bins import with_bins
from tickloom.schema import EVENTS
from tickloom.streaming import bins
from test_day import OPEN, stream


def test_append_mode_drops_only_late_rows_and_open_bins(spark, tmp_path):
    cfg = Config()
    rows = [r for r in stream(5, False) if r["ts_recv_ns"] < OPEN + 23_400 * 10**9]
    far = rows[-1] | {"seq": 10**6, "ts_recv_ns": OPEN + 23_000 * 10**9, "action": "T", "price_nano": 10**11, "size": 1}
    for name, part in (("a", rows), ("b", [far])):
        spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in part], EVENTS).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    bins.run_once(bins.stream_bins(source, cfg), f"{tmp_path}/out", f"{tmp_path}/ck")
    got = {r.bin_idx: (r.trades, r.trf_volume) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = with_bins(spark.read.parquet(f"{tmp_path}/in/a"), cfg).where("action = 'T' and in_session and price_nano > 0 and price_nano <> 9223372036854775807")
    want = {r.bin_idx: (r["count"],) for r in batch.groupBy("bin_idx").count().collect()}
    assert {k: v[:1] for k, v in got.items()} == want
    assert datetime.date(2024, 1, 16) == rows[0]["trade_date"]


def test_bins_start_at_the_open(spark, tmp_path):
    cfg = Config().with_(sampling={"market_open_et": "09:35", "bin_size_seconds": 600})
    rows = [r for r in stream(6, False) if r["ts_recv_ns"] < OPEN + 23_400 * 10**9]
    spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS).write.parquet(f"{tmp_path}/in/a")
    source = spark.readStream.schema(EVENTS).parquet(f"{tmp_path}/in/*")
    bins.snapshot(bins.stream_bins(source, cfg), f"{tmp_path}/out", f"{tmp_path}/ck")
    got = {r.bin_idx: r.trades for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = with_bins(spark.read.parquet(f"{tmp_path}/in/a"), cfg).where("action = 'T' and in_session and price_nano > 0 and price_nano <> 9223372036854775807")
    assert got == {r.bin_idx: r["count"] for r in batch.groupBy("bin_idx").count().collect()}

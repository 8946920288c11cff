"""Carried state, session windows and the exactly-once sink against the batch plan."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.operators import aggregates, bins
from tickloom.plans import day
from tickloom.schema import DAY, EVENTS
from tickloom.streaming import sessions, sink, state
from test_day import CLOSE, OPEN, stream

COLUMNS = ["symbol", "bin_idx", "bin_end_ns", "is_gap", "is_flush", "trades", "trf_trades", "dropped", "updates", "trf_buy_vol", "trf_sell_vol", "trf_unsigned_vol", "trf_vol", "lit_vol", "bid", "ask", "bid_size", "ask_size", "mid_price", "quote_ts"]


@pytest.fixture
def rocks(spark):
    with state.carried(spark):
        yield


def batch_bins(events, cfg):
    sums = aggregates.bin_aggregates(aggregates.with_previous(day.records(events, cfg), cfg), cfg)
    from tickloom.operators.features import with_state

    found = with_state(bins.emitted(bins.day_grid(sums, cfg), cfg))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("symbol", "bin_idx", "bin_end_ns", "is_gap", "is_flush", *map(zero, COLUMNS[5:14]), *[F.col(f"state.{c}").alias(c) for c in ("bid", "ask", "bid_size", "ask_size")], "mid_price", F.col("state.ts").alias("quote_ts"))


def put(spark, root, slices):
    for k, rows in enumerate(slices):
        if rows:
            spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS).coalesce(1).write.parquet(f"{root}/in/{k:03}")


def read(spark, root):
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")


def end(symbol="END"):
    """A record two days later: it takes the watermark past every close."""
    r = stream(3, False)[0]
    return r | {"symbol": symbol, "ts_recv_ns": CLOSE + 2 * 86_400 * 10**9, "seq": 1}


def rows_of(df):
    return sorted(df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed", range(2))
def test_stateful_bins_equal_the_batch_plan_over_batches_and_a_restart(spark, rocks, tmp_path, seed):
    cfg = Config().with_(sampling={"bin_size_seconds": 600}, validation={"auto_detect_close": False, "warmup_bins": 0})
    rows = [r | {"symbol": f"S{k}"} for k in range(6) for r in stream(seed * 50 + k, False)]
    rows.sort(key=lambda r: r["ts_recv_ns"])
    n = len(rows)
    parts = [rows[: n // 4], rows[n // 4 : n // 2], rows[n // 2 : 3 * n // 4], rows[3 * n // 4 :]]
    table, ck = f"{tmp_path}/bins", f"{tmp_path}/ck"
    put(spark, tmp_path, parts[:2])
    sink.run_available(state.stream_state_bins(read(spark, tmp_path), cfg), table, ck)
    first = sink.committed(spark, table).count()
    put(spark, f"{tmp_path}/more", parts[2:])
    for k, p in enumerate(sorted(Path(f"{tmp_path}/more/in").iterdir())):
        shutil.move(p, f"{tmp_path}/in/1{k:02}")
    put(spark, f"{tmp_path}/last", [[end()]])
    sink.run_available(state.stream_state_bins(read(spark, tmp_path), cfg), table, ck)  # from its checkpoint
    shutil.move(f"{tmp_path}/last/in/000", f"{tmp_path}/in/200")
    sink.run_available(state.stream_state_bins(read(spark, tmp_path), cfg), table, ck)
    got = rows_of(sink.committed(spark, table).where("symbol <> 'END'"))
    events = spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)
    assert got == rows_of(batch_bins(events, cfg)) and 0 < first < len(got)


def test_prompt_timers_emit_empty_bins_without_a_further_record(spark, rocks, tmp_path):
    cfg = Config().with_(sampling={"bin_size_seconds": 600}, validation={"auto_detect_close": False})
    quote = next(r for r in stream(7, False) if r["ask_px_nano"] > r["bid_px_nano"] > 0 and r["bid_px_nano"] < 2**62)
    mine = quote | {"symbol": "A", "seq": 1, "ts_recv_ns": OPEN + 10**9, "action": "A"}
    other = quote | {"symbol": "B", "seq": 1, "ts_recv_ns": OPEN + 3_000 * 10**9, "action": "A"}
    put(spark, tmp_path, [[mine], [other]])
    sink.run_available(state.stream_state_bins(read(spark, tmp_path), cfg, prompt=True), f"{tmp_path}/bins", f"{tmp_path}/ck")
    got = sorted((r.bin_idx, r.is_gap, r.is_flush, r.updates, r.bid) for r in sink.committed(spark, f"{tmp_path}/bins").where("symbol = 'A'").collect())
    # The watermark is ten seconds behind the end of the fifth bin.
    assert got == [(k, k > 0, False, int(k == 0), mine["bid_px_nano"] * 1e-9) for k in range(4)]


def test_repeated_records_are_left_out(spark, rocks, tmp_path):
    cfg = Config().with_(sampling={"bin_size_seconds": 600}, validation={"auto_detect_close": False, "warmup_bins": 0})
    rows = stream(11, False)
    put(spark, tmp_path, [rows, rows[len(rows) // 2 :], [end()]])
    sink.run_available(state.stream_state_bins(read(spark, tmp_path), cfg, lateness="12 hours"), f"{tmp_path}/bins", f"{tmp_path}/ck")
    events = spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)
    assert rows_of(sink.committed(spark, f"{tmp_path}/bins").where("symbol <> 'END'")) == rows_of(batch_bins(events, cfg))


def test_sessions_merge_over_batches(spark, tmp_path):
    rows = sorted(stream(21, False) + [r | {"symbol": "T"} for r in stream(22, False)], key=lambda r: r["ts_recv_ns"])
    cut = len(rows) // 3
    last = end() | {"action": "T", "price_nano": 10**9}
    put(spark, tmp_path, [rows[:cut], rows[cut : 2 * cut], rows[2 * cut :], [last]])
    sink.run_available(sessions.activity_sessions(read(spark, tmp_path), lateness="10 seconds"), f"{tmp_path}/s", f"{tmp_path}/ck")
    events = spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)
    want = sessions.activity_sessions(events)
    assert sorted(sink.committed(spark, f"{tmp_path}/s").collect()) == sorted(want.collect())
    assert want.select(F.sum("trades")).first()[0] > want.count() > 2


class Lost(Exception):
    pass


def test_a_batch_that_is_replayed_is_there_once(spark, tmp_path, monkeypatch):
    rows = stream(31, False)
    put(spark, tmp_path, [rows[: len(rows) // 2], rows[len(rows) // 2 :]])
    table, ck = f"{tmp_path}/t", f"{tmp_path}/ck"
    plain = lambda: read(spark, tmp_path).select("symbol", "seq")
    mark = sink._mark

    def dies(spark, path, query, batch):
        if batch == 1:
            raise Lost
        mark(spark, path, query, batch)

    monkeypatch.setattr(sink, "_mark", dies)
    with pytest.raises(Exception, match="Lost"):
        sink.run_available(plain(), table, ck)
    assert sink.committed(spark, table).count() == len(rows) // 2  # written, but not committed
    monkeypatch.setattr(sink, "_mark", mark)
    sink.run_available(plain(), table, ck)
    want = sorted(r["seq"] for r in rows)
    assert sorted(r.seq for r in sink.committed(spark, table).collect()) == want
    # The mark is put, but the query dies before its own commit: the batch comes again and is left alone.
    (Path(ck) / "commits" / "1").unlink()
    (Path(ck) / "commits" / ".1.crc").unlink(missing_ok=True)
    before = {p.name for p in Path(table).rglob("*.parquet")}
    sink.run_available(plain(), table, ck)
    assert {p.name for p in Path(table).rglob("*.parquet")} == before
    assert sorted(r.seq for r in sink.committed(spark, table).collect()) == want
    # Another query on the same table counts from the beginning.
    sink.run_available(plain(), table, f"{tmp_path}/other")
    assert sink.committed(spark, table).count() == 2 * len(rows)

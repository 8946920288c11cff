"""Structured Streaming with carried state: every bin of a day, its quotes and gaps included, as the batch plan has them.

A (symbol, day) holds its last accepted quote, how far its times have come, and the sums of its open bin. A record of a later bin
closes the open one and brings the empty bins between along. Timers do the rest: past the close the last bin is emitted and the
state goes, so what is held follows the days that are still open, not the stream's length. With prompt set, a timer also closes
each bin at its end, and empty bins are emitted when their time has passed instead of with the next record; a day that
falls silent then has empty bins up to its close, where the batch plan ends with the last record.

Records come in the order of seq from batch to batch; within a batch any order will do. Those at or before the last seq seen are
repeats and are left out, as are rows later than the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.config import Config
from tickloom.functions.market import is_lit, is_trade, is_trf, market_time_ns, quote_check, usd
from tickloom.schema import DAY, UNDEFINED_PRICE

#: What a bin adds up, in whole numbers. records counts all that fall into it, the others what the session counts.
SUMS = ("records", "trades", "trf_trades", "dropped", "updates", "trf_buy_vol", "trf_sell_vol", "trf_unsigned_vol", "trf_vol", "lit_vol")
_QUOTE = {"bid": "double", "ask": "double", "bid_size": "long", "ask_size": "long", "quote_ts": "long"}
_KINDS = {"last_seq": "long", "reached": "long", "open_ns": "long", "close_ns": "long", "bin": "long", "armed": "long"} | _QUOTE | dict.fromkeys(SUMS, "long")
_OUT = {"symbol": "string", "trade_date": "date", "bin_idx": "long", "bin_end_ns": "long", "is_gap": "boolean", "is_flush": "boolean"} | dict.fromkeys(SUMS, "long") | _QUOTE
_SPARK = lambda kinds: ", ".join(f"{n} {k}" for n, k in kinds.items())
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long after the close quotes still count for the last bin, as they do in the batch plan.
SETTLE_NS = 4 * 3600 * 10**9


@contextmanager
def carried(spark: SparkSession) -> Iterator[None]:
    """Within, streams that are started keep their state in PROVIDER, which carried state needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def prepared(events: DataFrame, cfg: Config, lateness: str) -> DataFrame:
    """What the state needs of each record, as plain numbers; everything that doesn't depend on state is done here."""
    price, ts = F.col("price_nano"), F.col("ts_recv_ns")
    ok = quote_check(F.col("bid_px_nano"), F.col("ask_px_nano")) == "ok"
    priced = F.coalesce((price != UNDEFINED_PRICE) & (price > 0), F.lit(False))
    opens, closes = (market_time_ns(F.col("trade_date"), at) for at in (cfg.sampling.market_open_et, cfg.sampling.market_close_et))
    traded = is_trade(F.col("action")) & (ts >= opens) & (ts < closes)
    flags = {"ok": ok, "quoted": ok & (ts >= opens) & (ts < closes), "accepted": traded & priced, "dropped": traded & ~priced, "trf": is_trf(F.col("publisher_id")), "lit": is_lit(F.col("publisher_id"))}
    numbers = {"seq": F.col("seq"), "ts": ts, "open_ns": opens, "close_ns": closes, "size": F.coalesce("size", F.lit(0)), "bid_size": F.coalesce("bid_sz", F.lit(0)), "ask_size": F.coalesce("ask_sz", F.lit(0))}
    prices = {"price": F.when(priced, usd(price)).otherwise(0.0), "bid": F.when(ok, usd(F.col("bid_px_nano"))).otherwise(0.0), "ask": F.when(ok, usd(F.col("ask_px_nano"))).otherwise(0.0)}
    timed = events.withColumn("at", F.timestamp_micros(F.expr("ts_recv_ns div 1000"))).withWatermark("at", lateness)
    return timed.select(*DAY, "at", *[c.alias(n) for n, c in (flags | prices).items()], *[c.cast("long").alias(n) for n, c in numbers.items()])


class DayState(StatefulProcessor):
    """The state of a (symbol, day) and what it does with records and timers."""

    def __init__(self, bin_ns: int, band: float, prompt: bool):
        self.bin_ns, self.band, self.prompt = bin_ns, band, prompt

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.day = handle, handle.getValueState("day", _SPARK(_KINDS))

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("seq", kind="stable")
        held = self._held() or dict.fromkeys(_KINDS, 0) | dict.fromkeys(_QUOTE) | {"last_seq": -(2**63), "open_ns": int(new["open_ns"].iloc[0]), "close_ns": int(new["close_ns"].iloc[0])}
        new = new[new["seq"] > held["last_seq"]]
        done = self._taken(held, new) if len(new) else []
        self._keep(held, timerValues.getCurrentWatermarkInMs())
        yield from _rows(key, done)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, now = self._held(), timerValues.getCurrentWatermarkInMs()
        if held is None:
            return
        if now * 1_000_000 >= held["close_ns"] + SETTLE_NS:
            active = held["trades"] or held["updates"]
            self.day.clear()
            yield from _rows(key, [self._closed(held, flush=True)] if active else [])
            return
        done = []
        while self.prompt and self._end(held) <= min(now * 1_000_000, held["close_ns"] - 1):
            done.append(self._closed(held))
        self._keep(held, now)
        yield from _rows(key, done)

    def _held(self) -> dict | None:
        return dict(zip(_KINDS, self.day.get(), strict=True)) if self.day.exists() else None

    def _keep(self, held: dict, watermark_ms: int) -> None:
        """Writes the state, with a timer for the close or, to be prompt, for the end of the open bin."""
        at = held["close_ns"] + SETTLE_NS
        if self.prompt and self._end(held) < held["close_ns"]:
            at = self._end(held)
        at_ms = max(-(-at // 1_000_000), watermark_ms + 1)
        if at_ms != held["armed"]:
            self.handle.registerTimer(at_ms)
            held["armed"] = at_ms
        self.day.update(tuple(held[n] for n in _KINDS))

    def _end(self, held: dict) -> int:
        return held["open_ns"] + (held["bin"] + 1) * self.bin_ns

    def _closed(self, held: dict, flush: bool = False) -> dict:
        """The open bin as a row; the next one is open then."""
        row = {n: held[n] for n in (*SUMS, *_QUOTE)} | {"bin_idx": held["bin"], "bin_end_ns": held["close_ns"] if flush else self._end(held), "is_flush": flush, "is_gap": not flush and held["bin"] > 0 and not held["records"]}
        held |= {"bin": held["bin"] + 1} | dict.fromkeys(SUMS, 0)
        return row

    def _taken(self, held: dict, new: pd.DataFrame) -> list[dict]:
        """Adds records in their order; the bins that they close."""
        col = {c: new[c].to_numpy() for c in new.columns}
        reached = np.maximum.accumulate(np.maximum(held["reached"], np.where(col["ts"] < held["close_ns"], col["ts"], 0)))
        bins = np.maximum(held["bin"], (reached - held["open_ns"]) // self.bin_ns)
        # The last accepted quote as of each record, its own included; -1: the one carried here.
        at = np.maximum.accumulate(np.where(col["ok"], np.arange(len(new)), -1))
        quote = {q: np.where(at >= 0, col["ts" if q == "quote_ts" else q][at], 0 if held[q] is None else held[q]) for q in _QUOTE}
        known = (at >= 0) | (held["quote_ts"] is not None)
        mid, spread = (quote["bid"] + quote["ask"]) / 2.0, quote["ask"] - quote["bid"]
        trf, signed = col["accepted"] & col["trf"], known & col["accepted"] & col["trf"]
        buy, sell = signed & (col["price"] > mid + self.band * spread), signed & (col["price"] < mid - self.band * spread)
        size = col["size"]
        sums = {
            "records": np.ones(len(new), np.int64), "trades": col["accepted"], "trf_trades": trf, "dropped": col["dropped"], "updates": col["quoted"], "trf_buy_vol": size * buy, "trf_sell_vol": size * sell,
            "trf_unsigned_vol": size * (trf & ~buy & ~sell), "trf_vol": size * trf, "lit_vol": size * (col["accepted"] & col["lit"]),
        }
        done = []
        edges = np.flatnonzero(np.append(True, bins[1:] != bins[:-1]))
        for low, high in zip(edges.tolist(), [*edges[1:].tolist(), len(new)], strict=True):
            while held["bin"] < bins[low]:
                done.append(self._closed(held))
            held |= {n: held[n] + int(v[low:high].sum()) for n, v in sums.items()}
            if known[high - 1]:
                held |= {q: (float if k == "double" else int)(quote[q][high - 1]) for q, k in _QUOTE.items()}
        held |= {"reached": int(reached[-1]), "last_seq": int(col["seq"][-1])}
        return done


def _rows(key: tuple, bins: list[dict]) -> Iterator[pd.DataFrame]:
    if bins:
        kinds = {"long": "Int64", "double": "float64", "boolean": "boolean"}
        symbol, day = key
        yield pd.DataFrame({"symbol": [symbol] * len(bins), "trade_date": [day] * len(bins)} | {n: pd.array([b[n] for b in bins], dtype=kinds[k]) for n, k in _OUT.items() if n not in DAY})


def stream_state_bins(events: DataFrame, cfg: Config, lateness: str = "10 seconds", prompt: bool = False) -> DataFrame:
    """Every bin from streaming canonical events: flow by side, quote at its end, gaps. Start it within carried()."""
    found = prepared(events, cfg, lateness).groupBy(*DAY).transformWithStateInPandas(DayState(cfg.bin_ns, cfg.classification.exclusion_band, prompt), outputStructType=_SPARK(_OUT), outputMode="Append", timeMode="EventTime")
    return found.withColumn("mid_price", F.coalesce((F.col("bid") + F.col("ask")) / 2.0, F.lit(0.0)))

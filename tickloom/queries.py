"""Registered queries of the engine: one for each operator, over the driver's tables.

Computed doubles are rounded to six places (and sums of floating products to that too), so that the order of
addition can't show. Ordered quantities are whole numbers wherever they can be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.functions.market import is_trf, normal_cdf
from tickloom.operators import aggregates, bursts, bvc, calendar, context, diagnostics, features, impact, intervals, labels, normalize, quotes, rank_ic, sequences, sketches, trades
from tickloom.operators import bins as grid
from tickloom.plans import day, export, manifest, reports
from tickloom.schema import DAY, FEATURES
from tickloom.sources import feed, files, npy
from tickloom.sources.adapter import driver_events, from_driver_events
from tickloom.sources.stores import scratch, stored
from tickloom.streaming import bins as streaming
from tickloom.streaming import sessions, sink, state

#: Bins of ten minutes suit the driver's sparse days; bins of a minute bring out gaps and early closes.
COARSE = Config().with_(sampling={"bin_size_seconds": 600}, validation={"min_trades_per_bin": 2, "burst_threshold": 3, "burst_window_ns": 300_000_000_000, "auto_detect_close": True}, vpin={"bucket_volume": 1000, "lookback_buckets": 5, "sigma_window_minutes": 60}, sequence={"window_size": 5}, labeling={"horizons": (1, 2, 3, 5)})
FINE = Config().with_(sampling={"bin_size_seconds": 60}, vpin={"sigma_window_minutes": 60}, sequence={"window_size": 5}, labeling={"horizons": (1, 2, 3, 5)})
WITH_VPIN = COARSE.with_(features={"vpin": True})


def r6(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def bbo_state_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = quotes.with_bbo(driver_events(spark, sf_dir))
    return seen.select("trade_date", "seq", "quote_check", "bbo_valid", r6("bid").alias("bid"), r6("ask").alias("ask"), "bid_size", "ask_size", r6("mid").alias("mid"), r6("bbo_spread_bps").alias("spread_bps"), r6("microprice").alias("microprice"), "bbo_ts")


def bbo_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.quote_counters(quotes.with_bbo(driver_events(spark, sf_dir))).drop("symbol")


def asof_join_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join of trades with a separate quote table."""
    events = driver_events(spark, sf_dir)
    left = events.where("action = 'T'").select(*DAY, "seq", "ts_recv_ns", "size")
    right = events.where("action = 'A'").select(*DAY, "seq", "ts_recv_ns", "bid_px_nano", "bid_sz", "ask_px_nano", "ask_sz")
    return quotes.as_of_quotes(left, right).select("trade_date", "seq", "size", r6("quote_bid").alias("quote_bid"), r6("quote_ask").alias("quote_ask"), "quote_ts")


def _records(spark: SparkSession, sf_dir: str, cfg: Config = COARSE) -> DataFrame:
    return day.records(driver_events(spark, sf_dir), cfg)


def trade_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).where("is_trade and in_session").select("trade_date", "seq", "venue", "direction", "retail", r6("price").alias("price"))


def classifier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trades.class_counters(_records(spark, sf_dir).where("is_trade and in_session")).drop("symbol"), "retail_rate", "trf_unsigned_rate")


def venue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _records(spark, sf_dir).where("is_trade").groupBy("trade_date", "venue").agg(F.count("*").alias("trades"), F.sum("size").alias("volume"))
    return found


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).groupBy("trade_date").agg(F.count_if("in_session").alias("inside"), F.count_if(F.col("ts_recv_ns") < F.col("open_ns")).alias("before"), F.count_if(F.col("ts_recv_ns") >= F.col("close_ns")).alias("after"), F.count_if("accepted").alias("accepted"), F.count_if("dropped").alias("dropped"))


def tumbling_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).groupBy("trade_date", "bin_idx").agg(F.count("*").alias("records"), F.count_if("in_session").alias("inside"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))


def _bins(spark: SparkSession, sf_dir: str, cfg: Config = COARSE) -> DataFrame:
    return features.live_features(day.processed_bins(driver_events(spark, sf_dir), cfg), cfg).where("emit")


def _features(names: tuple[str, ...], cfg: Config = COARSE):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _bins(spark, sf_dir, cfg).select("trade_date", "bin_idx", *[r6(n).alias(n) for n in names])

    return query


def bin_signed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: signed off-exchange flow by bin, straight from the aggregation."""
    sums = aggregates.bin_aggregates(aggregates.with_previous(_records(spark, sf_dir), COARSE), COARSE)
    return sums.select("trade_date", "bin_idx", *[F.col(c).cast("long").alias(c) for c in ("trf_buy_vol", "trf_sell_vol", "trf_unsigned_vol", "retail_vol", "retail_buy_vol", "retail_sell_vol", "lit_vol")], r6((F.col("trf_buy_vol") - F.col("trf_sell_vol")) / F.greatest(F.col("trf_buy_vol") + F.col("trf_sell_vol"), F.lit(1e-8))).alias("trf_signed_imbalance"))


def _accepted(spark: SparkSession, sf_dir: str, cfg: Config = COARSE) -> DataFrame:
    return day.accepted_trades(driver_events(spark, sf_dir), cfg)


def bvc_per_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bvc.with_bvc(_accepted(spark, sf_dir), COARSE.vpin.sigma_window_minutes)
    return found.select("trade_date", "seq", "window_n", r6("delta").alias("delta"), r6("sigma").alias("sigma"), r6("bvc_buy").alias("bvc_buy"), r6("bvc_sell").alias("bvc_sell"))


def bvc_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade-by-trade form; on these data, whose times are in order, it has to agree with the declarative one."""
    found = bvc.replayed_bvc(_accepted(spark, sf_dir), COARSE.vpin.sigma_window_minutes)
    return found.select("trade_date", "seq", "window_n", r6("delta").alias("delta"), r6("sigma").alias("sigma"), r6("bvc_buy").alias("bvc_buy"), r6("bvc_sell").alias("bvc_sell"))


def bin_bvc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bvc.by_bin(bvc.with_bvc(_accepted(spark, sf_dir), COARSE.vpin.sigma_window_minutes))
    return found.select("trade_date", "bin_idx", r6("bvc_buy").alias("bvc_buy"), r6("bvc_sell").alias("bvc_sell"))


def bin_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = COARSE.validation
    return bursts.bursts(_accepted(spark, sf_dir).where(is_trf(F.col("publisher_id"))), v.burst_threshold, v.burst_window_ns).drop("symbol")


def vpin_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = day.bucketed(_accepted(spark, sf_dir, WITH_VPIN), WITH_VPIN, None, "Trf")
    return found.select("trade_date", "bucket", "bin_idx", *[r6(c).alias(c) for c in ("buy", "sell", "imbalance", "vpin")])


def vpin_daily_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets that follow each day's consolidated volume."""
    cfg = WITH_VPIN.with_(vpin={"bucket_volume_fraction": 0.05})
    found = day.bucketed(_accepted(spark, sf_dir, cfg), cfg, _context(spark, sf_dir), "Trf")
    return found.groupBy("trade_date").agg(F.count("*").alias("buckets"), r6(F.avg("imbalance")).alias("mean_imbalance"))


def gap_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = day.processed_bins(driver_events(spark, sf_dir), FINE)
    return found.select("trade_date", "bin_idx", "bin_end_ns", "is_gap", "is_flush", "emit", F.coalesce("trades", F.lit(0)).alias("trades"), F.coalesce("updates", F.lit(0)).alias("updates"), r6("mid_price").alias("mid_price"))


def volume_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grid.with_volume_bins(_accepted(spark, sf_dir), 5000)
    return found.groupBy("trade_date", "volume_bin").agg(F.count("*").alias("trades"), F.sum("size").alias("volume"), F.min("seq").alias("first_seq"))


def finite_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature matrix with its bounds asserted, counted by day."""
    found = features.asserted(day.feature_bins(driver_events(spark, sf_dir), COARSE))
    return found.groupBy("trade_date").agg(F.count("*").alias("bins"), F.max("bin_idx").alias("last_bin"))


def early_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = day.processed_bins(driver_events(spark, sf_dir), FINE)
    return found.groupBy("trade_date").agg(F.first("cut").alias("cut"), F.max("max_bin").alias("max_bin"), F.count("*").alias("processed"), F.count_if("is_gap").alias("gaps"))


_FILLED = ("dark_share", "subpenny_intensity", "odd_lot_ratio", "retail_volume_fraction", "mean_trade_size", "block_trade_ratio", "size_concentration", "spread_bps", "quote_imbalance")


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = day.all_bins(driver_events(spark, sf_dir), FINE).where("emit")
    return found.select("trade_date", "bin_idx", *[r6(c).alias(c) for c in _FILLED])


def _matrix(cfg: Config):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(day.feature_bins(driver_events(spark, sf_dir), cfg).drop("symbol"), "mid_price", *FEATURES)

    return query


def labels_point_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.with_labels(_bins(spark, sf_dir), COARSE.labeling.horizons)
    return found.select("trade_date", "bin_idx", *[r6(f"label_{h}").alias(f"label_{h}") for h in COARSE.labeling.horizons], "label_valid")


def forward_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = labels.with_forward_prices(_bins(spark, sf_dir), 5)
    return found.select("trade_date", "bin_idx", *[r6(F.get("forward_prices", F.lit(k))).alias(f"price_{k}") for k in range(6)])


def sequences_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences with a checksum of what they hold instead of the arrays."""
    found = labels.with_labels(_bins(spark, sf_dir), COARSE.labeling.horizons)
    rows = sequences.sequences(found, COARSE.sequence.window_size, COARSE.sequence.stride, ("trf_volume", "trade_count"))
    return rows.select("trade_date", "bin_idx", F.col("position").cast("long").alias("position"), F.col("first_position").cast("long").alias("first_position"), F.aggregate("sequence", F.lit(0.0), lambda s, v: s + v[0] + v[1] * 1000).alias("checksum"))


def normalization_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalize.feature_stats(stored(day.feature_bins(driver_events(spark, sf_dir), COARSE), "bins"))
    digits = lambda c: F.when(F.abs(c) >= 1e6, F.round(c, -3)).otherwise(r6(c)).alias(c)  # noqa: E731  ratios without a divisor are very large, and their sums depend on the order in the last digits
    return found.select("trade_date", "feature", *map(digits, ("mean", "std", "min", "max")), "n_finite", "n_nan")


def zscore_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = normalize.normalized(stored(day.feature_bins(driver_events(spark, sf_dir), COARSE), "bins"))
    return found.select("trade_date", "bin_idx", *[r6(f).alias(f) for f in FEATURES])


_HOLIDAYS = ("2024-01-01", "2024-01-15")


def calendar_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from the events' first day to their last, with their number."""
    days = driver_events(spark, sf_dir).groupBy("trade_date").agg(F.count("*").alias("n"))
    ends = days.agg(F.min("trade_date").cast("string"), F.max("trade_date").cast("string")).first()
    found = calendar.weekdays(spark, *(ends if ends[0] else ("2024-01-01", "2024-01-01")), _HOLIDAYS).join(days, "trade_date", "left")
    return found.select("trade_date", calendar.file_date(F.col("trade_date")).alias("file_date"), (calendar.from_file_date(calendar.file_date(F.col("trade_date"))) == F.col("trade_date")).alias("same"), F.coalesce("n", F.lit(0)).alias("n"))


def split_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    volumes = driver_events(spark, sf_dir).groupBy("trade_date").agg(F.count("*").alias("n"))
    days = calendar.with_split(calendar.available(calendar.weekdays(spark, "2024-01-01", "2024-01-31", _HOLIDAYS), volumes), "2024-01-20", "2024-01-25")
    return days.groupBy("split").agg(F.count("*").alias("n_days"), F.sum("n").alias("n_records"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    have = driver_events(spark, sf_dir).select("trade_date").distinct()
    return calendar.missing(calendar.weekdays(spark, "2024-01-01", "2024-02-15", _HOLIDAYS), have)


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily context made from the events themselves: all volume, and the day's prices."""
    e = driver_events(spark, sf_dir).where("price_nano > 0")
    sums = e.groupBy(*DAY).agg(F.max("seq").alias("seq"), F.max("ts_event_ns").alias("ts_event_ns"), F.sum("size").alias("volume"), F.min_by("price_nano", "seq").alias("open_nano"), F.max("price_nano").alias("high_nano"), F.min("price_nano").alias("low_nano"), F.max_by("price_nano", "seq").alias("close_nano"))
    return context.daily_context(sums)


def daily_context_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = driver_events(spark, sf_dir).groupBy(*DAY).agg(F.count("*").alias("n_records"))
    return rounded(context.with_context(days, _context(spark, sf_dir)).drop("symbol"), "open", "high", "low", "close")


def empty_context_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = driver_events(spark, sf_dir).groupBy(*DAY).agg(F.count("*").alias("n_records"))
    return context.with_context(days, context.empty_context(spark)).drop("symbol")


def day_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = diagnostics.day_summary(day.processed_bins(driver_events(spark, sf_dir), FINE), FINE.bin_ns)
    return found.drop("symbol")


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.coverage_report(driver_events(spark, sf_dir), _context(spark, sf_dir), COARSE).drop("symbol"), "coverage", "dark_share")


def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = context.coverage_summary(reports.coverage_report(driver_events(spark, sf_dir), _context(spark, sf_dir), COARSE))
    return rounded(found, "mean_coverage", "min_coverage", "max_coverage", "mean_dark_share")


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.profile_report(driver_events(spark, sf_dir), COARSE).drop("symbol")


def fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports of the same days: coarse flow beside the same bins' quotes."""
    both = _bins(spark, sf_dir)
    left, right = both.select(*DAY, "bin_idx", "trf_volume"), both.select(*DAY, "bin_idx", "trf_volume", "bbo_update_rate")
    return context.fused(left, right).drop("symbol")


def normal_cdf_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normal distribution function over the events' values, centred."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    z = (F.col("value") - 10.0) / 5.0
    return events.select("event_id", r6(normal_cdf(z)).alias("phi"))


def file_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's events in a folder of its own, found again by name, with what is in them."""
    root = scratch(spark, "days")
    driver_events(spark, sf_dir).select(calendar.file_date(F.col("trade_date")).alias("day"), "seq").write.partitionBy("day").parquet(root)
    found = files.discover(spark, root, "day={date}").select("trade_date", F.element_at(F.split("path", "/"), -1).alias("name"))
    inside = spark.read.parquet(root).groupBy(calendar.from_file_date(F.col("day").cast("string")).alias("trade_date")).agg(F.count("*").alias("n"))
    return found.join(inside, "trade_date")


def _exported(spark: SparkSession, sf_dir: str) -> str:
    root = scratch(spark, "export")
    manifest.guard(root)
    export.export_dataset(driver_events(spark, sf_dir), COARSE.with_(export={"output_dir": root}), root)
    return root


def npy_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full export with its manifest, and what the manifest says."""
    found = manifest.read(_exported(spark, sf_dir))
    rows = [(s, v["n_days"], v["n_sequences"], v["first_date"], v["last_date"]) for s, v in sorted(found["splits"].items())]
    return spark.createDataFrame(rows, "split string, n_days long, n_sequences long, first_date string, last_date string")


def npy_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of a full export, read again: every step's features."""
    return rounded(npy.read_sequences(spark, _exported(spark, sf_dir)).drop("symbol"), *FEATURES)


def npy_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and forward prices of a full export, read again."""
    h = COARSE.labeling.horizons
    found = npy.read_targets(spark, _exported(spark, sf_dir), h)
    return rounded(found.drop("symbol"), *[f"label_{x}" for x in h], *[f"price_{k}" for k in range(max(h) + 1)])


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming bins, run over all that is there, open bins included."""
    root = scratch(spark, "stream")
    streaming.snapshot(streaming.stream_bins(streaming.stream_driver_events(spark, sf_dir), COARSE), f"{root}/bins", f"{root}/checkpoint")
    return rounded(spark.read.parquet(f"{root}/bins").drop("symbol"), "dark_share")


def interval_join_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of join of trades with quotes by way of the quotes' intervals."""
    events = driver_events(spark, sf_dir)
    left = events.where("action = 'T'").select(*DAY, "seq", "ts_recv_ns", "size")
    right = events.where("action = 'A'").select(*DAY, "seq", "ts_recv_ns", "bid_px_nano", "bid_sz", "ask_px_nano", "ask_sz")
    return intervals.quotes_in_force(left, right).select("trade_date", "seq", "size", r6("quote_bid").alias("quote_bid"), r6("quote_ask").alias("quote_ask"), "quote_ts")


def global_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features against all bins of the training days."""
    bins = stored(day.feature_bins(driver_events(spark, sf_dir), COARSE), "bins")
    found = normalize.globally_normalized(bins, F.col("trade_date") <= F.lit("2024-01-20").cast("date"))
    return found.select("trade_date", "bin_idx", *[r6(f).alias(f) for f in FEATURES])


def kyle_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price impact of signed off-exchange volume over the last 20 trades, in millionths of a dollar a share."""
    signed = F.when(F.col("direction") == "Buy", F.col("size")).when(F.col("direction") == "Sell", -F.col("size")).otherwise(0)
    found = impact.with_kyle_lambda(_records(spark, sf_dir).where("accepted and trf"), signed, 20)
    return found.select("trade_date", "seq", "bin_idx", r6(F.col("kyle_lambda") * 1e6).alias("kyle_lambda"))


def tick_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impact.with_tick_test(_accepted(spark, sf_dir)).select("trade_date", "seq", F.col("tick_sign").cast("long").alias("tick_sign"))


_SIGNALS = ["trf_signed_imbalance", "mroib", "dark_share", "trf_volume"]


def _ics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_ic.rank_ic(stored(labels.with_labels(_bins(spark, sf_dir), (1,)), "labelled"), _SIGNALS, "label_1")


def rank_ic_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_ics(spark, sf_dir), "ic")


def rank_ic_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean rank IC with its interval over 200 resamplings of the days."""
    return rounded(rank_ic.bootstrap(_ics(spark, sf_dir)), "mean_ic", "low", "high")


def sketch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks from stored sketches of days, held against exact aggregates: whether distinct counts and ranks are within four standard errors."""
    trades = driver_events(spark, sf_dir).where("action = 'T' and price_nano > 0")
    week = F.date_trunc("week", F.col("trade_date")).cast("date").alias("week")
    rough = sketches.estimates(sketches.merged(stored(sketches.daily_sketches(trades), "sketches"), week))
    exact = trades.groupBy(week).agg(F.count("*").alias("trades"), F.countDistinct("price_nano").alias("prices"))
    ranks = trades.select(week, "size").join(F.broadcast(rough.select("week", "size_10", "size_50", "size_90")), "week")  # a row a week
    sides = [c for r in (10, 50, 90) for c in (F.count_if(F.col("size") < F.col(f"size_{r}")).alias(f"below_{r}"), F.count_if(F.col("size") <= F.col(f"size_{r}")).alias(f"upto_{r}"))]
    placed = ranks.groupBy("week").agg(*sides)
    off = [((F.col(f"below_{r}") <= (r / 100 + 0.03) * F.col("trades")) & (F.col(f"upto_{r}") >= (r / 100 - 0.03) * F.col("trades"))).alias(f"size_{r}_within") for r in (10, 50, 90)]
    near = F.abs(F.col("distinct_prices") - F.col("prices")) <= 0.065 * F.col("prices")
    return exact.join(rough.drop("trades"), "week").join(placed, "week").select("week", "trades", "prices", near.alias("prices_within"), *off)


def feed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events written as a binary feed and read back from it, in parts."""
    path = scratch(spark, "feed")
    feed.write_feed(driver_events(spark, sf_dir), path, 1000)
    found, _ = feed.decoded(feed.read_feed(spark, path, 1 << 16))
    return found.select("trade_date", "seq", "ts_recv_ns", "action", "price_nano", "size", "bid_px_nano", "bid_sz", "ask_px_nano", "ask_sz", "publisher_id")


def _streamed(spark: SparkSession, sf_dir: str, name: str, stream, mode: str = "append", slices: int = 3) -> str:
    """The driver's events arrive in slices; each time the query is started anew from its checkpoint and its results are committed. Gives the results' path."""
    root = scratch(spark, name)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = -(-(high - low + 1) // slices) if high is not None else 1
    for k in range(slices):
        mine = events if high is None else events.where(F.col("event_id").between(low + k * step, low + (k + 1) * step - 1))
        mine.write.parquet(f"{root}/in/{k:03}")
        arrived = from_driver_events(spark.readStream.schema(events.schema).parquet(f"{root}/in/*"))
        sink.run_available(stream(arrived), f"{root}/out", f"{root}/checkpoint", mode)
    return f"{root}/out"


def stream_state_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of a minute from carried quote state, gaps included. The last day is still open when the events end, so its last bin isn't there."""
    with state.carried(spark):
        out = _streamed(spark, sf_dir, "state", lambda e: state.stream_state_bins(e, FINE))
    found = sink.committed(spark, out)
    return found.select("trade_date", "bin_idx", "bin_end_ns", "is_gap", "is_flush", "trades", "updates", "dropped", "trf_buy_vol", "trf_sell_vol", "trf_unsigned_vol", "lit_vol", r6("bid").alias("bid"), r6("ask").alias("ask"), "bid_size", "ask_size", r6("mid_price").alias("mid_price"), "quote_ts")


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half hours of flow, every ten minutes, from a stream that is stopped and started twice; open ones too."""
    out = _streamed(spark, sf_dir, "sliding", lambda e: streaming.sliding_flow(e, COARSE, 3), "complete")
    return rounded(sink.committed(spark, out, latest=True).drop("symbol"), "dark_share")


def session_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.activity_sessions(driver_events(spark, sf_dir)).drop("symbol")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions from a stream that is stopped and started twice; open ones too."""
    out = _streamed(spark, sf_dir, "sessions", lambda e: sessions.activity_sessions(e, lateness="10 seconds"), "complete")
    return sink.committed(spark, out, latest=True).drop("symbol")


def queries() -> dict:
    flow, venues, retail, quotes_, size = FEATURES[0:3], FEATURES[4:8], FEATURES[8:12], FEATURES[12:18], FEATURES[20:24]
    return {
        "bin_signed_flow": bin_signed_flow,
        "bbo_state_asof": bbo_state_asof,
        "bbo_diagnostics": bbo_diagnostics,
        "asof_join_tables": asof_join_tables,
        "trade_classification": trade_classification,
        "classifier_summary": classifier_summary,
        "venue_mix": venue_mix,
        "session_filter": session_filter,
        "tumbling_bins": tumbling_bins,
        "bin_flow_features": _features(flow),
        "bin_venue_metrics": _features(venues),
        "bin_retail_metrics": _features(retail),
        "bin_bbo_dynamics": _features(quotes_),
        "bin_trade_size": _features(size),
        "bin_burst": _features(("trf_burst_intensity", "time_since_burst")),
        "bin_trf_lit_ratio": _features(("trf_lit_volume_ratio",)),
        "bin_activity_gates": _features(FEATURES[27:31]),
        "bin_context": _features(FEATURES[31:34]),
        "bvc_per_trade": bvc_per_trade,
        "bvc_replayed": bvc_replayed,
        "bin_bvc": bin_bvc,
        "bin_bursts": bin_bursts,
        "vpin_buckets": vpin_buckets,
        "vpin_daily_buckets": vpin_daily_buckets,
        "bin_vpin": _features(("trf_vpin", "lit_vpin"), WITH_VPIN),
        "gap_bins": gap_bins,
        "volume_bins": volume_bins,
        "finite_features": finite_features,
        "early_close": early_close,
        "forward_fill": forward_fill,
        "feature_matrix": _matrix(COARSE),
        "feature_matrix_fine": _matrix(FINE),
        "labels_point_return": labels_point_return,
        "forward_prices": forward_prices,
        "sequences_index": sequences_index,
        "normalization_stats": normalization_stats,
        "zscore_features": zscore_features,
        "calendar_weekdays": calendar_weekdays,
        "split_assignment": split_assignment,
        "missing_days": missing_days,
        "daily_context_join": daily_context_join,
        "empty_context_join": empty_context_join,
        "day_summaries": day_summaries,
        "coverage_report": coverage_report,
        "coverage_summary": coverage_summary,
        "profile_report": profile_report,
        "fusion": fusion,
        "normal_cdf_grid": normal_cdf_grid,
        "file_discovery": file_discovery,
        "npy_export": npy_export,
        "npy_sequences": npy_sequences,
        "npy_targets": npy_targets,
        "stream_tumbling": stream_tumbling,
        "interval_join_quotes": interval_join_quotes,
        "global_zscore": global_zscore,
        "kyle_lambda": kyle_lambda,
        "tick_test": tick_test,
        "rank_ic_daily": rank_ic_daily,
        "rank_ic_bootstrap": rank_ic_bootstrap,
        "sketch_rollup": sketch_rollup,
        "feed_round_trip": feed_round_trip,
        "stream_state_bins": stream_state_bins,
        "stream_sliding": stream_sliding,
        "session_windows": session_windows,
        "stream_sessions": stream_sessions,
    }

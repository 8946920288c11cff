"""Golden values of single operators."""

import datetime
import hashlib
import json
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.config import Config, ConfigError
from tickloom.functions import market
from tickloom.operators import bvc, calendar, context, labels, normalize, quotes, sequences, vpin
from tickloom.plans import dataset, export, manifest
from tickloom.schema import EVENTS, FEATURES, UNDEFINED_PRICE
from tickloom.sources import files, npy, stores

DAY = datetime.date(2024, 1, 16)
S = 1_000_000_000


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_signing(spark):
    nano = [134_570, 134_568, 134_566, 134_565, 134_564, 134_562, 134_560, 134_567.5, 134_562.5, 134_565]
    bid, ask = 134.56, 134.57
    rows = [(int(n * 1_000_000),) for n in nano]
    got = values(spark, rows, "p long", market.sign(market.usd(F.col("p")), F.lit((bid + ask) / 2), F.lit(ask - bid), F.lit(True), 0.10))
    assert [g[0] for g in got] == ["Buy", "Buy", "Unsigned", "Unsigned", "Unsigned", "Sell", "Sell", "Buy", "Sell", "Unsigned"]
    assert values(spark, [(1.0,)], "p double", market.sign(F.col("p"), F.lit(0.5), F.lit(0.1), F.lit(False), 0.1)) == [("Unsigned",)]


def test_retail(spark):
    nano = [100_003.5, 100_007.5, 100_000, 100_010, 100_005, 100_001.5, 100_008.5, 100_005, 100_009.9, 100_002]
    got = values(spark, [(int(n * 1_000_000),) for n in nano], "p long", market.retail_status(market.usd(F.col("p")), Config().classification))
    assert "".join(g[0][0] for g in got) == "RRIIIRRIRR"


def test_normal_cdf(spark):
    zs = [-3.0, -1.0, -0.5, 0.0, 0.5, 1.0, math.sqrt(2), 2.0, 6.0]
    for z, (p,) in zip(zs, values(spark, [(z,) for z in zs], "z double", market.normal_cdf(F.col("z")))):
        assert abs(p - 0.5 * (1 + math.erf(z / math.sqrt(2)))) < 1.5e-7


def test_quote_functions(spark):
    rows = [(UNDEFINED_PRICE, 5), (5, UNDEFINED_PRICE), (0, 5), (-1, 5), (None, 5), (5_000_000_000, 5_000_000_000), (6_000_000_000, 5_000_000_000), (5_000_000_000, 6_000_000_000)]
    got = values(spark, rows, "b long, a long", market.quote_check(F.col("b"), F.col("a")))
    assert [g[0] for g in got] == ["invalid"] * 5 + ["crossed"] * 2 + ["ok"]
    got = values(spark, [(10.0, 30, 11.0, 10), (10.0, 0, 11.0, 0)], "b double, bs long, a double, as_ long", market.midpoint(F.col("b"), F.col("a")), market.spread_bps(F.col("b"), F.col("a")), market.microprice(F.col("b"), F.col("bs"), F.col("a"), F.col("as_")))
    assert got[0] == pytest.approx((10.5, 1 / 10.5 * 1e4, (10.0 * 10 + 11.0 * 30) / 40)) and got[1][2] == 10.5
    assert values(spark, [(float("nan"), 1.0), (1.0, 2.0), (2.0, 2.0), (0.0, 1.0)], "b double, a double", market.is_valid_bbo(F.col("b"), F.col("a"))) == [(False,), (True,), (False,), (False,)]


def test_market_clock(spark):
    days = [("2025-03-08", -5), ("2025-03-09", -4), ("2025-11-01", -4), ("2025-11-02", -5)]
    got = values(spark, [(d,) for d, _ in days], "d string", market.offset_hours(F.col("d").cast("date")))
    assert [g[0] for g in got] == [h for _, h in days]
    clocks = {"09:31": 0, "10:00": 1, "12:00": 2, "15:30": 3, "15:57": 4, "16:00": 5, "09:00": 5}
    for clock, want in clocks.items():
        at = market.market_time_ns(F.col("d").cast("date"), clock)
        assert values(spark, [("2024-07-05",)], "d string", market.time_bucket(at, F.col("d").cast("date"))) == [(float(want),)]


def trades(spark, rows):
    return spark.createDataFrame([("S", DAY, i, t, p, n, 82, 0) for i, (t, p, n) in enumerate(rows)], "symbol string, trade_date date, seq long, ts_recv_ns long, price_nano long, size long, publisher_id int, bin_idx long")


def test_bvc_golden(spark):
    rows = [(k * S, p * 1_000_000, n) for k, (p, n) in enumerate([(100_000, 1000), (100_010, 500), (100_030, 800), (100_010, 600), (100_010, 400)])]
    for form in (bvc.with_bvc, bvc.replayed_bvc):
        got = sorted(form(trades(spark, rows)).collect(), key=lambda r: r.seq)
        share = [r.bvc_buy / r.size for r in got]
        assert share[0] == pytest.approx(0.5, abs=1e-8) and share[1] == pytest.approx(0.5 * (1 + math.erf(1)), abs=2e-7) and share[2] == pytest.approx(0.5 * (1 + math.erf(math.sqrt(2))), abs=2e-7)
        assert share[3] < 0.5 and share[4] == pytest.approx(0.5, abs=1e-8)
        assert got[-1].window_n == 5 and all(r.bvc_buy + r.bvc_sell == pytest.approx(r.size) for r in got)


def test_bvc_eviction(spark):
    p = 100_000_000_000
    for times, want in (([0, S, 2 * S, 62 * S + 1], [1, 2, 3, 1]), ([0, S, 60 * S, 60 * S + 1], [1, 2, 3, 3])):
        for form in (bvc.with_bvc, bvc.replayed_bvc):
            got = sorted(form(trades(spark, [(t, p + k * 10**7, 10) for k, t in enumerate(times)])).collect(), key=lambda r: r.seq)
            assert [r.window_n for r in got] == want
            assert got[0].sigma == 0


def test_bvc_takes_very_large_moves(spark):
    rows = [(k * S, p * S, 10) for k, p in enumerate([100, 700_000, 100, 5_000_000_000, 100, 100])]
    a, b = (sorted(f(trades(spark, rows)).collect(), key=lambda r: r.seq) for f in (bvc.with_bvc, bvc.replayed_bvc))
    assert [x.bvc_buy for x in a] == pytest.approx([y.bvc_buy for y in b], abs=1e-6)


def test_bvc_forms_agree_on_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(int(t), 100_000_000_000 + int(d) * 10**7, int(n)) for t, d, n in zip(np.sort(rng.integers(0, 200, 400)) * S, rng.integers(-4, 5, 400), rng.integers(0, 500, 400))]
    a, b = (sorted(f(trades(spark, rows)).collect(), key=lambda r: r.seq) for f in (bvc.with_bvc, bvc.replayed_bvc))
    assert all((x.window_n, x.bvc_buy, x.sigma) == pytest.approx((y.window_n, y.bvc_buy, y.sigma), abs=1e-9) for x, y in zip(a, b))


def test_vpin(spark):
    assert vpin.vpin_buckets(trades(spark, [(0, 10**11, 100)]), 5000, 50).count() == 0
    got = sorted(vpin.vpin_buckets(trades(spark, [(k * S, 10**11, 700) for k in range(5)]), 1000, 2).collect(), key=lambda r: r.bucket)
    assert [r.bucket for r in got] == [0, 1, 2] and all(r.buy + r.sell == pytest.approx(1000) and r.vpin == pytest.approx(0, abs=1e-8) for r in got)


def bins(spark, mids):
    return spark.createDataFrame([("S", DAY, i, float(m)) for i, m in enumerate(mids)], "symbol string, trade_date date, bin_idx long, mid_price double")


def test_labels(spark):
    got = sorted(labels.with_labels(bins(spark, [130 + 0.01 * i for i in range(50)]), (1, 5, 10)).collect(), key=lambda r: r.bin_idx)
    assert got[0].label_1 == pytest.approx(0.01 / 130 * 1e4) and sum(r.label_valid for r in got) == 40
    got = sorted(labels.with_labels(bins(spark, [100, 101, 102]), (1,)).collect(), key=lambda r: r.bin_idx)
    assert [r.label_1 for r in got] == [pytest.approx(100), pytest.approx(99.00990099), None]
    got = sorted(labels.with_forward_prices(bins(spark, [0, 5, 6]), 2).collect(), key=lambda r: r.bin_idx)
    assert [r.forward_prices for r in got] == [[None, 5, 6], [5, 6, None], [6, None, None]]
    assert sorted(labels.with_labels(bins(spark, [0, 5]), (1,)).collect(), key=lambda r: r.bin_idx)[0].label_1 is None


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_sequences(spark, stride):
    ready = labels.with_labels(bins(spark, range(100, 120)), (1, 3))
    got = sorted(sequences.sequences(ready, 4, stride, ("mid_price",)).collect(), key=lambda r: r.bin_idx)
    assert [r.bin_idx for r in got] == [e for e in range(3, 17) if (e - 3) % stride == 0]
    assert all([v[0] for v in r.sequence] == [100.0 + r.bin_idx - 3 + k for k in range(4)] for r in got)


def test_statistics(spark):
    df = bins(spark, [1, 2, 3, 4])
    (r,) = normalize.feature_stats(df, ("mid_price",)).collect()
    assert (r.mean, r.std, r.min, r.max, r.n_finite, r.n_nan) == (2.5, pytest.approx(math.sqrt(1.25)), 1, 4, 4, 0)
    got = [r.mid_price for r in normalize.normalized(df, features=("mid_price",)).collect()]
    assert sorted(got) == pytest.approx([(x - 2.5) / math.sqrt(1.25) for x in (1, 2, 3, 4)])
    (r,) = normalize.feature_stats(bins(spark, [float("nan"), 5]), ("mid_price",)).collect()
    assert (r.n_finite, r.n_nan, r.std) == (1, 1, 0)
    assert [r.mid_price for r in normalize.normalized(bins(spark, [5, 5]), features=("mid_price",)).collect()] == [0, 0]


def test_calendar(spark):
    days = [r.trade_date.isoformat() for r in calendar.weekdays(spark, "2024-01-05", "2024-01-10", ["2024-01-09"]).orderBy("trade_date").collect()]
    assert days == ["2024-01-05", "2024-01-08", "2024-01-10"]
    got = values(spark, [("20240105",), ("2024010",), ("20241345",)], "t string", calendar.from_file_date(F.col("t")))
    assert got == [(datetime.date(2024, 1, 5),), (None,), (None,)]


def test_context(spark):
    ns = 19_738 * 86_400 * S
    rows = [("S", 1, ns, 10, 1, 1, 1, 1), ("S", 2, ns + 5, 30, 10**9, 2, 3, 4)]
    df = spark.createDataFrame(rows, "symbol string, seq long, ts_event_ns long, volume long, open_nano long, high_nano long, low_nano long, close_nano long")
    (r,) = context.daily_context(df).collect()
    assert (r.consolidated_volume, r.open) == (30, 1.0) and r.trade_date == datetime.date(2024, 1, 16)
    days = spark.createDataFrame([("S", DAY), ("T", DAY)], "symbol string, trade_date date")
    got = {r.symbol: r.consolidated_volume for r in context.with_context(days, context.daily_context(df)).collect()}
    assert got == {"S": 30, "T": None}


def test_config(tmp_path):
    good = tmp_path / "c.toml"
    good.write_text('[sampling]\nbin_size_seconds = 30\n[labeling]\nhorizons = [1, 4]\n[classification]\nextra = 1\n')
    cfg = Config.from_toml(good)
    assert cfg.sampling.bin_size_seconds == 30 and cfg.labeling.horizons == (1, 4) and len(cfg.hash()) == 64
    assert cfg.hash() == cfg.with_(export={"output_dir": "elsewhere"}).hash() != Config().hash()
    bad = [{"sampling": {"bin_size_seconds": 7}}, {"nope": {}}, {"sampling": {"nope": 1}}, {"labeling": {"horizons": [3, 2]}}, {"labeling": {"horizons": [201]}}, {"sequence": {"stride": 30}}, {"classification": {"exclusion_band": 0.6}}, {"classification": {"signing_method": "tick_test"}}, {"vpin": {"bucket_volume_fraction": float("nan")}}, {"input": {"filename_pattern": "x"}}, {"dates": {"start_date": "2024-02-30"}}, {"export": {"normalization": "global"}}, {"sampling": {"market_open_et": "9.30"}}]
    for values_ in bad:
        with pytest.raises(ConfigError):
            Config.from_dict(values_)


def test_decode_report(spark):
    rows = [("S", DAY, i, None if 3 <= i < 5 or i >= 8 else "ok") for i in range(12)]
    df = spark.createDataFrame(rows, "symbol string, trade_date date, seq long, x string").withColumn("_corrupt_record", F.when(F.col("x").isNull(), "bad"))
    good, report = files.decode_report(df, most=3)
    assert [tuple(r) for r in report.select("decode_errors", "decode_truncated").collect()] == [(5, True)]
    assert sorted(r.seq for r in good.collect()) == [0, 1, 2, 5, 6, 7]


def test_discovery_and_hash(spark, tmp_path):
    import hashlib

    for n in ("a-20240103.bin", "a-20240102.bin", "a-2024.bin", "b-20240101.bin"):
        (tmp_path / n).write_bytes(n.encode())
    got = files.discover(spark, f"file://{tmp_path}", "a-{date}.bin").collect()
    assert [r.trade_date.isoformat() for r in got] == ["2024-01-02", "2024-01-03"]
    (r,) = files.file_hashes(spark, got[0].path).collect()
    assert r.sha256 == hashlib.sha256(b"a-20240102.bin").hexdigest()
    with pytest.raises(FileNotFoundError):
        files.discover(spark, f"file://{tmp_path}/none", "a-{date}.bin")


def test_as_of_quotes(spark):
    q = spark.createDataFrame([("S", DAY, 1, 10, 10**9, 1, 2 * 10**9, 1), ("S", DAY, 2, 20, 3 * 10**9, 1, 2 * 10**9, 1)], "symbol string, trade_date date, seq long, ts_recv_ns long, bid_px_nano long, bid_sz long, ask_px_nano long, ask_sz long")
    t = spark.createDataFrame([("S", DAY, 5, 9), ("S", DAY, 6, 10), ("S", DAY, 7, 99)], "symbol string, trade_date date, seq long, ts_recv_ns long")
    got = {r.seq: r.quote_bid for r in quotes.as_of_quotes(t, q).collect()}
    assert got == {5: None, 6: 1.0, 7: 1.0}


def day_arrays(n=2):
    return {"sequences.npy": np.ones((n, 3, 34)), "labels.npy": np.ones((n, 2)), "forward_prices.npy": np.full((n, 4), np.nan)}


def test_a_day_is_staged_whole_or_not_at_all(tmp_path):
    docs = {k: {"a": 1} for k in dataset.DOCUMENTS}
    found = dataset.stage(str(tmp_path), "train", "d", day_arrays(), docs)
    folder = tmp_path / dataset.STAGING / "train"
    assert found == {k: hashlib.sha256((folder / f"d_{k}").read_bytes()).hexdigest() for k in dataset.KINDS}
    assert np.load(folder / "d_sequences.npy").dtype == np.float32 and np.load(folder / "d_forward_prices.npy").shape == (2, 4)
    with pytest.raises(ValueError, match="finite"):
        dataset.stage(str(tmp_path), "train", "e", day_arrays() | {"sequences.npy": np.full((2, 3, 34), np.inf)}, docs)
    assert dataset.stage(str(tmp_path), "train", "f", day_arrays(0), docs) == {}
    assert sorted(p.name for p in folder.iterdir()) == sorted(f"d_{k}" for k in dataset.KINDS)
    assert not list((tmp_path / dataset.STAGING / "attempts").iterdir())


def test_manifest(tmp_path):
    rows = [{"symbol": "S", "trade_date": f"2024-01-0{d}", "split": "train", "n_sequences": n, "error": e, "digests": {"labels.npy": "x"} if n else {}} for d, n, e in ((1, 5, None), (2, 0, None), (3, 0, "broken"))]
    m = dataset.manifest_of(rows, Config())
    assert (m["splits"]["train"]["n_days"], m["total_sequences"], m["zero_sequence_days"], m["complete"]) == (2, 5, ["2024-01-02"], False)
    assert m["failed_days"] == [{"day": "2024-01-03", "error": "broken"}] and m["diagnostics_files"] == ["train/S_20240101_diagnostics.json"]
    stores.put(f"{tmp_path}/{manifest.NAME}", json.dumps(m).encode())
    assert manifest.read(str(tmp_path)) == m
    with pytest.raises(FileExistsError):
        manifest.guard(str(tmp_path))
    manifest.guard(str(tmp_path), force=True)


def test_digests_of_large_files_and_folders(tmp_path):
    data = np.random.default_rng(0).bytes(300_000)
    (tmp_path / "a").write_bytes(data)
    assert stores.sha256_of(str(tmp_path / "a"), 1000) == stores.sha256_of(f"file:{tmp_path}/a") == stores.sha256_of(f"file://{tmp_path}/a") == hashlib.sha256(data).hexdigest()
    before = stores.sha256_of(str(tmp_path))
    (tmp_path / "_hidden").write_bytes(b"1")
    assert stores.sha256_of(f"file:{tmp_path}") == before
    (tmp_path / "b").write_bytes(b"1")
    assert stores.sha256_of(str(tmp_path)) != before


def exported(spark, root, **more):
    cfg = Config().with_(sampling={"bin_size_seconds": 600}, sequence={"window_size": 3}, labeling={"horizons": (1, 2)}, validation={"min_trades_per_bin": 1}, export={"split_dates": ("2024-01-16", "2024-01-20"), **more})
    from test_day import stream

    rows = [r | {"symbol": f"S{k}"} for k in range(4) for r in stream(40 + k, False)]
    return cfg, spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)


def test_metadata_has_the_contract_fields():
    cfg = Config().with_(export={"experiment": "e"})
    counts = dict.fromkeys(("n_bins_total", "n_bins_valid", "n_bins_warmup_discarded", "n_bins_label_truncated", "n_total_records", "n_trade_records", "n_trf_trades", "n_lit_trades", "first_bin_start_ns", "last_bin_end_ns"), 7) | {"n_sequences": 308}
    m = json.loads(json.dumps(export.metadata("2025-02-03", counts, cfg, {"consolidated_volume": 10, "trf_volume_fraction": 0.5}, {"source_file": "day-20250203.feed", "data_file_sha256": "a" * 64})))
    assert {"day", "n_sequences", "window_size", "n_features", "schema_version", "contract_version", "label_strategy", "label_encoding", "horizons", "bin_size_seconds", "market_open_et", "normalization", "provenance", "export_timestamp", "data_source", "schema", "symbol", "experiment", "signing_method", "exclusion_band", *counts} <= set(m)
    assert (m["schema_version"], m["n_features"], m["contract_version"].startswith("off_exchange"), m["normalization"]["applied"], m["normalization"]["strategy"]) == ("1.0", 34, True, False, "none")
    assert set(m["provenance"]) == {"source_file", "processor_version", "git_commit", "git_dirty", "export_timestamp_utc", "config_hash", "data_file_sha256"}
    assert len(m["provenance"]["config_hash"]) == 64 and "/" not in m["provenance"]["source_file"]
    fp = m["forward_prices"]
    assert fp["n_columns"] == fp["smoothing_window_offset"] + fp["max_horizon"] + 1 and fp["units"] == "USD" and fp["column_layout"]
    assert "vpin" in m["feature_groups_enabled"] and m["classification_config"]["signing_method"] == "midpoint"


def test_a_failed_export_leaves_nothing(spark, tmp_path):
    cfg, events = exported(spark, tmp_path, continue_on_error=False)
    root = str(tmp_path / "out")
    # One day's task fails; the others have staged theirs by then, or are about to.
    rows = export.day_rows(events, cfg)
    victim = rows.agg(F.max("symbol")).first()[0]
    rows = rows.withColumn("stats", F.when(F.col("symbol") == victim, F.lit("not json")).otherwise(F.col("stats"))).repartition(4, "symbol")
    spark.dataSource.register(dataset.DatasetSink)
    with pytest.raises(Exception, match="JSON|json|Expecting"):
        rows.write.format(dataset.FORMAT).mode("append").option("root", root).option("config", json.dumps(cfg.to_dict())).save()
    assert not stores.exists(f"{root}/{manifest.NAME}") and not [p for p in Path(root).rglob("*") if p.is_file()]


def test_an_export_lists_what_it_wrote(spark, tmp_path):
    cfg, events = exported(spark, tmp_path)
    root = str(tmp_path / "out")
    for _ in range(2):  # once more over what is there
        found = export.export_dataset(events, cfg, root)
        assert found["complete"] and found["total_sequences"] > 0 and not (tmp_path / "out" / dataset.STAGING).exists()
        files = {p.relative_to(root).as_posix(): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(root).glob("*/*")}
        assert files == {f"train/{n}_{k}": d for n, ds in found["digests"].items() for k, d in ds.items()}
    name = next(iter(found["digests"]))
    meta = json.loads((tmp_path / "out/train" / f"{name}_metadata.json").read_text())
    assert isinstance(meta["provenance"]["git_dirty"], bool) and meta["provenance"]["git_commit"] and "data_file_sha256" not in meta["provenance"]
    assert meta["n_sequences"] == len(np.load(tmp_path / "out/train" / f"{name}_labels.npy")) and meta["contract_version"] == found["contract_version"]
    assert sum(1 for _ in npy.read_targets(spark, root, (1, 2)).toLocalIterator()) == found["total_sequences"]


def test_schema():
    assert len(FEATURES) == 34 and len(set(FEATURES)) == 34 and EVENTS.fieldNames()[2] == "seq"


def test_fusion_of_exports_that_differ(spark):
    days = [DAY, datetime.date(2024, 1, 17)]
    left = spark.createDataFrame([("S", d, b, float(b)) for d in days for b in range(20)], "symbol string, trade_date date, bin_idx long, v double")
    lacks = {days[0]: {5, 7}, days[1]: {1, 2, 3}}  # a tenth is tolerated, more leaves the day out
    right = spark.createDataFrame([("S", d, b, -1.0, "x") for d in days for b in range(20) if b not in lacks[d]], "symbol string, trade_date date, bin_idx long, v double, w string")
    got = context.fused(left, right)
    assert got.columns == ["symbol", "trade_date", "bin_idx", "v", "v_r", "w"]
    assert {(r.trade_date, r.bin_idx) for r in got.collect()} == {(DAY, b) for b in range(20) if b not in lacks[DAY]}

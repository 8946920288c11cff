"""Scalar functions on quotes, trades and times, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.config import Classification, Config, seconds_of
from tickloom.schema import EPS, LIT, MINOR_LIT, NANO, QUOTE_ONLY, TRF, UNDEFINED_PRICE


def usd(nano: Column) -> Column:
    return nano.cast("double") * F.lit(NANO)


def is_trade(action: Column) -> Column:
    return F.coalesce(action == "T", F.lit(False))


def is_quote(action: Column) -> Column:
    return F.coalesce(action == "A", F.lit(False))


def venue(publisher: Column) -> Column:
    return F.when(publisher.isin(*LIT), "Lit").when(publisher.isin(*TRF), "Trf").when(publisher.isin(*MINOR_LIT), "MinorLit").when(publisher.isin(*QUOTE_ONLY), "QuoteOnly").otherwise("Unknown")


def is_trf(publisher: Column) -> Column:
    return F.coalesce(publisher.isin(*TRF), F.lit(False))


def is_lit(publisher: Column) -> Column:
    return F.coalesce(publisher.isin(*LIT, *MINOR_LIT), F.lit(False))


def quote_check(bid_nano: Column, ask_nano: Column) -> Column:
    """invalid, crossed (or locked), or ok."""
    bad = lambda p: p.isNull() | (p == UNDEFINED_PRICE) | (p <= 0)
    return F.when(bad(bid_nano) | bad(ask_nano), "invalid").when(usd(ask_nano) <= usd(bid_nano), "crossed").otherwise("ok")


def is_valid_bbo(bid: Column, ask: Column) -> Column:
    finite = lambda x: ~F.isnan(x) & (F.abs(x) < math.inf)
    return F.coalesce(finite(bid) & finite(ask) & (bid > 0) & (ask > bid), F.lit(False))


def midpoint(bid: Column, ask: Column) -> Column:
    mid = (bid + ask) / 2.0
    return F.when(F.isnan(mid) | (F.abs(mid) == math.inf), 0.0).otherwise(mid)


def spread_bps(bid: Column, ask: Column) -> Column:
    mid = midpoint(bid, ask)
    return F.when(mid < EPS, 0.0).otherwise((ask - bid) / F.greatest(mid, F.lit(EPS)) * 10_000.0)


def microprice(bid: Column, bid_size: Column, ask: Column, ask_size: Column) -> Column:
    total = (bid_size + ask_size).cast("double")
    return F.when(total > EPS, (bid * ask_size + ask * bid_size) / F.greatest(total, F.lit(EPS))).otherwise(midpoint(bid, ask))


def staleness_ns(last: Column, now: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), now - last)


def sign(price: Column, mid: Column, spread: Column, valid: Column, band: float) -> Column:
    """Side of a trade against the midpoint, outside a band of the full spread."""
    return F.when(~F.coalesce(valid, F.lit(False)), "Unsigned").when(price > mid + F.lit(band) * spread, "Buy").when(price < mid - F.lit(band) * spread, "Sell").otherwise("Unsigned")


def cent_fraction(price: Column) -> Column:
    return F.pmod(price * 100.0, F.lit(1.0))


def is_subpenny(price: Column) -> Column:
    frac = cent_fraction(price)
    return (frac > 0.001) & (frac < 0.999)


def retail_status(price: Column, c: Classification) -> Column:
    frac = cent_fraction(price)
    sells, buys = (frac > c.lower) & (frac < c.upper_sell), (frac > c.lower_buy) & (frac < c.upper)
    return F.when(sells | buys, "Retail").otherwise("Institutional")


def ratio(num: Column, den: Column, least: float = EPS) -> Column:
    return num / F.greatest(den, F.lit(least))


# Abramowitz and Stegun, formula 7.1.26.
_P, _A = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(z: Column) -> Column:
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_P) * x)
    poly = F.lit(_A[4])
    for a in reversed(_A[:4]):
        poly = poly * t + F.lit(a)
    erf = F.lit(1.0) - poly * t * F.exp(-x * x)
    return F.lit(0.5) * (F.lit(1.0) + F.when(z < 0, -erf).otherwise(erf))


def market_time_ns(trade_date: Column, clock: str) -> Column:
    """UTC nanoseconds of a New York time on a date; the offset is that date's."""
    local = F.timestamp_seconds(F.unix_date(trade_date).cast("long") * 86_400 + seconds_of(clock))
    return F.unix_micros(F.to_utc_timestamp(local, "America/New_York")) * 1000


def offset_hours(trade_date: Column) -> Column:
    """New York's offset from UTC at the market's open."""
    wall = F.unix_date(trade_date).cast("long") * 86_400 + 34_200
    return ((wall - (market_time_ns(trade_date, "09:30") / 1_000_000_000)) / 3600).cast("int")


def session_progress(at_ns: Column, open_ns: Column, cfg: Config) -> Column:
    elapsed = F.greatest(F.lit(0).cast("long"), at_ns - open_ns).cast("double")
    return F.least(F.greatest(elapsed / F.lit(float(cfg.session_ns)), F.lit(0.0)), F.lit(1.0))


def time_bucket(at_ns: Column, trade_date: Column) -> Column:
    """0 to 5 by the New York clock: open auction, morning, midday, afternoon, close auction, outside."""
    s = F.floor((at_ns - market_time_ns(trade_date, "00:00")) / 1_000_000_000)
    return F.when(s < 34_200, 5.0).when(s < 34_500, 0.0).when(s < 37_800, 1.0).when(s < 54_000, 2.0).when(s < 57_300, 3.0).when(s < 57_600, 4.0).otherwise(5.0)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    tight = F.least(F.greatest((value - mean) / F.lit(EPS), F.lit(-100.0)), F.lit(100.0))
    return F.when(std < EPS, tight).otherwise((value - mean) / F.greatest(std, F.lit(EPS)))


def split_of(trade_date: Column, train_end: str, val_end: str) -> Column:
    return F.when(trade_date <= F.lit(train_end).cast("date"), "train").when(trade_date <= F.lit(val_end).cast("date"), "val").otherwise("test")

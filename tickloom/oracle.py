"""SQL for the registered queries, written apart from the plans: what each has to give, over the same tables.

Common table expressions build on each other: raw (events), q (quote checks), s (state as of each record), r (classes and
bins), a (sums by bin), g (the grid), p (processed bins), l (live features), f (filled features).
"""

from __future__ import annotations

import math

MAX = "9223372036854775807"
H13 = 46_800_000_000

RAW = f"""
e0 AS (SELECT event_id AS seq, event_type AS kind, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, epoch_us(ts) AS us, CAST(floor(value * 100) AS BIGINT) AS cents FROM events),
e1 AS (SELECT *, us // 86400000000 AS dayno, 100000000000::BIGINT + ((seq * 7919) % 201 - 100) * 10000000 AS bb FROM e0),
e2 AS (SELECT *, bb + (1 + k % 5) * 10000000 AS ba, DATE '1970-01-01' + CAST(dayno AS INTEGER) AS trade_date,
  (dayno * 86400000000 + {H13} + ((us - dayno * 86400000000) * 5) // 12) * 1000 AS ts FROM e1),
raw AS (SELECT trade_date, seq, ts, CASE WHEN kind = 'view' THEN 'A' ELSE 'T' END AS action,
  CASE WHEN k = 97 THEN 0 ELSE bb + ((ba - bb) * ((seq * 104729) % 1001)) // 1000 END AS px,
  CASE WHEN k = 99 THEN 12000 ELSE 1 + cents % 500 END AS size,
  CASE WHEN k % 41 = 0 THEN {MAX} ELSE bb END AS bid_px, 1 + (seq * 31) % 900 AS bid_sz,
  CASE WHEN k % 37 = 0 THEN bb ELSE ba END AS ask_px, 1 + (seq * 17) % 900 AS ask_sz,
  CASE WHEN k = 98 THEN 999 WHEN kind = 'view' THEN 93 WHEN kind = 'click' THEN 82 WHEN kind = 'signup' THEN 83 WHEN kind = 'purchase' THEN 81 ELSE 88 END AS pub,
  dayno * 86400000000000 + 52200000000000 AS open_ns, dayno * 86400000000000 + 75600000000000 AS close_ns FROM e2)"""

STATE = f"""
q AS (SELECT *, CASE WHEN bid_px = {MAX} OR bid_px <= 0 OR ask_px = {MAX} OR ask_px <= 0 THEN 'invalid'
  WHEN ask_px::DOUBLE * 1e-9::DOUBLE <= bid_px::DOUBLE * 1e-9::DOUBLE THEN 'crossed' ELSE 'ok' END AS quote_check FROM raw),
q2 AS (SELECT *, CASE WHEN quote_check = 'ok' THEN seq END AS ok_seq FROM q),
q3 AS (SELECT *, max(ok_seq) OVER (PARTITION BY trade_date ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS from_seq FROM q2),
s0 AS (SELECT q3.*, b.bid_px::DOUBLE * 1e-9::DOUBLE AS bid, b.ask_px::DOUBLE * 1e-9::DOUBLE AS ask, b.bid_sz AS bsz, b.ask_sz AS asz, b.ts AS bbo_ts FROM q3 LEFT JOIN raw b ON b.seq = q3.from_seq),
s AS (SELECT *, bid IS NOT NULL AS valid, (bid + ask) / 2.0::DOUBLE AS mid, ask - bid AS spread, (ask - bid) / ((bid + ask) / 2.0::DOUBLE) * 10000.0::DOUBLE AS bps,
  (bid * asz + ask * bsz) / (bsz + asz)::DOUBLE AS micro FROM s0)"""


def records(bin_ns: int) -> str:
    return f"""
r0 AS (SELECT *, action = 'T' AS is_trade, px > 0 AS priced, CASE WHEN px > 0 THEN px::DOUBLE * 1e-9::DOUBLE ELSE 0.0::DOUBLE END AS price,
  pub IN (82, 83) AS trf, pub IN (81, 88, 89) AS lit,
  CASE pub WHEN 81 THEN 'Lit' WHEN 82 THEN 'Trf' WHEN 83 THEN 'Trf' WHEN 88 THEN 'MinorLit' WHEN 89 THEN 'MinorLit' WHEN 93 THEN 'QuoteOnly' ELSE 'Unknown' END AS venue,
  ts >= open_ns AND ts < close_ns AS inside FROM s),
r1 AS (SELECT *, price * 100.0::DOUBLE - floor(price * 100.0::DOUBLE) AS frac,
  CASE WHEN NOT priced OR NOT trf OR NOT valid THEN 'Unsigned' WHEN price > mid + 0.1::DOUBLE * spread THEN 'Buy' WHEN price < mid - 0.1::DOUBLE * spread THEN 'Sell' ELSE 'Unsigned' END AS direction FROM r0),
r2 AS (SELECT *, CASE WHEN NOT priced THEN 'Unknown' WHEN NOT trf THEN 'Institutional' WHEN NOT valid THEN 'Unknown'
    WHEN (frac > 0.001::DOUBLE AND frac < 0.4::DOUBLE) OR (frac > 0.6::DOUBLE AND frac < 0.999::DOUBLE) THEN 'Retail' ELSE 'Institutional' END AS retail,
  is_trade AND inside AND priced AS acc, is_trade AND inside AND NOT priced AS dropped, inside AND quote_check = 'ok' AS quoted FROM r1),
r AS (SELECT *, greatest(0, coalesce((max(CASE WHEN ts < close_ns AND ts >= open_ns THEN ts END) OVER (PARTITION BY trade_date ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - open_ns) // {bin_ns}, 0)) AS b FROM r2)"""


def sums(block: int = 10_000) -> str:
    vol = lambda w: f"coalesce(sum(size) FILTER (WHERE {w}), 0)"
    return f"""
u0 AS (SELECT trade_date, b, seq, ts, bps, bsz, asz, lead(ts) OVER w AS next_ts, row_number() OVER w AS n, count(*) OVER (PARTITION BY trade_date, b) AS m FROM r WHERE quoted WINDOW w AS (PARTITION BY trade_date, b ORDER BY seq)),
tg AS (SELECT trade_date, b, (ts - lag(ts) OVER (PARTITION BY trade_date, b ORDER BY seq))::DOUBLE AS gap FROM r WHERE acc AND trf),
tg2 AS (SELECT trade_date, b, count(gap) AS gaps, sum(gap) AS gap_sum, sum(gap * gap) AS gap_sq FROM tg GROUP BY ALL),
st AS (SELECT trade_date, b, max(seq) AS last_seq FROM r WHERE valid GROUP BY ALL),
a0 AS (SELECT trade_date, b, min(open_ns) AS open_ns, min(close_ns) AS close_ns, count(*) AS recs,
  {vol("acc AND trf AND direction = 'Buy'")} AS tb, {vol("acc AND trf AND direction = 'Sell'")} AS tsl, {vol("acc AND trf AND direction = 'Unsigned'")} AS tu,
  {vol('acc AND trf')} AS tv, {vol('acc AND lit')} AS lv, {vol("acc AND trf AND retail = 'Retail'")} AS rv,
  {vol("acc AND trf AND retail = 'Retail' AND direction = 'Buy'")} AS rb, {vol("acc AND trf AND retail = 'Retail' AND direction = 'Sell'")} AS rs,
  count(*) FILTER (WHERE acc) AS trades, count(*) FILTER (WHERE acc AND trf) AS tn, count(*) FILTER (WHERE acc AND lit) AS ln,
  count(*) FILTER (WHERE acc AND trf AND retail = 'Retail') AS rn, count(*) FILTER (WHERE acc AND trf AND frac > 0.001::DOUBLE AND frac < 0.999::DOUBLE) AS sn,
  count(*) FILTER (WHERE acc AND trf AND size < 100) AS odd, count(*) FILTER (WHERE acc AND size >= {block}) AS blk,
  {vol('acc')} AS ss, coalesce(sum(size * size) FILTER (WHERE acc), 0) AS sq, count(*) FILTER (WHERE dropped) AS dropped, count(*) FILTER (WHERE quoted) AS ups FROM r GROUP BY trade_date, b),
a AS (SELECT a0.*, gaps, gap_sum, gap_sq, last_seq FROM a0 LEFT JOIN tg2 USING (trade_date, b) LEFT JOIN st USING (trade_date, b))"""


def grid(bin_ns: int, warmup: int = 3, k: int = 10) -> str:
    return f"""
d0 AS (SELECT trade_date, max(b) AS mb, min(open_ns) AS o, min(close_ns) AS c FROM a GROUP BY trade_date),
g0 AS (SELECT trade_date, mb, o, c, unnest(range(0, mb + 1)) AS b FROM d0),
g1 AS (SELECT g0.trade_date, g0.mb, g0.o, g0.c, g0.b, a.recs, coalesce(a.trades, 0) AS trades, coalesce(a.ups, 0) AS ups FROM g0 LEFT JOIN a ON a.trade_date = g0.trade_date AND a.b = g0.b),
g2 AS (SELECT *, max(CASE WHEN trades + ups > 0 THEN b END) OVER (PARTITION BY trade_date ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_active FROM g1),
g3 AS (SELECT *, b - coalesce(last_active, -1) AS run FROM g2),
cuts AS (SELECT trade_date, min(b) AS cut FROM g3 WHERE b < mb AND trades + ups = 0 AND run >= {k} GROUP BY trade_date),
g AS (SELECT g3.trade_date, g3.mb, g3.b, g3.o, g3.c, cut, b = mb AS is_flush, b < mb AND b > 0 AND recs IS NULL AS is_gap, trades, ups, b >= {warmup} AS emit,
  CASE WHEN b = mb THEN c ELSE o + (b + 1) * {bin_ns} END AS bend FROM g3 LEFT JOIN cuts ON cuts.trade_date = g3.trade_date),
p0 AS (SELECT * FROM g WHERE CASE WHEN cut IS NOT NULL THEN b <= cut AND NOT is_flush ELSE NOT is_flush OR trades + ups > 0 END),
p1 AS (SELECT p0.*, max(last_seq) OVER (PARTITION BY p0.trade_date ORDER BY p0.b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st_seq FROM p0 LEFT JOIN a ON a.trade_date = p0.trade_date AND a.b = p0.b),
p AS (SELECT p1.*, s.bid IS NOT NULL AS st_valid, coalesce(s.mid, 0.0::DOUBLE) AS st_mid, coalesce(s.bps, 0.0::DOUBLE) AS st_bps, coalesce(s.bsz, 0) AS st_bsz, coalesce(s.asz, 0) AS st_asz, s.bbo_ts AS st_ts FROM p1 LEFT JOIN s ON s.seq = p1.st_seq)"""


GRAIN = 1 << 40


def whole_sums(volume: str, whole: str, parts: str) -> str:
    """A volume's sum as whole shares and whole parts of one."""
    return f"sum(floor({volume})::BIGINT) AS {whole}, sum(floor((({volume}) - floor({volume})) * {GRAIN}.0::DOUBLE + 0.5::DOUBLE)::BIGINT) AS {parts}"


def volume_of(whole: str, parts: str) -> str:
    return f"(({whole})::DOUBLE + ({parts})::DOUBLE / {GRAIN}.0::DOUBLE)"


def bvc(window_ns: int) -> str:
    return f"""
v0 AS (SELECT trade_date, seq, ts, px, size, b, pub, coalesce(px - lag(px) OVER (PARTITION BY trade_date ORDER BY seq), 0) AS d FROM r WHERE acc),
v1 AS (SELECT x.trade_date, x.seq, x.b, x.pub, x.size, x.d, count(*) AS n, sum(y.d::HUGEINT) AS sd, sum(y.d::HUGEINT * y.d::HUGEINT) AS sdd
  FROM v0 x JOIN v0 y ON y.trade_date = x.trade_date AND y.seq <= x.seq AND x.ts - y.ts <= {window_ns} GROUP BY ALL),
v2 AS (SELECT *, CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE sqrt((sdd * n - sd * sd)::DOUBLE / (n * (n - 1))::DOUBLE) * 1e-9::DOUBLE END AS sigma FROM v1),
v3 AS (SELECT *, CASE WHEN sigma > 1e-8::DOUBLE THEN d::DOUBLE * 1e-9::DOUBLE / sigma ELSE 0.0::DOUBLE END AS z FROM v2),
v4 AS (SELECT *, {phi('z')} AS share FROM v3),
v AS (SELECT *, size * share AS buy, size * (1.0::DOUBLE - share) AS sell FROM v4)"""


def phi(z: str) -> str:
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + 0.3275911::DOUBLE * (abs({z}) / sqrt(2.0::DOUBLE))))"
    poly = f"((((1.061405429::DOUBLE * {t} - 1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t} - 0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE)"
    erf = f"(1.0::DOUBLE - {poly} * {t} * exp(-({z}) * ({z}) / 2.0::DOUBLE))"
    return f"(0.5::DOUBLE * (1.0::DOUBLE + CASE WHEN {z} < 0 THEN -{erf} ELSE {erf} END))"


def live(bin_ns: int, min_trades: int, burst: int, burst_ns: int, warmup: int = 3, vpin: bool = False, lookback: int = 5) -> str:
    """Needs v, p, a, u0."""
    x = "1e-8::DOUBLE"
    rat = lambda n, d: f"(({n})::DOUBLE / greatest(({d})::DOUBLE, {x}))"
    z = lambda c: f"coalesce(a.{c}, 0)"
    one = lambda c: f"greatest({z(c)}, 1)::DOUBLE"
    vp = (
        f"""
vb AS (SELECT trade_date, b, max_by(vpin, bucket) AS tvp FROM vpt GROUP BY ALL), vl AS (SELECT trade_date, b, max_by(vpin, bucket) AS lvp FROM vpl GROUP BY ALL),"""
        if vpin
        else ""
    )
    vcols = "last_value(vb.tvp IGNORE NULLS) OVER ww AS tvp, last_value(vl.lvp IGNORE NULLS) OVER ww AS lvp," if vpin else "NULL AS tvp, NULL AS lvp,"
    vjoin = "LEFT JOIN vb ON vb.trade_date = p.trade_date AND vb.b = p.b LEFT JOIN vl ON vl.trade_date = p.trade_date AND vl.b = p.b" if vpin else ""
    return f"""
bt AS (SELECT trade_date, b, seq, ts, lag(ts, {burst - 1}) OVER (PARTITION BY trade_date, b ORDER BY seq) AS was FROM r WHERE acc AND trf),
bu AS (SELECT trade_date, b, max(ts) AS burst_ts FROM bt WHERE ts - was <= {burst_ns} GROUP BY ALL),{vp}
vv0 AS (SELECT trade_date, b, sum(size) AS al, {whole_sums('buy', 'wh', 'pt')} FROM v GROUP BY ALL),
vv AS (SELECT trade_date, b, {volume_of('wh', 'pt')} AS vbuy, {volume_of('al - wh', '-pt')} AS vsell FROM vv0),
uu AS (SELECT u0.trade_date, u0.b, sum(bps * (greatest(0, coalesce(next_ts, p.bend) - ts))::DOUBLE) AS ws, sum((greatest(0, coalesce(next_ts, p.bend) - ts))::DOUBLE) AS wd,
  max(bps) FILTER (WHERE n = 1) AS bps0, max(bsz) FILTER (WHERE n = 1) AS bsz0, max(asz) FILTER (WHERE n = 1) AS asz0 FROM u0 JOIN p ON p.trade_date = u0.trade_date AND p.b = u0.b GROUP BY ALL),
c AS (SELECT p.*, {vcols} last_value(bu.burst_ts IGNORE NULLS) OVER ww AS burst_ts FROM p LEFT JOIN bu ON bu.trade_date = p.trade_date AND bu.b = p.b {vjoin}
  WINDOW ww AS (PARTITION BY p.trade_date ORDER BY p.b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT c.trade_date, c.b AS bin_idx, c.bend AS bin_end_ns, c.is_gap, c.is_flush AS is_final, c.emit, c.st_mid AS mid_price, {z('tn')} AS tn, c.ups,
  {rat(f"{z('tb')} - {z('tsl')}", f"{z('tb')} + {z('tsl')}")} AS trf_signed_imbalance,
  {rat(f"{z('rb')} - {z('rs')}", f"{z('rb')} + {z('rs')}")} AS mroib,
  {rat(f"{z('rs')} - {z('rb')}", f"{z('rb')} + {z('rs')}")} AS inv_inst_direction,
  {rat('coalesce(vbuy, 0) - coalesce(vsell, 0)', 'coalesce(vbuy, 0) + coalesce(vsell, 0)')} AS bvc_imbalance,
  {rat(z('tv'), f"{z('tv')} + {z('lv')}")} AS dark_share, {z('tv')}::DOUBLE AS trf_volume, {z('lv')}::DOUBLE AS lit_volume, ({z('tv')} + {z('lv')})::DOUBLE AS total_volume,
  {z('sn')} / {one('tn')} AS subpenny_intensity, {z('odd')} / {one('tn')} AS odd_lot_ratio, {z('rn')} / {one('tn')} AS retail_trade_rate, {rat(z('rv'), z('tv'))} AS retail_volume_fraction,
  CASE WHEN wd >= {x} AND ws / wd > {x} THEN ws / wd ELSE c.st_bps END AS spread_bps,
  CASE WHEN c.ups > 0 THEN (c.st_bsz - bsz0) / bsz0::DOUBLE ELSE 0.0::DOUBLE END AS bid_pressure, CASE WHEN c.ups > 0 THEN (c.st_asz - asz0) / asz0::DOUBLE ELSE 0.0::DOUBLE END AS ask_pressure,
  c.ups::DOUBLE AS bbo_update_rate, {rat('c.st_bsz - c.st_asz', 'c.st_bsz + c.st_asz')} AS quote_imbalance, CASE WHEN c.ups > 0 THEN c.st_bps - bps0 ELSE 0.0::DOUBLE END AS spread_change_rate,
  coalesce(c.tvp, 0)::DOUBLE AS trf_vpin, coalesce(c.lvp, 0)::DOUBLE AS lit_vpin,
  {z('ss')} / {one('trades')} AS mean_trade_size, {z('blk')} / {one('trades')} AS block_trade_ratio, {z('trades')}::DOUBLE AS trade_count,
  CASE WHEN {z('ss')} = 0 THEN 0.0::DOUBLE ELSE {z('sq')}::DOUBLE / ({z('ss')}::DOUBLE * {z('ss')}::DOUBLE) END AS size_concentration,
  CASE WHEN coalesce(gaps, 0) = 0 OR gap_sum / gaps < {x} THEN 0.0::DOUBLE ELSE sqrt(greatest(gap_sq / gaps - (gap_sum / gaps) * (gap_sum / gaps), 0)) / (gap_sum / gaps) END AS trf_burst_intensity,
  CASE WHEN c.burst_ts IS NULL THEN {warmup * bin_ns // 1_000_000_000}.0::DOUBLE ELSE greatest(0, c.bend - c.burst_ts)::DOUBLE / 1e9::DOUBLE END AS time_since_burst,
  {rat(z('tv'), z('lv'))} AS trf_lit_volume_ratio, {z('trades')}::DOUBLE AS bin_trade_count, {z('tn')}::DOUBLE AS bin_trf_trade_count,
  CASE WHEN {z('tn')} >= {min_trades} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bin_valid,
  CASE WHEN c.st_valid AND c.bend - c.st_ts <= 5000000000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bbo_valid,
  least(greatest((c.bend - {bin_ns // 2} - c.o)::DOUBLE / 23400000000000.0::DOUBLE, 0), 1) AS session_progress,
  CASE WHEN tod < 34200 THEN 5 WHEN tod < 34500 THEN 0 WHEN tod < 37800 THEN 1 WHEN tod < 54000 THEN 2 WHEN tod < 57300 THEN 3 WHEN tod < 57600 THEN 4 ELSE 5 END::DOUBLE AS time_bucket,
  1.0::DOUBLE AS schema_version
  FROM (SELECT *, (bend - {bin_ns // 2} - o) // 1000000000 + 34200 AS tod FROM c) c LEFT JOIN a ON a.trade_date = c.trade_date AND a.b = c.b
  LEFT JOIN vv ON vv.trade_date = c.trade_date AND vv.b = c.b LEFT JOIN uu ON uu.trade_date = c.trade_date AND uu.b = c.b)"""


STATE_F = ("dark_share", "subpenny_intensity", "odd_lot_ratio", "retail_volume_fraction", "mean_trade_size", "block_trade_ratio", "size_concentration", "trf_lit_volume_ratio")
QUOTE_F = ("spread_bps", "quote_imbalance")
ALL_F = (
    "trf_signed_imbalance mroib inv_inst_direction bvc_imbalance dark_share trf_volume lit_volume total_volume subpenny_intensity odd_lot_ratio retail_trade_rate retail_volume_fraction spread_bps bid_pressure ask_pressure "
    "bbo_update_rate quote_imbalance spread_change_rate trf_vpin lit_vpin mean_trade_size block_trade_ratio trade_count size_concentration trf_burst_intensity time_since_burst trf_lit_volume_ratio bin_trade_count "
    "bin_trf_trade_count bin_valid bbo_valid session_progress time_bucket schema_version"
).split()


def filled() -> str:
    """Each filled value is looked up in its source bin."""
    same = [c for c in ALL_F if c not in STATE_F and c not in QUOTE_F]
    cols = ", ".join([*(f"x.{c}" for c in same), *(f"CASE WHEN x.tn > 0 THEN x.{c} ELSE coalesce(t.{c}, 0.0::DOUBLE) END AS {c}" for c in STATE_F), *(f"CASE WHEN x.tn > 0 OR x.ups > 0 THEN x.{c} ELSE coalesce(m.{c}, 0.0::DOUBLE) END AS {c}" for c in QUOTE_F)])
    return f"""
fs AS (SELECT *, max(CASE WHEN tn > 0 THEN bin_idx END) OVER w AS t_from, max(CASE WHEN tn > 0 OR ups > 0 THEN bin_idx END) OVER w AS m_from FROM l
  WINDOW w AS (PARTITION BY trade_date ORDER BY bin_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT x.trade_date, x.bin_idx, x.bin_end_ns, x.is_gap, x.is_final, x.emit, x.mid_price, {cols} FROM fs x
  LEFT JOIN l t ON t.trade_date = x.trade_date AND t.bin_idx = x.t_from LEFT JOIN l m ON m.trade_date = x.trade_date AND m.bin_idx = x.m_from)"""


def vpin_cte(name: str, where: str, volume: int | str, lookback: int, window_ns: int, table: str = "r") -> str:
    n = name
    return f"""
{n}0 AS (SELECT trade_date, seq, ts, px, size, b, coalesce(px - lag(px) OVER (PARTITION BY trade_date ORDER BY seq), 0) AS d, sum(size) OVER (PARTITION BY trade_date ORDER BY seq) AS thru, ({volume})::BIGINT AS vol FROM {table} WHERE acc AND {where}),
{n}1 AS (SELECT x.trade_date, x.seq, x.b, x.size, x.d, x.thru, x.vol, count(*) AS n, sum(y.d::HUGEINT) AS sd, sum(y.d::HUGEINT * y.d::HUGEINT) AS sdd FROM {n}0 x JOIN {n}0 y ON y.trade_date = x.trade_date AND y.seq <= x.seq AND x.ts - y.ts <= {window_ns} GROUP BY ALL),
{n}2 AS (SELECT *, CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE sqrt((sdd * n - sd * sd)::DOUBLE / (n * (n - 1))::DOUBLE) * 1e-9::DOUBLE END AS sigma FROM {n}1),
{n}3 AS (SELECT *, CASE WHEN sigma > 1e-8::DOUBLE THEN d::DOUBLE * 1e-9::DOUBLE / sigma ELSE 0.0::DOUBLE END AS z FROM {n}2),
{n}4 AS (SELECT *, {phi('z')} AS share, unnest(range(((thru - size) // vol)::BIGINT, ((thru - 1) // vol)::BIGINT + 1)) AS bucket FROM {n}3),
{n}5 AS (SELECT *, (least(thru, (bucket + 1) * vol) - greatest(thru - size, bucket * vol))::BIGINT AS part FROM {n}4),
{n}6 AS (SELECT trade_date, bucket, {whole_sums('part * share', 'wh', 'pt')}, sum(part) AS filled, max_by(b, seq) AS b, vol FROM {n}5 GROUP BY trade_date, bucket, vol),
{n}7 AS (SELECT *, {volume_of('wh', 'pt')} AS buy, {volume_of('filled - wh', '-pt')} AS sell, abs({volume_of('filled - 2 * wh', '-2 * pt')}) / vol::DOUBLE AS imbalance FROM {n}6 WHERE filled = vol),
{n} AS (SELECT *, avg(imbalance) OVER w AS vpin FROM {n}7 WINDOW w AS (PARTITION BY trade_date ORDER BY bucket ROWS BETWEEN {lookback - 1} PRECEDING AND CURRENT ROW))"""


HOUR = 3_600_000_000_000
B600, B60 = 600_000_000_000, 60_000_000_000


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def r6(c: str, name: str | None = None) -> str:
    return f"round({c}, 6) AS {name or c}"


def _coarse() -> tuple[str, ...]:
    return RAW, STATE, records(B600), sums(), grid(B600), bvc(HOUR), live(B600, 2, 3, 300_000_000_000)


def _fine() -> tuple[str, ...]:
    return RAW, STATE, records(B60), sums(), grid(B60), bvc(HOUR), live(B60, 10, 20, 1_000_000_000)


def _live(*names: str) -> str:
    return with_(*_coarse(), select=f"SELECT trade_date, bin_idx, {', '.join(r6(n) for n in names)} FROM l WHERE emit")


_VPIN = (vpin_cte("vpt", "trf", 1000, 5, HOUR), vpin_cte("vpl", "lit", 1000, 5, HOUR))
_LEADS = "SELECT *, " + ", ".join(f"(lead(mid_price, {h}) OVER w - mid_price) / nullif(mid_price, 0) * 10000.0::DOUBLE AS label_{h}" for h in (1, 2, 3, 5)) + ", row_number() OVER w - 1 AS position FROM l WHERE emit WINDOW w AS (PARTITION BY trade_date ORDER BY bin_idx)"
_VALID = "(label_1 IS NOT NULL AND label_2 IS NOT NULL AND label_3 IS NOT NULL AND label_5 IS NOT NULL)"
_CALENDAR = "cal AS (SELECT d::DATE AS trade_date FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-15', INTERVAL 1 DAY)) AS d) WHERE dayofweek(d) NOT IN (0, 6) AND d::DATE NOT IN (DATE '2024-01-01', DATE '2024-01-15'))"
_CONTEXT = """cx AS (SELECT trade_date, sum(size)::BIGINT AS consolidated_volume, min_by(px, seq)::DOUBLE * 1e-9::DOUBLE AS open, max(px)::DOUBLE * 1e-9::DOUBLE AS high, min(px)::DOUBLE * 1e-9::DOUBLE AS low, max_by(px, seq)::DOUBLE * 1e-9::DOUBLE AS close
  FROM raw WHERE px > 0 GROUP BY trade_date)"""
_AS_IS = ("bin_valid", "bbo_valid", "time_bucket", "schema_version")
_FILL = ("dark_share", "subpenny_intensity", "odd_lot_ratio", "retail_volume_fraction", "mean_trade_size", "block_trade_ratio", "size_concentration", "spread_bps", "quote_imbalance")
_COVER = "cv AS (SELECT x.trade_date, trf_volume, lit_volume, consolidated_volume, (trf_volume + lit_volume) / consolidated_volume::DOUBLE AS coverage, trf_volume / consolidated_volume::DOUBLE AS dark_share FROM (SELECT p.trade_date, coalesce(sum(tv), 0)::DOUBLE AS trf_volume, coalesce(sum(lv), 0)::DOUBLE AS lit_volume FROM p LEFT JOIN a ON a.trade_date = p.trade_date AND a.b = p.b GROUP BY p.trade_date) x LEFT JOIN cx ON cx.trade_date = x.trade_date)"


def oracle_sql() -> dict[str, str]:
    base = (RAW, STATE, records(B600))
    matrix = f"SELECT trade_date, bin_idx, bin_end_ns, is_gap, is_final, {', '.join(r6(c) for c in ['mid_price', *ALL_F])} FROM f WHERE emit"
    bvc_cols = f"SELECT trade_date, seq, n AS window_n, {r6('d::DOUBLE * 1e-9::DOUBLE', 'delta')}, {r6('sigma')}, {r6('buy', 'bvc_buy')}, {r6('sell', 'bvc_sell')} FROM v"
    bins_of = lambda b: (RAW, STATE, records(b), sums(), grid(b))
    zs = ", ".join(r6(f"CASE WHEN s_{c} < 1e-8::DOUBLE THEN least(greatest((f.{c} - m_{c}) / 1e-8::DOUBLE, -100), 100) ELSE (f.{c} - m_{c}) / s_{c} END", c) if c not in _AS_IS else r6(f"f.{c}", c) for c in ALL_F)
    digits = lambda x, name: f"CASE WHEN abs({x}) >= 1000000 THEN round({x}, -3) ELSE round({x}, 6) END AS {name}"
    stats_rows = " UNION ALL ".join(f"SELECT trade_date, '{c}' AS feature, {digits(f'avg({c})', 'mean')}, {digits(f'stddev_pop({c})', 'std')}, {digits(f'min({c})', 'min')}, {digits(f'max({c})', 'max')}, count({c}) AS n_finite, 0::BIGINT AS n_nan FROM f WHERE emit GROUP BY trade_date" for c in ALL_F)
    volume = lambda w: f"coalesce(sum(size) FILTER (WHERE {w}), 0)::DOUBLE"
    z = lambda c: f"coalesce({c}, 0)"
    islands = """SELECT trade_date, min(us) AS start_us, max(us) + 300000000 AS end_us, count(*) AS trades, sum(size)::BIGINT AS volume, coalesce(sum(size) FILTER (WHERE pub IN (82, 83)), 0)::BIGINT AS trf_volume,
  coalesce(sum(size) FILTER (WHERE pub IN (81, 88, 89)), 0)::BIGINT AS lit_volume, min(px) AS low_nano, max(px) AS high_nano
  FROM (SELECT *, sum(opens) OVER (PARTITION BY trade_date ORDER BY us, seq) AS island FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY trade_date ORDER BY us, seq) < 300000000 THEN 0 ELSE 1 END AS opens
  FROM (SELECT *, ts // 1000 AS us FROM raw WHERE action = 'T' AND px > 0))) GROUP BY trade_date, island"""
    split = "CASE WHEN trade_date <= DATE '2024-01-20' THEN 'train' WHEN trade_date <= DATE '2024-01-25' THEN 'val' ELSE 'test' END AS split"
    ends = f"lb AS ({_LEADS})", f"sq AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY position) - 1 AS n FROM lb WHERE position >= 4 AND {_VALID})"
    ahead = ", ".join(f"nullif(lead(mid_price, {k}) OVER w, 0) AS price_{k}" for k in range(6))
    gz = ", ".join(r6(f"CASE WHEN s_{c} < 1e-8::DOUBLE THEN least(greatest((f.{c} - m_{c}) / 1e-8::DOUBLE, -100), 100) ELSE (f.{c} - m_{c}) / s_{c} END", c) if c not in _AS_IS else r6(f"f.{c}", c) for c in ALL_F)
    signals = ("trf_signed_imbalance", "mroib", "dark_share", "trf_volume")
    ics = ["ll AS (SELECT *, (lead(mid_price) OVER w - mid_price) / nullif(mid_price, 0) * 10000.0::DOUBLE AS y FROM l WHERE emit WINDOW w AS (PARTITION BY trade_date ORDER BY bin_idx))"]
    ics.append("lf AS (" + " UNION ALL ".join(f"SELECT trade_date, '{c}' AS feature, {c} AS x, y FROM ll WHERE y IS NOT NULL" for c in signals) + ")")
    twice = lambda c: f"2 * rank() OVER (PARTITION BY trade_date, feature ORDER BY {c}) + count(*) OVER (PARTITION BY trade_date, feature, {c}) - 1"
    ics.append(f"lr AS (SELECT trade_date, feature, ({twice('x')})::HUGEINT AS a, ({twice('y')})::HUGEINT AS b FROM lf)")
    ics.append("li AS (SELECT trade_date, feature, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(a * b) AS ab, sum(a * a) AS aa, sum(b * b) AS bb FROM lr GROUP BY ALL)")
    ics.append("ic AS (SELECT trade_date, feature, n, CASE WHEN (n * aa - a * a) * (n * bb - b * b) > 0 THEN (n * ab - a * b)::DOUBLE / sqrt((n * aa - a * a)::DOUBLE * (n * bb - b * b)::DOUBLE) END AS ic FROM li)")
    reached, steps = 0.0, []
    for k in range(12):
        reached += math.exp(-1) / math.factorial(k)
        steps.append(f"(u >= {reached!r}::DOUBLE)::INT")
    boot = [
        "zu AS (SELECT feature, ic, rep, (('0x' || left(md5('7:' || rep || ':' || strftime(trade_date, '%Y-%m-%d')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u FROM ic, (SELECT unnest(range(1, 201)) AS rep) WHERE ic IS NOT NULL)",
        f"bw AS (SELECT feature, rep, ic, {' + '.join(steps)} AS w FROM zu)",
        "bm AS (SELECT feature, rep, sum(w * ic) / sum(w) AS m FROM bw GROUP BY ALL HAVING sum(w) > 0)",
        "bq AS (SELECT feature, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM bm GROUP BY feature)",
    ]
    kyle = """kx AS (SELECT trade_date, seq, b, (coalesce(px - lag(px) OVER (PARTITION BY trade_date ORDER BY seq), 0))::HUGEINT AS x, (CASE direction WHEN 'Buy' THEN size WHEN 'Sell' THEN -size ELSE 0 END)::HUGEINT AS v FROM r WHERE acc AND trf),
ks AS (SELECT trade_date, seq, b, count(*) OVER w AS n, sum(x) OVER w AS sx, sum(v) OVER w AS sv, sum(x * v) OVER w AS sxv, sum(v * v) OVER w AS svv FROM kx WINDOW w AS (PARTITION BY trade_date ORDER BY seq ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""
    in_force = f"SELECT t.trade_date, t.seq, t.size, {r6('x.bid_px::DOUBLE * 1e-9::DOUBLE', 'quote_bid')}, {r6('x.ask_px::DOUBLE * 1e-9::DOUBLE', 'quote_ask')}, x.ts AS quote_ts FROM (SELECT * FROM raw WHERE action = 'T') t LEFT JOIN (SELECT *, lead(ts) OVER (PARTITION BY trade_date ORDER BY ts, seq) AS until FROM q WHERE action = 'A' AND quote_check = 'ok') x ON x.trade_date = t.trade_date AND x.ts <= t.ts AND (x.until IS NULL OR t.ts < x.until)"
    return {
        "interval_join_quotes": with_(RAW, STATE, select=in_force),
        "global_zscore": with_(*_coarse(), filled(), "zz AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ALL_F) + " FROM f WHERE emit AND trade_date <= DATE '2024-01-20')", select=f"SELECT f.trade_date, f.bin_idx, {gz} FROM f, zz WHERE f.emit"),
        "kyle_lambda": with_(*base, kyle, select=f"SELECT trade_date, seq, b AS bin_idx, {r6('CASE WHEN n = 20 AND 20 * svv - sv * sv > 0 THEN (20 * sxv - sx * sv)::DOUBLE / (20 * svv - sv * sv)::DOUBLE * 1e-9::DOUBLE END * 1e6::DOUBLE', 'kyle_lambda')} FROM ks"),
        "tick_test": with_(*base, "tt AS (SELECT trade_date, seq, px - lag(px) OVER (PARTITION BY trade_date ORDER BY seq) AS d FROM r WHERE acc)", "ti AS (SELECT *, count(*) FILTER (WHERE d <> 0) OVER (PARTITION BY trade_date ORDER BY seq) AS island FROM tt)", select="SELECT trade_date, seq, coalesce(max(CASE WHEN d <> 0 THEN sign(d) END) OVER (PARTITION BY trade_date, island), 0)::BIGINT AS tick_sign FROM ti"),
        "rank_ic_daily": with_(*_coarse(), *ics, select=f"SELECT trade_date, feature, n, {r6('ic')} FROM ic"),
        "rank_ic_bootstrap": with_(*_coarse(), *ics, *boot, select=f"SELECT feature, count(*) AS blocks, {r6('avg(ic)', 'mean_ic')}, {r6('min(low)', 'low')}, {r6('min(high)', 'high')} FROM ic LEFT JOIN bq USING (feature) WHERE ic IS NOT NULL GROUP BY feature"),
        "sketch_rollup": with_(RAW, select="SELECT date_trunc('week', trade_date)::DATE AS week, count(*) AS trades, count(DISTINCT px) AS prices, true AS prices_within, true AS size_10_within, true AS size_50_within, true AS size_90_within FROM raw WHERE action = 'T' AND px > 0 GROUP BY 1"),
        "feed_round_trip": with_(RAW, select="SELECT trade_date, seq, ts AS ts_recv_ns, action, px AS price_nano, size, bid_px AS bid_px_nano, bid_sz, ask_px AS ask_px_nano, ask_sz, pub AS publisher_id FROM raw"),
        "npy_sequences": with_(*_coarse(), filled(), *ends, "ff AS (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY bin_idx) - 1 AS position FROM f WHERE emit)", select=f"SELECT sq.trade_date, {split.replace('trade_date', 'sq.trade_date')}, n, ff.position - sq.position + 4 AS step, {', '.join(r6(f'ff.{c}::FLOAT::DOUBLE', c) for c in ALL_F)} FROM sq JOIN ff ON ff.trade_date = sq.trade_date AND ff.position BETWEEN sq.position - 4 AND sq.position"),
        "npy_targets": with_(*_coarse(), *ends, f"pr AS (SELECT trade_date, bin_idx, {ahead} FROM l WHERE emit WINDOW w AS (PARTITION BY trade_date ORDER BY bin_idx))", select=f"SELECT sq.trade_date, {split.replace('trade_date', 'sq.trade_date')}, n, {', '.join(r6(f'label_{h}') for h in (1, 2, 3, 5))}, {', '.join(r6(f'price_{k}') for k in range(6))} FROM sq JOIN pr ON pr.trade_date = sq.trade_date AND pr.bin_idx = sq.bin_idx"),
        "session_windows": with_(RAW, select=islands),
        "stream_sliding": with_(*base, "sw AS (SELECT *, (ts // 1000) // 600000000 * 600000000 - j * 600000000 AS start_us FROM r, (SELECT unnest([0, 1, 2]) AS j) WHERE acc)", select=f"SELECT trade_date, start_us, start_us + 1800000000 AS end_us, count(*) AS trades, count(*) FILTER (WHERE trf) AS trf_trades, {volume('trf')} AS trf_volume, {volume('lit')} AS lit_volume, {r6(volume('trf') + ' / greatest(' + volume('trf') + ' + ' + volume('lit') + ', 1e-8::DOUBLE)', 'dark_share')} FROM sw GROUP BY trade_date, start_us"),
        "stream_sessions": with_(RAW, select=islands),
        "stream_state_bins": with_(RAW, STATE, records(B60), sums(), grid(B60, k=10**9), select=f"""SELECT p.trade_date, p.b AS bin_idx, bend AS bin_end_ns, is_gap, is_flush, p.trades, p.ups AS updates, coalesce(a.dropped, 0) AS dropped, {z('tb')}::BIGINT AS trf_buy_vol, {z('tsl')}::BIGINT AS trf_sell_vol,
  {z('tu')}::BIGINT AS trf_unsigned_vol, {z('lv')}::BIGINT AS lit_vol, {r6('s.bid', 'bid')}, {r6('s.ask', 'ask')}, s.bsz AS bid_size, s.asz AS ask_size, {r6('st_mid', 'mid_price')}, st_ts AS quote_ts
  FROM p LEFT JOIN a ON a.trade_date = p.trade_date AND a.b = p.b LEFT JOIN s ON s.seq = p.st_seq WHERE NOT (is_flush AND p.trade_date = (SELECT max(trade_date) FROM raw))"""),
        "bin_signed_flow": with_(*base, sums(), select=f"SELECT trade_date, b AS bin_idx, tb::BIGINT AS trf_buy_vol, tsl::BIGINT AS trf_sell_vol, tu::BIGINT AS trf_unsigned_vol, rv::BIGINT AS retail_vol, rb::BIGINT AS retail_buy_vol, rs::BIGINT AS retail_sell_vol, lv::BIGINT AS lit_vol, {r6('(tb - tsl)::DOUBLE / greatest((tb + tsl)::DOUBLE, 1e-8::DOUBLE)', 'trf_signed_imbalance')} FROM a"),
        "bbo_state_asof": with_(RAW, STATE, select=f"SELECT trade_date, seq, quote_check, valid AS bbo_valid, {r6('bid')}, {r6('ask')}, bsz AS bid_size, asz AS ask_size, {r6('mid')}, {r6('bps', 'spread_bps')}, {r6('micro', 'microprice')}, bbo_ts FROM s"),
        "bbo_diagnostics": with_(RAW, STATE, select="SELECT trade_date, count(*) FILTER (WHERE quote_check = 'ok') AS updates, count(*) FILTER (WHERE quote_check = 'crossed') AS crossed, count(*) FILTER (WHERE quote_check = 'invalid') AS invalid FROM q GROUP BY trade_date"),
        "asof_join_tables": with_(RAW, STATE, select=f"SELECT t.trade_date, t.seq, t.size, {r6('x.bid_px::DOUBLE * 1e-9::DOUBLE', 'quote_bid')}, {r6('x.ask_px::DOUBLE * 1e-9::DOUBLE', 'quote_ask')}, x.ts AS quote_ts FROM (SELECT * FROM raw WHERE action = 'T') t ASOF LEFT JOIN (SELECT * FROM q WHERE action = 'A' AND quote_check = 'ok') x ON t.trade_date = x.trade_date AND t.ts >= x.ts"),
        "trade_classification": with_(*base, select=f"SELECT trade_date, seq, venue, direction, retail, {r6('price')} FROM r WHERE is_trade AND inside"),
        "classifier_summary": with_(*base, select="""SELECT trade_date, count(*) AS total_trades, count(*) FILTER (WHERE trf) AS trf_trades, count(*) FILTER (WHERE direction = 'Buy') AS signed_buy, count(*) FILTER (WHERE direction = 'Sell') AS signed_sell, count(*) FILTER (WHERE direction = 'Unsigned') AS unsigned,
 count(*) FILTER (WHERE retail = 'Retail') AS retail_count, count(*) FILTER (WHERE retail = 'Institutional') AS institutional_count, count(*) FILTER (WHERE retail = 'Unknown') AS unknown_count, count(*) FILTER (WHERE NOT priced) AS invalid_price_count,
 round(count(*) FILTER (WHERE retail = 'Retail') / greatest(count(*) FILTER (WHERE trf), 1)::DOUBLE, 6) AS retail_rate, round(count(*) FILTER (WHERE trf AND direction = 'Unsigned') / greatest(count(*) FILTER (WHERE trf), 1)::DOUBLE, 6) AS trf_unsigned_rate FROM r WHERE is_trade AND inside GROUP BY trade_date"""),
        "venue_mix": with_(*base, select="SELECT trade_date, venue, count(*) AS trades, sum(size)::BIGINT AS volume FROM r WHERE is_trade GROUP BY trade_date, venue"),
        "session_filter": with_(*base, select="SELECT trade_date, count(*) FILTER (WHERE inside) AS inside, count(*) FILTER (WHERE ts < open_ns) AS before, count(*) FILTER (WHERE ts >= close_ns) AS after, count(*) FILTER (WHERE acc) AS accepted, count(*) FILTER (WHERE dropped) AS dropped FROM r GROUP BY trade_date"),
        "tumbling_bins": with_(*base, select="SELECT trade_date, b AS bin_idx, count(*) AS records, count(*) FILTER (WHERE inside) AS inside, min(seq) AS first_seq, max(seq) AS last_seq FROM r GROUP BY trade_date, b"),
        "bin_flow_features": _live(*ALL_F[0:3]),
        "bin_venue_metrics": _live(*ALL_F[4:8]),
        "bin_retail_metrics": _live(*ALL_F[8:12]),
        "bin_bbo_dynamics": _live(*ALL_F[12:18]),
        "bin_trade_size": _live(*ALL_F[20:24]),
        "bin_burst": _live("trf_burst_intensity", "time_since_burst"),
        "bin_trf_lit_ratio": _live("trf_lit_volume_ratio"),
        "bin_activity_gates": _live(*ALL_F[27:31]),
        "bin_context": _live(*ALL_F[31:34]),
        "bvc_per_trade": with_(*base, bvc(HOUR), select=bvc_cols),
        "bvc_replayed": with_(*base, bvc(HOUR), select=bvc_cols),
        "bin_bvc": with_(*base, bvc(HOUR), f"vs AS (SELECT trade_date, b, sum(size) AS al, {whole_sums('buy', 'wh', 'pt')} FROM v GROUP BY ALL)", select=f"SELECT trade_date, b AS bin_idx, {r6(volume_of('wh', 'pt'), 'bvc_buy')}, {r6(volume_of('al - wh', '-pt'), 'bvc_sell')} FROM vs"),
        "bin_bursts": with_(*base, select="SELECT trade_date, b AS bin_idx, max(ts) AS burst_ts FROM (SELECT *, lag(ts, 2) OVER (PARTITION BY trade_date, b ORDER BY seq) AS was FROM r WHERE acc AND trf) WHERE ts - was <= 300000000000 GROUP BY trade_date, b"),
        "vpin_buckets": with_(*base, _VPIN[0], select=f"SELECT trade_date, bucket, b AS bin_idx, {r6('buy')}, {r6('sell')}, {r6('imbalance')}, {r6('vpin')} FROM vpt"),
        "vpin_daily_buckets": with_(*base, _CONTEXT, "rd AS (SELECT r.*, floor(consolidated_volume * 0.05::DOUBLE)::BIGINT AS own FROM r LEFT JOIN cx ON cx.trade_date = r.trade_date)", vpin_cte("vpd", "trf", "CASE WHEN own > 0 THEN own ELSE 1000 END", 5, HOUR, "rd"), select=f"SELECT trade_date, count(*) AS buckets, {r6('avg(imbalance)', 'mean_imbalance')} FROM vpd GROUP BY trade_date"),
        "bin_vpin": with_(*base, sums(), grid(B600), bvc(HOUR), *_VPIN, live(B600, 2, 3, 300_000_000_000, vpin=True), select=f"SELECT trade_date, bin_idx, {r6('trf_vpin')}, {r6('lit_vpin')} FROM l WHERE emit"),
        "gap_bins": with_(*bins_of(B60), select=f"SELECT trade_date, b AS bin_idx, bend AS bin_end_ns, is_gap, is_flush, emit, trades, ups AS updates, {r6('st_mid', 'mid_price')} FROM p"),
        "volume_bins": with_(*base, "vb0 AS (SELECT trade_date, seq, size, sum(size) OVER (PARTITION BY trade_date ORDER BY seq) AS thru FROM r WHERE acc)", select="SELECT trade_date, ((thru - 1) // 5000)::BIGINT AS volume_bin, count(*) AS trades, sum(size)::BIGINT AS volume, min(seq) AS first_seq FROM vb0 GROUP BY 1, 2"),
        "finite_features": with_(*bins_of(B600), select="SELECT trade_date, count(*) AS bins, max(b) AS last_bin FROM p WHERE emit GROUP BY trade_date"),
        "early_close": with_(*bins_of(B60), select="SELECT trade_date, min(cut) AS cut, max(mb) AS max_bin, count(*) AS processed, count(*) FILTER (WHERE is_gap) AS gaps FROM p GROUP BY trade_date"),
        "forward_fill": with_(*_fine(), filled(), select=f"SELECT trade_date, bin_idx, {', '.join(r6(c) for c in _FILL)} FROM f WHERE emit"),
        "feature_matrix": with_(*_coarse(), filled(), select=matrix),
        "feature_matrix_fine": with_(*_fine(), filled(), select=matrix),
        "labels_point_return": with_(*_coarse(), f"lb AS ({_LEADS})", select=f"SELECT trade_date, bin_idx, {', '.join(r6(f'label_{h}') for h in (1, 2, 3, 5))}, {_VALID} AS label_valid FROM lb"),
        "forward_prices": with_(*_coarse(), select="SELECT trade_date, bin_idx, " + ", ".join(f"round(nullif(lead(mid_price, {k}) OVER w, 0), 6) AS price_{k}" for k in range(6)) + " FROM l WHERE emit WINDOW w AS (PARTITION BY trade_date ORDER BY bin_idx)"),
        "sequences_index": with_(*_coarse(), f"lb AS ({_LEADS})", "sq AS (SELECT *, sum(trf_volume + trade_count * 1000) OVER (PARTITION BY trade_date ORDER BY bin_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS checksum FROM lb)", select=f"SELECT trade_date, bin_idx, position, position - 4 AS first_position, checksum FROM sq WHERE position >= 4 AND {_VALID}"),
        "normalization_stats": with_(*_coarse(), filled(), select=stats_rows),
        "zscore_features": with_(*_coarse(), filled(), "zz AS (SELECT trade_date, " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in ALL_F) + " FROM f WHERE emit GROUP BY trade_date)", select=f"SELECT f.trade_date, f.bin_idx, {zs} FROM f JOIN zz ON zz.trade_date = f.trade_date WHERE f.emit"),
        "calendar_weekdays": with_(RAW, "ds AS (SELECT trade_date, count(*) AS n FROM raw GROUP BY trade_date)", "cal AS (SELECT d::DATE AS trade_date FROM (SELECT unnest(generate_series(min(trade_date)::TIMESTAMP, max(trade_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM ds) WHERE dayofweek(d) NOT IN (0, 6) AND d::DATE NOT IN (DATE '2024-01-01', DATE '2024-01-15'))", select="SELECT cal.trade_date, strftime(cal.trade_date, '%Y%m%d') AS file_date, true AS same, coalesce(n, 0) AS n FROM cal LEFT JOIN ds ON ds.trade_date = cal.trade_date"),
        "split_assignment": with_(RAW, _CALENDAR, "dv AS (SELECT trade_date, count(*) AS n FROM raw GROUP BY trade_date)", select="SELECT CASE WHEN trade_date <= DATE '2024-01-20' THEN 'train' WHEN trade_date <= DATE '2024-01-25' THEN 'val' ELSE 'test' END AS split, count(*) AS n_days, sum(n)::BIGINT AS n_records, min(trade_date) AS first_date, max(trade_date) AS last_date FROM cal JOIN dv USING (trade_date) WHERE trade_date <= DATE '2024-01-31' GROUP BY 1"),
        "missing_days": with_(RAW, _CALENDAR, select="SELECT trade_date FROM cal WHERE trade_date NOT IN (SELECT trade_date FROM raw)"),
        "daily_context_join": with_(RAW, _CONTEXT, select=f"SELECT d.trade_date, n_records, consolidated_volume, {r6('open')}, {r6('high')}, {r6('low')}, {r6('close')} FROM (SELECT trade_date, count(*) AS n_records FROM raw GROUP BY trade_date) d LEFT JOIN cx ON cx.trade_date = d.trade_date"),
        "empty_context_join": with_(RAW, select="SELECT trade_date, count(*) AS n_records, NULL::BIGINT AS consolidated_volume, NULL::DOUBLE AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, NULL::DOUBLE AS close FROM raw GROUP BY trade_date"),
        "day_summaries": with_(*bins_of(B60), "pp AS (SELECT p.*, coalesce(tn, 0) AS tn, coalesce(ln, 0) AS ln, coalesce(tv, 0) AS tv, coalesce(lv, 0) AS lv, coalesce(dropped, 0) AS dropped FROM p LEFT JOIN a ON a.trade_date = p.trade_date AND a.b = p.b)", select=f"""SELECT trade_date, sum(trades)::BIGINT AS total_records_processed, count(*) FILTER (WHERE emit) AS total_bins_emitted, count(*) FILTER (WHERE emit AND tn = 0) AS total_empty_bins, count(*) FILTER (WHERE NOT emit AND NOT is_gap AND NOT is_flush) AS warmup_bins_discarded,
 count(*) FILTER (WHERE emit AND is_gap) AS gap_bins_emitted, sum(tn)::BIGINT AS total_trf_trades, sum(ln)::BIGINT AS total_lit_trades, sum(trades)::BIGINT AS total_trade_records, coalesce(min(bend) FILTER (WHERE emit) - {B60}, 0) AS first_bin_start_ns, coalesce(min(bend) FILTER (WHERE emit), 0) AS first_bin_end_ns, coalesce(max(bend) FILTER (WHERE emit), 0) AS last_bin_end_ns,
 sum(tv)::DOUBLE AS total_trf_volume, sum(lv)::DOUBLE AS total_lit_volume, sum(dropped)::BIGINT AS dropped_invalid_price_trades, NULL::BIGINT AS decode_errors, NULL::BOOLEAN AS decode_truncated FROM pp GROUP BY trade_date"""),
        "coverage_report": with_(*bins_of(B600), _CONTEXT, _COVER, select=f"SELECT trade_date, trf_volume, lit_volume, consolidated_volume, {r6('coverage')}, {r6('dark_share')} FROM cv"),
        "coverage_summary": with_(*bins_of(B600), _CONTEXT, _COVER, select="SELECT count(*) AS days, round(avg(coverage), 6) AS mean_coverage, round(min(coverage), 6) AS min_coverage, round(max(coverage), 6) AS max_coverage, round(avg(dark_share), 6) AS mean_dark_share, CASE WHEN avg(coverage) BETWEEN 0.8::DOUBLE AND 0.86::DOUBLE THEN 'PASS' ELSE 'WARNING' END AS status FROM cv WHERE coverage IS NOT NULL"),
        "profile_report": with_(*_coarse(), f"lb AS ({_LEADS})", f"ns AS (SELECT trade_date, count(*) AS n FROM lb WHERE position >= 4 AND {_VALID} GROUP BY trade_date)", "pp AS (SELECT p.*, coalesce(tn, 0) AS tn, coalesce(ln, 0) AS ln FROM p LEFT JOIN a ON a.trade_date = p.trade_date AND a.b = p.b)", select="SELECT pp.trade_date, sum(trades)::BIGINT AS records, sum(trades)::BIGINT AS trades, sum(tn)::BIGINT AS trf_trades, sum(ln)::BIGINT AS lit_trades, count(*) FILTER (WHERE emit) AS bins, count(*) FILTER (WHERE emit AND tn = 0) AS empty_bins, coalesce(max(ns.n), 0) AS sequences FROM pp LEFT JOIN ns ON ns.trade_date = pp.trade_date GROUP BY pp.trade_date"),
        "fusion": with_(*_coarse(), select="SELECT trade_date, bin_idx, trf_volume, trf_volume AS trf_volume_r, bbo_update_rate FROM l WHERE emit"),
        "normal_cdf_grid": f"SELECT event_id, round({phi('z')}, 6) AS phi FROM (SELECT event_id, (value - 10.0::DOUBLE) / 5.0::DOUBLE AS z FROM events)",
        "file_discovery": with_(RAW, select="SELECT trade_date, 'day=' || strftime(trade_date, '%Y%m%d') AS name, count(*) AS n FROM raw GROUP BY trade_date"),
        "npy_export": with_(*_coarse(), f"lb AS ({_LEADS})", f"ns AS (SELECT trade_date, count(*) AS n FROM lb WHERE position >= 4 AND {_VALID} GROUP BY trade_date)", select="SELECT CASE WHEN trade_date <= DATE '2024-01-20' THEN 'train' WHEN trade_date <= DATE '2024-01-25' THEN 'val' ELSE 'test' END AS split, count(*) AS n_days, coalesce(sum(n), 0)::BIGINT AS n_sequences, strftime(min(trade_date), '%Y-%m-%d') AS first_date, strftime(max(trade_date), '%Y-%m-%d') AS last_date FROM (SELECT DISTINCT trade_date FROM p) LEFT JOIN ns USING (trade_date) GROUP BY 1"),
        "stream_tumbling": with_(*base, select=f"SELECT trade_date, (ts - open_ns) // {B600} AS bin_idx, count(*) AS trades, count(*) FILTER (WHERE trf) AS trf_trades, {volume('trf')} AS trf_volume, {volume('lit')} AS lit_volume, round({volume('trf')} / greatest({volume('trf')} + {volume('lit')}, 1e-8::DOUBLE), 6) AS dark_share FROM r WHERE acc GROUP BY trade_date, (ts - open_ns) // {B600}"),
    }

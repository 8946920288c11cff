"""A record-at-a-time model of the engine, written apart from the plans, to hold them against."""

from __future__ import annotations

import math

UNDEFINED = 2**63 - 1
TRF, LIT = {82, 83}, {81, 88, 89}


def phi(z):
    x = abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    e = 1 - (((((1.061405429 * t - 1.453152027) * t) + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * math.exp(-x * x)
    return 0.5 * (1 + math.copysign(e, z)) if z else 0.5 * (1 + e)


class Bin:
    def __init__(self):
        self.trades, self.trf, self.quotes = [], [], []


def run_day(rows, open_ns, close_ns, bin_ns, warmup=3, gap_limit=10, detect=True, min_trades=10, stale=5_000_000_000, burst_k=20, burst_ns=1_000_000_000, sigma_ns=60_000_000_000, block=10_000):
    """rows: dicts in seq order. Returns the emitted bins: index, end, gap, final, mid, and the features in order."""
    bbo = None  # bid, ask, bid size, ask size, time
    out, state, quote_state = [], {}, {}
    last_burst, last_price, window, empty, now, bin_ = None, None, [], 0, 0, Bin()

    def bps(q):
        mid = (q[0] + q[1]) / 2
        return (q[1] - q[0]) / mid * 1e4

    def close(index, end, gap, final):
        nonlocal last_burst, bin_
        b = bin_
        ts = [t["ts"] for t in b.trf]
        if len(ts) >= burst_k:
            left = 0
            for right in range(len(ts)):
                while max(0, ts[right] - ts[left]) > burst_ns:
                    left += 1
                if right - left + 1 >= burst_k:
                    last_burst = ts[right]
        vol = lambda pick: float(sum(t["size"] for t in b.trades if pick(t)))
        side = lambda s, r=None: vol(lambda t: t["trf"] and t["dir"] == s and (r is None or t["retail"] == r))
        share = lambda a, c: a / max(c, 1e-8)
        buy, sell, rb, rs = side("Buy"), side("Sell"), side("Buy", "Retail"), side("Sell", "Retail")
        trf, lit, n, k = vol(lambda t: t["trf"]), vol(lambda t: t["lit"]), len(b.trades), len(b.trf)
        bvb, bvs = sum(t["bvb"] for t in b.trades), sum(t["bvs"] for t in b.trades)
        total = sum(t["size"] for t in b.trades)
        twap = weight = 0.0
        for (t0, s0, _), (t1, _, _) in zip(b.quotes, [*b.quotes[1:], (end, 0, 0)]):
            d = max(0, t1 - t0)
            twap, weight = twap + s0 * d, weight + d
        twap = twap / weight if weight >= 1e-8 else 0.0
        live = bps(bbo) if bbo else 0.0
        press = lambda i: (bbo[i] - b.quotes[0][2][i]) / b.quotes[0][2][i] if b.quotes and b.quotes[0][2][i] else 0.0
        gaps = [max(0, y - x) for x, y in zip(ts, ts[1:])]
        cv = 0.0
        if gaps and sum(gaps) / len(gaps) >= 1e-8:
            mean = sum(gaps) / len(gaps)
            cv = math.sqrt(max(0, sum(g * g for g in gaps) / len(gaps) - mean * mean)) / mean
        mid_ns = end - bin_ns // 2
        tod = (mid_ns - open_ns) // 1_000_000_000 + 34_200
        bucket = 5 if tod < 34_200 else 0 if tod < 34_500 else 1 if tod < 37_800 else 2 if tod < 54_000 else 3 if tod < 57_300 else 4 if tod < 57_600 else 5
        f = [share(buy - sell, buy + sell), share(rb - rs, rb + rs), -share(rb - rs, rb + rs) + 0.0, share(bvb - bvs, bvb + bvs)]
        f += [share(trf, trf + lit), trf, lit, trf + lit]
        f += [sum(t["sub"] for t in b.trf) / max(k, 1), sum(t["size"] < 100 for t in b.trf) / max(k, 1), sum(t["retail"] == "Retail" for t in b.trf) / max(k, 1), share(vol(lambda t: t["trf"] and t["retail"] == "Retail"), trf)]
        f += [twap if twap > 1e-8 else live, press(2), press(3), float(len(b.quotes)), share(bbo[2] - bbo[3], bbo[2] + bbo[3]) if bbo else 0.0, live - b.quotes[0][1] if b.quotes else 0.0]
        f += [0.0, 0.0, total / max(n, 1), sum(t["size"] >= block for t in b.trades) / max(n, 1), float(n), sum(t["size"] ** 2 for t in b.trades) / total**2 if total else 0.0]
        f += [cv, warmup * bin_ns / 1e9 if last_burst is None else max(0, end - last_burst) / 1e9, share(trf, lit), float(n), float(k)]
        f += [float(k >= min_trades), float(bool(bbo) and max(0, end - bbo[4]) <= stale), min(max(max(0, mid_ns - open_ns) / (close_ns - open_ns), 0), 1), float(bucket), 1.0]
        if not k:
            for i in (4, 8, 9, 11, 20, 21, 23, 26):
                f[i] = state.get(i, 0.0)
            if not b.quotes:
                for i in (12, 16):
                    f[i] = quote_state.get(i, 0.0)
        if not gap:
            if k:
                state.update(enumerate(f))
                quote_state.update(enumerate(f))
            if b.quotes:
                quote_state.update({12: f[12], 16: f[16]})
        active = bool(n or b.quotes)
        if index >= warmup:
            out.append((index, end, gap, final, (bbo[0] + bbo[1]) / 2 if bbo else 0.0, f))
        bin_ = Bin()
        return active

    stopped = False
    for r in rows:
        ts = r["ts_recv_ns"]
        if open_ns <= ts < close_ns and (i := (ts - open_ns) // bin_ns) > now:
            empty = 0 if close(now, open_ns + (now + 1) * bin_ns, False, False) else empty + 1
            now += 1
            if detect and empty >= gap_limit:
                stopped = True
                break
            while now < i:
                close(now, open_ns + (now + 1) * bin_ns, True, False)
                now, empty = now + 1, empty + 1
                if detect and empty >= gap_limit:
                    stopped = True
                    break
            if stopped:
                break
        bid, ask, inside = r["bid_px_nano"], r["ask_px_nano"], open_ns <= ts < close_ns
        if UNDEFINED not in (bid, ask) and bid > 0 and ask > 0 and bid * 1e-9 < ask * 1e-9:
            bbo = (bid * 1e-9, ask * 1e-9, r["bid_sz"], r["ask_sz"], ts)
            if inside:
                bin_.quotes.append((ts, bps(bbo), bbo))
        if r["action"] == "T" and inside and r["price_nano"] > 0 and r["price_nano"] != UNDEFINED:
            price, trf, lit = r["price_nano"] * 1e-9, r["publisher_id"] in TRF, r["publisher_id"] in LIT
            mid = (bbo[0] + bbo[1]) / 2 if bbo else 0
            width = bbo[1] - bbo[0] if bbo else 0
            direction = "Unsigned" if not (trf and bbo) else "Buy" if price > mid + 0.1 * width else "Sell" if price < mid - 0.1 * width else "Unsigned"
            frac = price * 100.0 % 1.0
            retail = "Institutional" if not trf else "Unknown" if not bbo else "Retail" if 0.001 < frac < 0.4 or 0.6 < frac < 0.999 else "Institutional"
            d = r["price_nano"] - last_price if last_price is not None else 0
            last_price = r["price_nano"]
            window.append((ts, d))
            while window and max(0, ts - window[0][0]) > sigma_ns:
                window.pop(0)
            m, s, q = len(window), sum(x for _, x in window), sum(x * x for _, x in window)
            sigma = math.sqrt(max(0, q * m - s * s) / (m * (m - 1))) * 1e-9 if m > 1 else 0.0
            p = phi(d * 1e-9 / sigma if sigma > 1e-8 else 0.0)
            t = {"ts": ts, "size": r["size"], "trf": trf, "lit": lit, "dir": direction, "retail": retail, "sub": trf and 0.001 < frac < 0.999, "bvb": r["size"] * p, "bvs": r["size"] * (1 - p)}
            bin_.trades.append(t)
            if trf:
                bin_.trf.append(t)
    if not stopped and (bin_.trades or bin_.quotes):
        close(now, close_ns, False, True)
    return out

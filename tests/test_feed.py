"""The binary feed: round trips, splits, bad records."""

import datetime
from pathlib import Path

import numpy as np
import pytest
import zstandard

from tickloom.schema import EVENTS
from tickloom.sources import feed
from test_day import stream


def events(spark, n=3):
    rows = [r | {"symbol": f"S{k}"} for k in range(n) for r in stream(60 + k, False)]
    return spark.createDataFrame([tuple(r[f.name] for f in EVENTS) for r in rows], EVENTS)


@pytest.mark.parametrize("split", [500, 1 << 26])
def test_round_trip(spark, tmp_path, split):
    df = events(spark).repartition(5)
    feed.write_feed(df, f"file://{tmp_path}", frame=50)
    found, report = feed.decoded(feed.read_feed(spark, f"file://{tmp_path}", split))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.collect()))
    assert {(r.decode_errors, r.decode_truncated) for r in report.collect()} == {(0, False)}
    parts = feed.FeedReader(str(tmp_path), split).partitions()
    assert len(parts) == sum(-(-p.stat().st_size // split) for p in Path(tmp_path).glob("*.feed"))


def broken(path, bad, n=6000, per=500):
    """A file of n records, those in bad with an unknown action."""
    import pyarrow as pa

    names = [f for f in feed.RECORD.names if f != "length"]
    with open(path, "wb") as f:
        out = feed.FeedFile(f, "S", datetime.date(2024, 1, 16))
        for at in range(0, n, per):
            k = np.arange(at, at + per)
            columns = {c: k for c in names} | {"publisher_id": k % 90, "flags": k * 0, "action": ["x" if i in bad else "T" for i in k.tolist()], "side": ["N"] * per}
            out.frame(pa.table({c: columns[c] for c in names}))
        out.close()


@pytest.mark.parametrize(("bad", "good", "errors", "cut"), [({3, 4, 1999}, 5997, 3, False), (set(range(700, 1699)), 5001, 999, False), (set(range(700, 1700)), 700, 1000, True), (set(range(700, 5000)), 700, 1000, True), (set(range(0, 999)) | set(range(1000, 2500)), 1, 1999, True)])
@pytest.mark.parametrize("split", [2000, 1 << 26])
def test_runs_of_bad_records_end_a_file_wherever_it_is_split(spark, tmp_path, bad, good, errors, cut, split):
    broken(tmp_path / "a.feed", bad)
    found, report = feed.decoded(feed.read_feed(spark, str(tmp_path), split))
    (r,) = report.collect()
    assert (found.count(), r.decode_errors, r.decode_truncated) == (good, errors, cut)


def test_lengths():
    rows = np.zeros(4, feed.RECORD)
    rows["length"], rows["action"], rows["side"], rows["seq"] = feed.RECORD.itemsize, b"T", b"N", [1, 2, 3, 4]
    raw = bytearray(rows.tobytes())
    short = raw[: feed.RECORD.itemsize] + b"\x05\x00abc" + raw[feed.RECORD.itemsize :]
    found, bad = feed.decoded_frame(bytes(short))
    assert bad.tolist() == [False, True, False, False, False] and found["seq"][~bad].tolist() == [1, 2, 3, 4]
    raw[feed.RECORD.itemsize : feed.RECORD.itemsize + 2] = b"\xff\xff"  # leads out of the frame
    found, bad = feed.decoded_frame(bytes(raw))
    assert bad.tolist() == [False, True]
    assert feed.decoded_frame(b"") [1].tolist() == []


def test_a_broken_frame_is_one_error_and_an_empty_folder_no_rows(spark, tmp_path):
    assert feed.read_feed(spark, str(tmp_path)).count() == 0
    broken(tmp_path / "a.feed", set(), n=1500)
    raw = bytearray((tmp_path / "a.feed").read_bytes())
    at = raw.index(zstandard.FRAME_HEADER)
    at = raw.index(zstandard.FRAME_HEADER, at + 4)  # the second frame
    raw[at + 4 : at + 40] = bytes(36)
    (tmp_path / "a.feed").write_bytes(raw)
    found, report = feed.decoded(feed.read_feed(spark, str(tmp_path)))
    assert found.count() == 1000 and report.first().decode_errors == 1

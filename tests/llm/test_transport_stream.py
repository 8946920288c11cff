import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import transport_stream as ts


@pytest.mark.parametrize("size", [0, 1, 575, 576, 577, 9215, 9216, 9217, 123_456])
def test_round_trip(size):
    payload = ts.padded(bytes(i * 7 % 251 for i in range(size)))
    media = ts.mux(payload)
    read = ts.demux(media)
    assert len(media) % 188 == 0 and read.payload == payload and read.continuity_errors == 0 and read.damaged == 0
    assert read.programs == {1: 0x1000} and read.streams == {0x100: 6}
    assert read.timestamps == [i * 3600 for i in range(-(-len(payload) // (576 * 16)))]
    assert [t for t, _ in read.random_access] == read.timestamps
    for pts, at in read.random_access:
        assert media[at] == 0x47 and media[at + 1] & 0x40


def test_counters_show_a_lost_and_ignore_a_repeated_packet():
    media = ts.mux(ts.padded(b"x" * 5000))
    assert ts.demux(media[: 188 * 5] + media[188 * 6 :]).continuity_errors == 1
    again = ts.demux(media[: 188 * 6] + media[188 * 5 :])
    assert again.continuity_errors == 0 and again.payload == ts.padded(b"x" * 5000)
    assert ts.demux(b"").payload == b"" and ts.demux(b"junk" * 100).damaged


def test_long_timestamps_survive():
    assert ts._stamp(2**33 - 1) == bytes([0x2F, 0xFF, 0xFF, 0xFF, 0xFF])
    assert ts.crc32_mpeg(b"123456789") == 0x0376E6E7


def test_table(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "é" * 400), (3, "é" * 400), (None, "x"), (5, "long " * 30_000)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("media", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    got = ts.op9_transport_stream(spark, str(tmp_path)).collect()
    assert len(got) == 6
    for r in got:
        text = next(t or "" for i, t in rows if i == r.doc_id).encode()
        payload = text + b"\xff" * (-len(text) % 576 if text else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert ts.to_media(spark.createDataFrame([], "doc_id long, text string")).count() == 0

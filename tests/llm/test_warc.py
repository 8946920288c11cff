import base64
import gzip
import hashlib
from pathlib import Path

from tickloom.llm import warc


def pages():
    rows = [(i, f"http://h.example/{i} x", f"<p>{i % 7}</p>" * 50) for i in range(40)]
    return rows + [(100, None, None), (101, "u", ""), (102, "u\r\nX: y", "é" * 500), (103, "u", "z" * 200_000), (39, "http://h.example/39 x", "<p>4</p>" * 50), (None, "n", "<p>4</p>" * 50), (None, "m", "only null"), (None, "m", "only null")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS sha1", "2 AS shard").repartition(3)


def test_round_trip(spark, tmp_path):
    rows = pages()
    found = warc.write_warc(frame(spark, rows), f"file://{tmp_path}/a", shard_bytes=4000, roll_bytes=600)
    assert len(found["files"]) > len({f["shard"] for f in found["files"]}) > 3
    got = warc.read_warc(spark, f"file://{tmp_path}/a", found).collect()
    assert len(got) == len(rows)
    by = {}
    for i, _, h in rows:
        by.setdefault(h or "", []).append(i)
    seen = {}
    for r in sorted(got, key=lambda r: r.record_type):
        text = next(h for h in by if base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(text.encode()) and r.page_id in by[text]
        ids = [i for i in by[text] if i is not None]
        if r.record_type == "response":
            assert r.payload.decode() == text and r.page_id == (max(ids) if ids else None) and r.refers_to is None
            seen[text] = seen.get(text, 0) + 1
        else:
            assert r.payload is None and r.refers_to == (max(ids) if ids else None)
    assert seen == dict.fromkeys(by, 1)
    order = [(f["shard"], f["name"]) for f in found["files"]]
    assert order == sorted(order)


def test_files_are_the_same_however_the_input_is_cut(spark, tmp_path):
    rows = pages()
    a = warc.write_warc(frame(spark, rows), f"{tmp_path}/a", shard_bytes=4000, roll_bytes=600)
    b = warc.write_warc(frame(spark, rows[::-1]).repartition(5), f"{tmp_path}/b", shard_bytes=4000, roll_bytes=600)
    assert a == b
    assert sorted(p.name for p in Path(f"{tmp_path}/a").iterdir() if p.suffix != ".crc") == sorted([*(f["name"] for f in a["files"]), "manifest.json"])
    for f in a["files"]:
        raw = Path(f"{tmp_path}/a/{f['name']}").read_bytes()
        assert len(raw) == f["bytes"] and hashlib.sha256(raw).hexdigest() == f["sha256"]
        assert gzip.decompress(raw).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_empty(spark, tmp_path):
    found = warc.write_warc(frame(spark, pages()).limit(0), f"{tmp_path}/e")
    assert found["files"] == [] and warc.read_warc(spark, f"{tmp_path}/e", found).count() == 0

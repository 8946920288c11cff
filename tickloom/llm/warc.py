"""Deterministic sharded WARC writer, and a reader.

Records are range-sorted by page identifier. The splitters come from a sample by hash, not by partition, so
shards and files are the same for the same pages however the input is cut. A shard's task rolls files by
compressed size. Headers, record identifiers and digests are generated anew from the content; every record is a
gzip member of its own with a fixed time. Files are written under temporary names that carry the task attempt;
the driver renames the files that successful tasks report, then commits the manifest, itself by renaming.
A lost executor leaves only temporary names, which the commit clears away.

Equal payloads are found by SHA-1 and length before any payload moves, in a table of identifiers and digests;
the payloads are shuffled once, to be sorted.

Defined results: a null payload is empty. Of equal payloads of at least least_bytes the record with the
largest identifier is a response and the others revisit it; null identifiers sort first and are never the
largest unless all are null. If rows repeat the response's identifier and payload, the first is the response.
A null address becomes urn:page:<id>. An empty table makes no shards, and a manifest that says so. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, remove, scratch_path, table, utf8, written

#: Uncompressed bytes of a shard, which one task sorts and writes: this share of all, within these bounds.
SHARD_SHARE, SHARD_LEAST, SHARD_MOST = 64, 8 << 20, 1 << 30
ROLL_BYTES, LEAST_BYTES = 128 << 20, 0
SAMPLES_EACH = 64
DATE = "2024-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6f0c5d1e-4d5b-5f6a-8f43-0d5b0f7a9c11")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest.json"


def opened(uri: str, mode: str):
    """A file of the shared folder, for tasks: a mounted path, or whatever store pyarrow knows."""
    if "://" not in uri or uri.startswith("file:"):
        return open(re.sub(r"^file:/*", "/", uri), mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(path) if "w" in mode else store.open_input_stream(path)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: int | None, digest: str, repeat: int = 0) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page}:{digest}:{repeat}')}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"WARC-Block-Digest: sha1:{base32_sha1(block)}\r\nContent-Length: {len(block)}\r\n\r\n"
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress(head.encode()) + packed.compress(block) + packed.compress(b"\r\n\r\n") + packed.flush()


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers: tuple[int | None] | None, repeat: int = 0) -> bytes:
    """One gzip member; refers: (the response's page,) for a revisit."""
    kind = "response" if refers is None else "revisit"
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page}"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page, digest, repeat)), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", str(page))]
    if refers is not None:
        fields += [("WARC-Profile", _REVISIT), ("WARC-Refers-To", _record_id(refers[0], digest)), ("X-Refers-To-Page-ID", str(refers[0]))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(fields, http + payload if refers is None else http)


def _writer(root: str, roll: int, prefix: str):
    """Sorted rows of whole shards to files; returns a row a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, files, out, now = TaskContext.get().taskAttemptId(), [], None, {}
        shard = seq = page = digest = refers = None
        repeat = 0

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                files.append(now | {"sha256": now["sha256"].hexdigest()})
                out = None

        def put(data: bytes) -> None:
            now["sha256"].update(data)
            now["bytes"] += len(data)
            out.write(data)

        def begin() -> None:
            nonlocal out, seq, now
            close()
            seq += 1
            name = f"{prefix}-{shard:06d}-{seq:05d}.warc.gz"
            now = {"shard": shard, "name": name, "temporary": f"_temporary/{name}.{attempt}", "bytes": 0, "records": 0, "sha256": hashlib.sha256()}
            out = opened(f"{root}/{now['temporary']}", "wb")
            info = f"software: tickloom\r\nformat: WARC File Format 1.1\r\nisPartOf: {prefix}\r\n".encode()
            put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>"), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], info))

        for batch in batches:
            for r_shard, r_page, r_sha, r_decision, r_refers, r_url, r_html in zip(*(batch.column(c).to_pylist() for c in ("shard", "page_id", "sha1", "decision", "refers_to", "url", "html")), strict=True):
                if r_shard != shard:
                    close()
                    shard, seq, page, digest = r_shard, -1, None, None
                if (r_page, r_sha) != (page, digest) or repeat < 0:
                    page, digest, refers, repeat = r_page, r_sha, None, 0
                if r_decision:  # sorts before the pages it is about
                    refers = (r_refers,)
                    continue
                if out is None or now["bytes"] >= roll:
                    begin()
                spec = refers if refers is not None or not repeat else (page,)
                put(record(page, r_url, r_html, base64.b32encode(bytes.fromhex(r_sha)).decode(), spec if len(r_html) >= LEAST_BYTES else None, repeat))
                now["records"] += 1
                repeat += 1
        close()
        if files:
            yield pa.RecordBatch.from_pylist(files, schema=pa.schema([("shard", pa.int64()), ("name", pa.string()), ("temporary", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()), ("sha256", pa.string())]))

    return run


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES, prefix: str = "pages") -> dict:
    """Writes pages below root and returns the committed manifest."""
    spark = pages.sparkSession
    page = F.col(f"`{id_col}`").cast("long").alias("page_id")
    light = written(pages.select(page, F.octet_length(utf8(html_col)).cast("long").alias("n"), F.sha1(utf8(html_col)).alias("sha1")), "digests")
    total = light.agg(F.sum("n").alias("n"), F.count("*").alias("rows")).first()
    shards = -(-(total.n or 0) // (shard_bytes or min(SHARD_MOST, max(SHARD_LEAST, (total.n or 0) // SHARD_SHARE)))) or 1
    sample = sorted(r[0] for r in light.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(shards * SAMPLES_EACH).collect()) if shards > 1 else []
    splitters = np.unique([sample[i * len(sample) // shards] for i in range(1, shards)]) if sample else np.zeros(0, np.int64)

    groups = light.groupBy("sha1", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("times")).where((F.col("times") > 1) & (F.col("n") >= LEAST_BYTES))
    revisits = light.join(groups, ["sha1", "n"]).where("page_id is null and refers_to is not null or page_id <> refers_to").select("page_id", "sha1", "refers_to").distinct()

    @F.pandas_udf("long")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.where(ids.isna(), 0, np.searchsorted(splitters, ids.fillna(0).to_numpy(np.int64), side="right")))

    rows = pages.select(page, F.sha1(utf8(html_col)).alias("sha1"), F.lit(False).alias("decision"), F.lit(None).cast("long").alias("refers_to"), F.col(f"`{url_col}`").cast("string").alias("url"), utf8(html_col).alias("html"))
    rows = rows.unionAll(revisits.select("page_id", "sha1", F.lit(True), "refers_to", F.lit(None).cast("string"), F.lit(None).cast("binary")))
    # A float keeps only 53 bits of a long with nulls, so shards are found by the identifier or 0, and nulls go first.
    shard = F.when(F.col("page_id").isNull(), F.lit(0)).otherwise(shard_of(F.coalesce("page_id", F.lit(0)))) if len(splitters) else F.lit(0)
    sharded = rows.withColumn("shard", shard.cast("long"))
    placed = sharded.repartitionById(len(splitters) + 1, F.col("shard").cast("int")).sortWithinPartitions("shard", "page_id", "sha1", F.col("decision").desc(), "url")
    make_folder(spark, f"{root}/_temporary")
    kinds = "shard long, name string, temporary string, bytes long, records long, sha256 string"
    files = sorted((r.asDict() for r in mapped(placed, _writer(root, roll_bytes, prefix), kinds).collect()), key=lambda f: f["name"])  # one row a file
    return _commit(spark, root, files, total.rows)


def make_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def _commit(spark: SparkSession, root: str, files: list[dict], rows: int) -> dict:
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in files:
        if not store.rename(path(f"{root}/{f['temporary']}"), path(f"{root}/{f['name']}")):
            raise OSError(f"could not commit {f['name']}")
    found = {"format": "WARC/1.1", "pages": rows, "records": sum(f["records"] for f in files), "files": [{k: f[k] for k in ("name", "shard", "records", "bytes", "sha256")} for f in files]}
    if found["records"] != rows:
        raise RuntimeError(f"{found['records']} records for {rows} pages")
    with_temporary = f"{root}/_temporary/{MANIFEST}"
    stream = store.create(path(with_temporary), True)
    stream.write(json.dumps(found, indent=1, sort_keys=True).encode())
    stream.close()
    store.rename(path(with_temporary), path(f"{root}/{MANIFEST}"))
    remove(spark, f"{root}/_temporary")
    return found


def members(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of a file; holds one record at a time."""
    raw = b""
    while True:
        raw = raw or stream.read(1 << 20)
        if not raw:
            return
        unpack, parts = zlib.decompressobj(31), []
        while True:
            parts.append(unpack.decompress(raw))
            raw = unpack.unused_data
            if unpack.eof:
                break
            if not (raw := stream.read(1 << 20)):
                raise EOFError("a record is cut off")
        data = b"".join(parts)
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def read_warc(spark: SparkSession, root: str, manifest: dict) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest, record_id, file); payload is null for revisits.

    Raises an error where a block or payload doesn't match its digest.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_id", pa.string()), ("file", pa.string())])
    number = lambda x: None if x in (None, "None") else int(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for name in (n for b in batches for n in b.column("name").to_pylist()):
            with opened(f"{root}/{name}", "rb") as stream:
                for fields, block in members(stream):
                    if base32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
                        raise ValueError(f"{name}: {fields['WARC-Record-ID']} is damaged")
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, revisit = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"] == "revisit"
                    if not revisit and base32_sha1(payload) != digest:
                        raise ValueError(f"{name}: {fields['WARC-Record-ID']} has another payload")
                    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    rows.append((number(fields["X-Page-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"], number(fields.get("X-Refers-To-Page-ID")), None if revisit else payload, size, digest, fields["WARC-Record-ID"], name))
                    held += len(block)
                    if len(rows) >= 2000 or held > 8 << 20:
                        yield batch_of(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)), schema)
                        rows, held = [], 0
        if rows:
            yield batch_of(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)), schema)

    names = [(f["name"],) for f in manifest["files"]]
    files = spark.createDataFrame(names, "name string").repartition(max(1, min(len(names), 10_000)))
    return mapped(files, run, "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, record_id string, file string")


def op2_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what the archives hold for each page."""
    root = scratch_path(spark, "warc")
    found = write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, root, found).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS first FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(digest, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""

"""Media columns: MPEG transport streams.

Each text's bytes are the access units of one elementary stream. They go into packetised elementary packets with presentation
timestamps, and those into 188-byte transport packets with program tables, continuity counters, clock
references and random-access marks. Reading parses the program tables, checks the counters, reassembles the
elementary packets and keeps timestamps with their random-access points.

Defined results: a null text counts as empty and is stored as one unit of 576 bytes of 255. Equal texts give
equal streams. A stream with lost, repeated or damaged packets is read as far as it goes and says how many
continuity errors it has. Null identifiers, repeated rows and empty tables pass through; extra columns are
ignored. Rows are independent: there is no shuffle, and a task holds one Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8

# Fixed values of ISO/IEC 13818-1.
PACKET, SYNC, PAT_PID, STUFFING = 188, 0x47, 0x0000, 0xFF
PRIVATE_DATA, PRIVATE_STREAM_1 = 0x06, 0xBD
CLOCK = 90_000

# Our own choices.
PMT_PID, ES_PID, PROGRAM = 0x1000, 0x0100, 1
UNIT = 576  # the payload is padded to a multiple of it
UNITS_EACH = 16  # units in an access unit, which gets one timestamp
TICKS_EACH = CLOCK // 25


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else c << 1 & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, extension: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + extension.to_bytes(2, "big") + b"\xc1\x00\x00"
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    head = bytes([SYNC]) + (0x4000 | pid).to_bytes(2, "big") + b"\x10\x00"
    return (head + section).ljust(PACKET, bytes([STUFFING]))


_TABLES = _table_packet(PAT_PID, _section(0, 1, PROGRAM.to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))) + _table_packet(
    PMT_PID, _section(2, PROGRAM, (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | ES_PID).to_bytes(2, "big") + b"\xf0\x00")
)


def _stamp(pts: int) -> bytes:
    pts &= (1 << 33) - 1
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, pts >> 14 & 0xFE | 1, pts >> 7 & 0xFF, pts << 1 & 0xFE | 1])


def _packets(data: bytes, counter: int, clock: int) -> np.ndarray:
    """Transport packets of one elementary packet; the first is a random-access point and carries the clock."""
    lead = b"\x07\x50" + (clock << 15 | 0x7E00).to_bytes(6, "big")
    first, rest = PACKET - 4 - len(lead), PACKET - 4
    count = 1 + -(-max(0, len(data) - first) // rest)
    out = np.full((count, PACKET), STUFFING, np.uint8)
    out[:, 0], out[:, 1], out[:, 2] = SYNC, ES_PID >> 8, ES_PID & 0xFF
    out[0, 1] |= 0x40
    out[:, 3] = 0x10 | (counter + np.arange(count)) & 15
    out[0, 3] |= 0x20
    out[0, 4 : 4 + len(lead)] = np.frombuffer(lead, np.uint8)
    raw = np.frombuffer(data, np.uint8)
    out[0, PACKET - first :] = raw[:first]
    whole = (len(data) - first) // rest
    if whole:
        out[1 : 1 + whole, 4:] = raw[first : first + whole * rest].reshape(whole, rest)
    if left := (len(data) - first) % rest:
        out[-1, 3] |= 0x20
        out[-1, 4] = rest - left - 1
        if rest - left > 1:
            out[-1, 5] = 0
        out[-1, PACKET - left :] = raw[len(data) - left :]
    return out


def mux(payload: bytes) -> bytes:
    """A transport stream that holds payload, whose length is a positive multiple of UNIT."""
    parts, counter = [_TABLES], 0
    for n, at in enumerate(range(0, len(payload), UNIT * UNITS_EACH)):
        unit = payload[at : at + UNIT * UNITS_EACH]
        pts = n * TICKS_EACH
        packets = _packets(b"\x00\x00\x01" + bytes([PRIVATE_STREAM_1]) + (len(unit) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(pts) + unit, counter, pts)
        counter += len(packets)
        parts.append(packets.tobytes())
    return b"".join(parts)


@dataclass
class Stream:
    """What demux() finds."""

    payload: bytes = b""
    programs: dict[int, int] = field(default_factory=dict)  # program: its table's PID
    streams: dict[int, int] = field(default_factory=dict)  # PID: stream type
    timestamps: list[int] = field(default_factory=list)
    random_access: list[tuple[int, int]] = field(default_factory=list)  # (timestamp, byte offset of the packet)
    continuity_errors: int = 0
    damaged: int = 0


def _sections(packets: np.ndarray, pid: int, pids: np.ndarray) -> Iterator[bytes]:
    for p in packets[pids == pid]:
        raw = p.tobytes()
        if not raw[1] & 0x40 or not raw[3] & 0x10:
            continue
        at = 4 + (1 + raw[4] if raw[3] & 0x20 else 0)
        at += 1 + raw[at] if at < PACKET else 0
        if at + 3 > PACKET:
            continue
        size = 3 + (int.from_bytes(raw[at + 1 : at + 3], "big") & 0xFFF)
        if at + size <= PACKET and crc32_mpeg(raw[at : at + size]) == 0:
            yield raw[at : at + size]


def demux(media: bytes) -> Stream:
    """Reads the first elementary stream of the first program."""
    out = Stream()
    packets = np.frombuffer(media, np.uint8)[: len(media) // PACKET * PACKET].reshape(-1, PACKET)
    good = packets[:, 0] == SYNC
    out.damaged = int(len(packets) - good.sum()) + bool(len(media) % PACKET)
    offsets = np.arange(len(packets))[good] * PACKET
    packets = packets[good]
    pids = (packets[:, 1].astype(np.int32) & 0x1F) << 8 | packets[:, 2]
    for s in _sections(packets, PAT_PID, pids):
        out.programs |= {n: int.from_bytes(s[k + 2 : k + 4], "big") & 0x1FFF for k in range(8, len(s) - 4, 4) if (n := int.from_bytes(s[k : k + 2], "big"))}
    for pid in dict.fromkeys(out.programs.values()):
        for s in _sections(packets, pid, pids):
            k = 12 + (int.from_bytes(s[10:12], "big") & 0xFFF)
            while k + 5 <= len(s) - 4:
                out.streams[int.from_bytes(s[k + 1 : k + 3], "big") & 0x1FFF] = s[k]
                k += 5 + (int.from_bytes(s[k + 3 : k + 5], "big") & 0xFFF)
    if not out.streams:
        return out
    mine = pids == next(iter(out.streams))
    mine &= packets[:, 3] & 0x10 > 0
    packets, offsets = packets[mine], offsets[mine]
    if not len(packets):
        return out
    counters = packets[:, 3].astype(np.int16) & 15
    steps = (counters[1:] - counters[:-1]) % 16
    repeated = np.concatenate([[False], (steps == 0) & (packets[1:] == packets[:-1]).all(axis=1)])
    out.continuity_errors = int(((steps != 1) & ~repeated[1:]).sum())
    packets, offsets = packets[~repeated], offsets[~repeated]
    adapted = packets[:, 3] & 0x20 > 0
    begins = np.minimum(4 + np.where(adapted, 1 + packets[:, 4].astype(np.int32), 0), PACKET)
    marked = adapted & (packets[:, 4] > 0) & (packets[:, 5] & 0x40 > 0)
    body = packets[np.arange(PACKET) >= begins[:, None]].tobytes()
    ends = np.cumsum(PACKET - begins)
    opens = np.flatnonzero(packets[:, 1] & 0x40)
    edges = [*(ends[opens] - (PACKET - begins[opens])).tolist(), len(body)]
    parts = []
    for k, first in enumerate(opens.tolist()):
        pes = body[edges[k] : edges[k + 1]]
        if pes[:3] != b"\x00\x00\x01" or len(pes) < 9 or len(pes) < 9 + pes[8]:
            out.damaged += 1
            continue
        size = int.from_bytes(pes[4:6], "big")
        if pes[7] & 0x80:
            t = pes[9:14]
            pts = (t[0] & 0x0E) << 29 | t[1] << 22 | (t[2] & 0xFE) << 14 | t[3] << 7 | t[4] >> 1
            out.timestamps.append(pts)
            if marked[first]:
                out.random_access.append((pts, int(offsets[first])))
        parts.append(pes[9 + pes[8] : 6 + size if size else len(pes)])
    out.payload = b"".join(parts)
    return out


def padded(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // UNIT)) * UNIT, b"\xff")


def features(s: Stream) -> str:
    """Program layout, timing and the byte statistics of what was read back."""
    raw = np.frombuffer(s.payload, np.uint8)
    share = np.bincount(raw, minlength=256) / max(1, len(raw))
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    layout = ",".join(f"{p}:{t}" for p, t in sorted(s.streams.items()))
    return f"es={layout};pes={len(s.timestamps)};rap={len(s.random_access)};pts={s.timestamps[0] if s.timestamps else -1}-{s.timestamps[-1] if s.timestamps else -1};cc={s.continuity_errors};mean={raw.mean() if len(raw) else 0:.4f};entropy={entropy:.4f}"


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text stored as a transport stream."""
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch_of({"id": batch.column("id"), "n_bytes": pa.array(map(len, texts), pa.int64()), "media": pa.array([mux(padded(t)) for t in texts], pa.binary())}, schema)

    return mapped(own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text")), run, "id long, n_bytes long, media binary")


def from_media(media: DataFrame) -> DataFrame:
    """to_media()'s rows read back: the payload and what the stream says of it."""
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("n_bytes", pa.int64()),
            ("payload", pa.binary()),
            ("media_bytes", pa.int64()),
            ("media_sha256", pa.string()),
            ("streams", pa.list_(pa.struct([("pid", pa.int32()), ("kind", pa.int32())]))),
            ("timestamps", pa.list_(pa.int64())),
            ("random_access", pa.list_(pa.struct([("pts", pa.int64()), ("offset", pa.int64())]))),
            ("continuity_errors", pa.int64()),
            ("feature", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("media").to_pylist()
            read = [demux(m) for m in raw]
            yield batch_of(
                {
                    "id": batch.column("id"),
                    "n_bytes": batch.column("n_bytes"),
                    "payload": [s.payload for s in read],
                    "media_bytes": [len(m) for m in raw],
                    "media_sha256": [hashlib.sha256(m).hexdigest() for m in raw],
                    "streams": [[{"pid": p, "kind": t} for p, t in s.streams.items()] for s in read],
                    "timestamps": [s.timestamps for s in read],
                    "random_access": [[{"pts": t, "offset": o} for t, o in s.random_access] for s in read],
                    "continuity_errors": [s.continuity_errors for s in read],
                    "feature": [features(s) for s in read],
                },
                schema,
            )

    kinds = "id long, n_bytes long, payload binary, media_bytes long, media_sha256 string, streams array<struct<pid:int,kind:int>>, timestamps array<long>, random_access array<struct<pts:long,offset:long>>, continuity_errors long, feature string"
    return mapped(media, run, kinds)


def op9_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document stored and read back."""
    read = from_media(to_media(table(spark, sf_dir, "documents")))
    return read.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, -32, 32)")).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        "continuity_errors",
        F.size("random_access").cast("long").alias("random_access_points"),
    )

"""A binary feed of events: one file a day of a symbol, in compressed frames that can be read apart.

A file is a header (symbol and day as JSON), frames, an index of the frames and the index's length. A frame is one zstandard block of
length-prefixed records. Readers split a file by bytes: a task takes the frames that begin in its range, found by the index, so a
day of any size is spread over tasks and no task reads more than its part.

A record that can't be decoded is a row too, with bad set and its place in the file. A reader gives up its part after MOST_ERRORS of them
in a row, and decoded() cuts each file off where such a run ends, also when the run lies across parts.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tickloom.schema import DAY, EVENTS
from tickloom.sources.files import MOST_ERRORS
from tickloom.sources.stores import opened

FORMAT, SUFFIX, MAGIC = "tickloom_feed", ".feed", b"TLF1"
#: Records of a frame, and bytes of a file that a task reads.
FRAME, SPLIT = 65_536, 64 << 20
ACTIONS, SIDES = "TACMRF", "ABN"
RECORD = np.dtype(
    [("length", "<u2"), ("seq", "<i8"), ("ts_event_ns", "<i8"), ("ts_recv_ns", "<i8"), ("price_nano", "<i8"), ("bid_px_nano", "<i8"), ("ask_px_nano", "<i8"), ("size", "<u4"), ("bid_sz", "<u4"), ("ask_sz", "<u4"), ("publisher_id", "<u2"), ("action", "S1"), ("side", "S1"), ("flags", "u1")]
)
SCHEMA = T.StructType([*EVENTS.fields, T.StructField("file", T.StringType()), T.StructField("ordinal", T.LongType()), T.StructField("bad", T.BooleanType())])


def encoded(frame: pa.Table) -> bytes:
    out = np.zeros(frame.num_rows, RECORD)
    out["length"] = RECORD.itemsize
    for name in RECORD.names[1:]:
        out[name] = frame.column(name).to_numpy() if name not in ("action", "side") else np.array(frame.column(name).to_pylist(), "S1")
    return out.tobytes()


def decoded_frame(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(records, bad): all records of a frame in order. A wrong length loses the record it is of; one that leads out of the frame, the rest."""
    n = len(raw) // RECORD.itemsize
    whole = np.frombuffer(raw, RECORD, n)
    if len(raw) != n * RECORD.itemsize or (whole["length"] != RECORD.itemsize).any():
        parts, at = [], 0
        while at < len(raw):
            size = struct.unpack_from("<H", raw, at)[0] if at + 2 <= len(raw) else 0
            if size < 2 or at + size > len(raw):
                parts.append(np.zeros(1, RECORD))
                break
            parts.append(np.frombuffer(raw, RECORD, 1, at) if size == RECORD.itemsize else np.zeros(1, RECORD))
            at += size
        whole = np.concatenate(parts) if parts else np.zeros(0, RECORD)
    known = np.isin(whole["action"], np.array([*ACTIONS], "S1")) & np.isin(whole["side"], np.array([*SIDES], "S1"))
    return whole, ~known | (whole["length"] != RECORD.itemsize)


class FeedFile:
    """Writes one file: frames as they fill, then the index."""

    def __init__(self, out, symbol: str, day: date):
        self.out, self.index, self.at, self.records = out, [], 0, 0
        header = json.dumps({"symbol": symbol, "trade_date": day.isoformat()}).encode()
        self._put(MAGIC + struct.pack("<I", len(header)) + header)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def frame(self, rows: pa.Table) -> None:
        block = zstandard.ZstdCompressor(level=3).compress(encoded(rows))
        self.index.append((self.at, len(block), self.records))
        self.records += rows.num_rows
        self._put(block)

    def close(self) -> None:
        index = np.array(self.index, "<i8").tobytes()
        self._put(index + struct.pack("<q", len(index)) + MAGIC)
        self.out.close()


@dataclass
class Part(InputPartition):
    path: str
    low: int
    high: int

    def __init__(self, path: str, low: int, high: int):
        super().__init__((path, low, high))
        self.path, self.low, self.high = path, low, high


@dataclass
class Files(WriterCommitMessage):
    names: list[str] = field(default_factory=list)


class Feed(DataSource):
    """Options: path, a folder, a file or several as a JSON list; split, the bytes that a task reads; frame, the records of a frame."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> FeedReader:
        return FeedReader(self.options["path"], int(self.options.get("split", SPLIT)))

    def writer(self, schema: T.StructType, overwrite: bool) -> FeedWriter:
        return FeedWriter(self.options["path"], int(self.options.get("frame", FRAME)))


class FeedReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Part]:
        """Byte ranges by the files' sizes; no file is opened here."""
        found: list[tuple[str, int]] = []
        for uri in json.loads(self.path) if self.path.startswith("[") else [self.path]:
            store, base = opened(uri)
            at = store.get_file_info(base)
            inside = store.get_file_info(fs.FileSelector(base)) if at.type == fs.FileType.Directory else [at]
            top = uri.rstrip("/") if at.type == fs.FileType.Directory else uri.rstrip("/").rpartition("/")[0]
            found += [(f"{top}/{f.base_name}", f.size) for f in inside if f.path.endswith(SUFFIX)]
        return [Part(p, at, at + self.split) for p, size in sorted(found) for at in range(0, size, self.split)] or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        store, path = opened(partition.path)
        with store.open_input_file(path) as f:
            size = f.size()
            head = f.read_at(8, 0)
            about = json.loads(f.read_at(struct.unpack("<I", head[4:])[0], 8))
            tail = struct.unpack("<q", f.read_at(12, size - 12)[:8])[0]
            index = np.frombuffer(f.read_at(tail, size - 12 - tail), "<i8").reshape(-1, 3)
            run = 0
            for at, length, first in index[(index[:, 0] >= partition.low) & (index[:, 0] < partition.high)].tolist():
                records, bad = self._frame(f.read_at(length, at))
                # The run of bad records up to each one, going on from the frame before.
                place = np.arange(len(bad))
                good_at = np.maximum.accumulate(np.where(bad, -1, place))
                runs = np.where(good_at < 0, run + place + 1, place - good_at) * bad
                over = np.flatnonzero(runs >= MOST_ERRORS)
                keep = int(over[0]) + 1 if len(over) else len(bad)
                if keep:
                    yield self._batch(records[:keep], bad[:keep], about, partition.path, first)
                if len(over):
                    return
                run = int(runs[-1]) if len(runs) else run

    def _frame(self, block: bytes) -> tuple[np.ndarray, np.ndarray]:
        try:
            return decoded_frame(zstandard.ZstdDecompressor().decompress(block))
        except zstandard.ZstdError:
            return np.zeros(1, RECORD), np.ones(1, bool)

    def _batch(self, records: np.ndarray, bad: np.ndarray, about: dict, path: str, first: int) -> pa.RecordBatch:
        n = len(records)
        columns = {"symbol": pa.array([about["symbol"]] * n), "trade_date": pa.array([date.fromisoformat(about["trade_date"])] * n), "file": pa.array([path.rpartition("/")[2]] * n), "ordinal": pa.array(first + np.arange(n)), "bad": pa.array(bad)}
        for name in RECORD.names[1:]:
            values = records[name]
            text = values.dtype.kind == "S"
            columns[name] = pa.array(values.astype("U1") if text else np.ascontiguousarray(values), mask=bad)
        arrow = {T.StringType(): pa.string(), T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DateType(): pa.date32(), T.BooleanType(): pa.bool_()}
        return pa.RecordBatch.from_arrays([columns[f.name].cast(arrow[f.dataType]) for f in SCHEMA], names=SCHEMA.names)


class FeedWriter(DataSourceArrowWriter):
    """Rows have to come by DAY, in order of seq: a file is written as its rows come and closed when the next day's begin. A day that is there already is replaced."""

    def __init__(self, path: str, frame: int):
        self.path, self.per_frame = path, frame

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        store, base = opened(self.path)
        store.create_dir(base, recursive=True)
        done, file, key, waiting = Files(), None, None, None
        columns = [n for n in RECORD.names[1:]]

        def end() -> None:
            if file is not None:
                if waiting.num_rows:
                    file.frame(waiting)
                file.close()

        for batch in iterator:
            rows = pa.Table.from_batches([batch])
            keys = list(zip(rows.column("symbol").to_pylist(), rows.column("trade_date").to_pylist(), strict=True))
            at = 0
            while at < len(keys):
                stop = next((k for k in range(at, len(keys)) if keys[k] != keys[at]), len(keys))
                if keys[at] != key:
                    end()
                    key, waiting = keys[at], rows.select(columns).slice(0, 0)
                    done.names.append(f"{base}/{key[0]}_{key[1]:%Y%m%d}-{uuid.uuid4().hex}")
                    file = FeedFile(store.open_output_stream(f"{done.names[-1]}.tmp"), *key)
                waiting = pa.concat_tables([waiting, rows.select(columns).slice(at, stop - at)])
                while waiting.num_rows >= self.per_frame:
                    file.frame(waiting.slice(0, self.per_frame))
                    waiting = waiting.slice(self.per_frame)
                at = stop
        end()
        return done

    def commit(self, messages: list[Files | None]) -> None:
        store, _ = opened(self.path)
        for name in (n for m in messages if m for n in m.names):
            store.move(f"{name}.tmp", f"{name.rpartition('-')[0]}{SUFFIX}")

    def abort(self, messages: list[Files | None]) -> None:
        store, base = opened(self.path)
        for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if f.path.endswith(".tmp"):
                store.delete_file(f.path)


def write_feed(events: DataFrame, path: str, frame: int = FRAME) -> None:
    """events as feed files below path, a file for each day of a symbol."""
    events.sparkSession.dataSource.register(Feed)
    placed = events.select(*EVENTS.names).repartition(*DAY).sortWithinPartitions(*DAY, "seq")
    placed.write.format(FORMAT).mode("append").option("path", path).option("frame", str(frame)).save()


def read_feed(spark: SparkSession, path: str | list[str], split: int = SPLIT) -> DataFrame:
    """All records of a feed file, of all in a folder, or of several of either; bad ones too."""
    spark.dataSource.register(Feed)
    path = path if isinstance(path, str) else json.dumps(path)
    return spark.read.format(FORMAT).option("path", path).option("split", str(split)).load()


def decoded(records: DataFrame, most: int = MOST_ERRORS) -> tuple[DataFrame, DataFrame]:
    """(events, DAY with decode_errors and decode_truncated): files end with their first run of `most` bad records.

    Only bad records are looked at for the runs, and the cuts are a row a file at most.
    """
    bad = records.where("bad").select(*DAY, "file", "ordinal")
    order = Window.partitionBy("file").orderBy("ordinal")
    runs = bad.withColumn("island", F.col("ordinal") - F.row_number().over(order))
    in_run = F.row_number().over(Window.partitionBy("file", "island").orderBy("ordinal"))
    cuts = runs.withColumn("run", in_run).where(F.col("run") == most).groupBy("file").agg(F.min("ordinal").alias("cut"))
    kept = records.join(cuts, "file", "left").where(F.col("cut").isNull() | (F.col("ordinal") <= F.col("cut")))
    report = kept.groupBy(*DAY).agg(F.count_if("bad").alias("decode_errors"), F.max(F.col("cut").isNotNull()).alias("decode_truncated"))
    return kept.where("not bad").select(*EVENTS.names), report

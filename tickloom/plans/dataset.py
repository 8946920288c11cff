"""The dataset as a transactional sink: tasks write days' files to a staging folder, the commit moves them and publishes the manifest.

`df.write.format("tickloom_dataset")` takes one row a day of a symbol. A task puts each day's files under names of its own and
moves them into the staging folder only when all six are there; another attempt at a task writes the same files again. What
a task did goes to the commit as its message. The commit moves each split into place and writes the manifest last, so a dataset
is there when its manifest is. An abort takes the staging folder away, whatever has happened.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tickloom.config import Config
from tickloom.sources.stores import opened, put

FORMAT, STAGING = "tickloom_dataset", "_staging"
ARRAYS = {"sequences.npy": "<f4", "labels.npy": "<f8", "forward_prices.npy": "<f8"}
DOCUMENTS = ("metadata.json", "normalization.json", "diagnostics.json")
KINDS = (*ARRAYS, *DOCUMENTS)


@dataclass
class Days(WriterCommitMessage):
    """What one task did: a status a day."""

    status: list[dict] = field(default_factory=list)


def as_npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array)
    return out.getvalue()


def stage(root: str, split: str, name: str, arrays: dict[str, np.ndarray], documents: dict[str, dict]) -> dict[str, str]:
    """Stages a day's six files below root, all or none, and gives their digests. Without sequences nothing is written."""
    if not len(arrays["sequences.npy"]):
        return {}
    store, base = opened(root)
    own, folder = f"{base}/{STAGING}/attempts/{uuid.uuid4().hex}", f"{base}/{STAGING}/{split}"
    store.create_dir(own, recursive=True)
    digests: dict[str, str] = {}
    try:
        for kind, array in arrays.items():
            if kind != "forward_prices.npy" and not np.isfinite(array).all():
                raise ValueError(f"{name}_{kind}: a value is not finite")
        contents = {k: as_npy(a.astype(ARRAYS[k])) for k, a in arrays.items()} | {k: json.dumps(d, indent=1, sort_keys=True).encode() for k, d in documents.items()}
        for kind, data in contents.items():
            digests[kind] = hashlib.sha256(data).hexdigest()
            with store.open_output_stream(f"{own}/{kind}") as out:
                out.write(data)
        store.create_dir(folder, recursive=True)
        for kind in contents:
            store.move(f"{own}/{kind}", f"{folder}/{name}_{kind}")
    finally:
        store.delete_dir(own)
    return digests


def manifest_of(rows: list[dict], cfg: Config, more: dict | None = None) -> dict:
    """The manifest of status rows (symbol, trade_date, split, n_sequences, error, digests). A day without sequences is a day, and is listed as such."""
    ok = sorted((r for r in rows if r["error"] is None), key=lambda r: (r["trade_date"], r["symbol"]))
    splits: dict[str, dict] = {}
    for r in ok:
        s = splits.setdefault(r["split"], {"n_days": 0, "n_sequences": 0, "first_date": r["trade_date"], "last_date": "", "days": []})
        s["n_days"] += 1
        s["n_sequences"] += r["n_sequences"]
        s["last_date"] = r["trade_date"]
        s["days"].append(r["trade_date"])
    failed = sorted(({"day": r["trade_date"], "error": r["error"]} for r in rows if r["error"] is not None), key=lambda f: f["day"])
    names = {f"{r['symbol']}_{r['trade_date'].replace('-', '')}": r for r in ok if r["digests"]}
    return {
        "experiment": cfg.export.experiment,
        "symbol": cfg.input.symbol,
        "config_hash": cfg.hash(),
        "split_dates": list(cfg.export.split_dates),
        "sequence_length": cfg.sequence.window_size,
        "stride": cfg.sequence.stride,
        "bin_size_seconds": cfg.sampling.bin_size_seconds,
        "horizons": list(cfg.labeling.horizons),
        "labeling_strategy": cfg.labeling.label_type,
        "normalization": cfg.export.normalization,
        "splits": splits,
        "days_processed": len(ok),
        "failed_days": failed,
        "zero_sequence_days": [r["trade_date"] for r in ok if not r["n_sequences"]],
        "diagnostics_files": [f"{r['split']}/{n}_diagnostics.json" for n, r in names.items()],
        "digests": {n: r["digests"] for n, r in names.items()},
        "total_sequences": sum(r["n_sequences"] for r in ok),
        "complete": not failed,
    } | (more or {})


class DatasetSink(DataSource):
    """Options: root, config (a Config as JSON)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DatasetWriter:
        return DatasetWriter(self.options["root"], self.options["config"])


class DatasetWriter(DataSourceArrowWriter):
    def __init__(self, root: str, config: str):
        self.root, self.config = root, config

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Days:
        from tickloom.plans.export import documents_of

        cfg = Config.from_dict(json.loads(self.config))
        done = Days()
        for batch in iterator:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names if c != "rows"}
                status = {"symbol": row["symbol"], "trade_date": f"{row['trade_date']:%Y-%m-%d}", "split": row["split"], "n_sequences": 0, "error": None, "digests": {}}
                try:
                    arrays = arrays_of(batch.column("rows").slice(k, 1), cfg)
                    found = len(arrays["sequences.npy"])
                    status["digests"] = stage(self.root, row["split"], f"{row['symbol']}_{row['trade_date']:%Y%m%d}", arrays, documents_of(row, found, cfg))
                    status["n_sequences"] = found
                except Exception as e:
                    if not cfg.export.continue_on_error:
                        raise
                    status["error"] = str(e)[:500]
                done.status.append(status)
        return done

    def commit(self, messages: list[Days | None]) -> None:
        from tickloom.plans import manifest
        from tickloom.plans.export import written_by

        store, base = opened(self.root)
        rows = [r for m in messages if m is not None for r in m.status]
        staged = [f for f in store.get_file_info(fs.FileSelector(f"{base}/{STAGING}", allow_not_found=True)) if f.base_name != "attempts"]
        for folder in staged:  # one a split
            target = f"{base}/{folder.base_name}"
            if store.get_file_info(target).type == fs.FileType.NotFound:
                store.move(folder.path, target)
                continue
            with ThreadPoolExecutor(16) as pool:
                list(pool.map(lambda f, to=target: store.move(f.path, f"{to}/{f.base_name}"), store.get_file_info(fs.FileSelector(folder.path))))
        self._clear()
        found = manifest_of(rows, Config.from_dict(json.loads(self.config)), written_by())
        put(f"{self.root.rstrip('/')}/{manifest.NAME}", json.dumps(found, indent=1, sort_keys=True).encode())

    def abort(self, messages: list[Days | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        store, base = opened(self.root)
        if store.get_file_info(f"{base}/{STAGING}").type != fs.FileType.NotFound:
            store.delete_dir(f"{base}/{STAGING}")


def arrays_of(rows: pa.Array, cfg: Config) -> dict[str, np.ndarray]:
    """A day's arrays from its sequences: the lists' values are laid out in order, so they are reshaped, not walked."""
    n = len(rows.values.slice(rows.offsets[0].as_py(), rows.offsets[1].as_py() - rows.offsets[0].as_py())) if rows[0].is_valid else 0
    shapes = {"sequences.npy": (n, cfg.sequence.window_size, -1), "labels.npy": (n, len(cfg.labeling.horizons)), "forward_prices.npy": (n, max(cfg.labeling.horizons) + 1)}
    if not n:
        return {k: np.empty((0, *[max(d, 0) for d in s[1:]])) for k, s in shapes.items()}
    items = rows.flatten()
    flat = {"sequences.npy": items.field("sequence").flatten().flatten(), "labels.npy": items.field("labels").flatten(), "forward_prices.npy": items.field("forward_prices").flatten()}
    return {k: v.to_numpy(zero_copy_only=False).astype(np.float64).reshape(shapes[k]) for k, v in flat.items()}

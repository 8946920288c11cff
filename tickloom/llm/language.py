"""Language identification by nearest centroid.

A document is the TF-IDF vector of its hashed letter n-grams, with unit length. Each language has several
centroids, from spherical k-means over its training documents, as one language is written in more than one
way. The language of the nearest centroid by cosine is predicted; a document farther from its centroid than
nearly all of that language's training documents is marked as rejected.

Fitted on a bounded sample: of each language the documents of least hash outside the held-out fold, TRAIN_ROWS
in all. All documents are classified, whole, in one scan, by a model of fixed size.

Defined results: a null text and one without a letter are "und" with score 0. So is every text if nothing
could be learned (no labelled rows); with one language, all texts with letters get it. Null identifiers are
classified, not held out, and not learned from. Repeated rows count row by row. An empty table gives an empty
table. Extra columns are ignored. Ties go to the language first by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, discard, mapped, own_columns, table, utf8, written
from tickloom.llm.quality import fold

#: Training documents of all languages together; each language has at least one, the most frequent languages first.
TRAIN_ROWS = 4000
BUCKETS, CENTROIDS, ROUNDS = 1 << 12, 4, 12
FOLDS, HELD_FOLD = 4, 2
#: Share of a language's training documents that its distance limit accepts.
ACCEPTED = 0.995


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: bytes) -> np.ndarray | None:
    """Counts of hashed 1- to 3-grams of the lower-cased letters, with word edges; None without a letter.

    Texts are gone through in overlapping chunks, so that a very long one takes no more memory.
    """
    out, seen, tail = np.zeros(BUCKETS, np.float32), False, np.zeros(1, np.uint32)
    lowered = text.decode("utf-8", "replace").lower()
    for at in range(0, len(lowered), 1 << 20):
        c = np.frombuffer(lowered[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters()[np.minimum(c, 0x10FFFF)]
        seen |= bool(letter.any())
        k = len(tail)
        c = np.concatenate([tail, np.where(letter, c, 0).astype(np.uint32)])
        c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])]  # word edges are single
        h = c[:-1] * np.uint32(0x9E3779B1) ^ c[1:] * np.uint32(0x85EBCA77)
        h3 = h[:-1] * np.uint32(0xC2B2AE3D) ^ c[2:] * np.uint32(0x27D4EB2F)
        for x in (c[k:] * np.uint32(0x165667B1), h[k - 1 :], h3[max(0, k - 2) :]):  # those that end in this chunk
            x = x ^ x >> np.uint32(15)
            out += np.bincount((x * np.uint32(0x2C1B3C6D)) >> np.uint32(20), minlength=BUCKETS)
        tail = c[-2:]
    return out if seen else None


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _centroids(x: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Spherical k-means; starts from documents far from those already taken."""
    rng = np.random.Generator(np.random.PCG64(seed))
    taken = [x[rng.integers(len(x))]]
    while len(taken) < min(count, len(x)):
        far = 1 - np.max(x @ np.array(taken).T, axis=1)
        if far.max() < 1e-6:
            break
        taken.append(x[int(np.argmax(far * rng.random(len(x))))])
    c = np.array(taken)
    for _ in range(ROUNDS):
        mine = np.argmax(x @ c.T, axis=1)
        c = _unit(np.array([x[mine == k].sum(0) if (mine == k).any() else c[k] for k in range(len(c))]))
    return c


class Model:
    """idf, the centroids with their language, and the distance each language accepts."""

    def __init__(self, counts: np.ndarray, langs: list[str]):
        self.idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
        x = self.vectors(counts)
        names = np.array(langs, object)
        self.langs, centroids, owner, self.limit = sorted(set(langs)), [], [], []
        for k, lang in enumerate(self.langs):
            mine = x[names == lang]
            found = _centroids(mine, CENTROIDS, k)
            centroids.append(found)
            owner += [k] * len(found)
            self.limit.append(float(np.quantile(1 - (mine @ found.T).max(1), ACCEPTED)))
        self.centroids, self.owner = np.concatenate(centroids).astype(np.float32), np.array(owner)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf).astype(np.float32)

    def __call__(self, counts: np.ndarray) -> list[tuple[str, float, float, bool]]:
        """Language, score, distance and whether it is too far, for each row of counts."""
        near = self.vectors(counts) @ self.centroids.T
        by = np.stack([near[:, self.owner == k].max(1) for k in range(len(self.langs))], 1)
        best = by.argmax(1)
        top = by[np.arange(len(by)), best]
        odds = np.exp((by - top[:, None]) * 20)
        return [(self.langs[k], float(min(1, 1 / o)), float(max(0, 1 - t)), bool(1 - t > self.limit[k])) for k, o, t in zip(best.tolist(), odds.sum(1).tolist(), top.tolist(), strict=True)]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS, folds: int = FOLDS, held: int = HELD_FOLD) -> Model | None:
    lang = F.col(f"`{lang_col}`")
    usable = own_columns(docs, id_col, text_col, lang_col).where(lang.isNotNull() & F.col(f"`{text_col}`").isNotNull() & (fold(id_col, folds) != held))
    counts = {r[0]: r[1] for r in usable.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(rows).collect()}
    if not counts:
        return None
    # A hash threshold of twice each language's share leaves about that many rows, of which the least hashes are taken: a small table, whatever the input.
    each = max(1, rows // len(counts))
    limits = docs.sparkSession.createDataFrame([(k, min(1.0, (2 * each + 60) / n)) for k, n in counts.items()], "lang string, share double")
    rank = F.xxhash64(F.col(f"`{id_col}`").cast("long"))
    near = usable.select(F.col(f"`{id_col}`").cast("long").alias("id"), lang.alias("lang"), rank.alias("rank"), utf8(text_col).alias("text")).join(F.broadcast(limits), "lang")
    near = near.where(F.col("rank").cast("double") < (2 * F.col("share") - 1) * float(1 << 63))
    chosen = written(near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "id"))).where(F.col("n") <= each).select("lang", "text"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [grams(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([None if g is None else g.astype("<f4").tobytes() for g in found], pa.binary())], names=["lang", "x"])

    got = sorted((r.lang, bytes(r.x)) for r in mapped(chosen, count, "lang string, x binary").where("x is not null").toLocalIterator())
    discard(chosen)
    return Model(np.array([np.frombuffer(x, "<f4") for _, x in got]), [k for k, _ in got]) if got else None


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, distance, rejected) for each row; a rejected row's lang is the nearest all the same."""
    schema = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("score", pa.float64()), ("distance", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found: list = [grams(t.as_py()) for t in part.column("text")]
                out = [("und", 0.0, 1.0, True)] * len(found)
                with_letters = [k for k, g in enumerate(found) if g is not None]
                if model is not None and with_letters:
                    for k, r in zip(with_letters, model(np.array([found[k] for k in with_letters])), strict=True):
                        out[k] = r
                lang, score, distance, rejected = zip(*out, strict=True)
                yield batch_of({"id": part.column("id"), "lang": list(lang), "score": list(score), "distance": list(distance), "rejected": list(rejected)}, schema)

    rows = own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text"))
    return mapped(rows, run, "id long, lang string, score double, distance double, rejected boolean")


def op6_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's language."""
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit(docs))
    return found.select(F.col("id").alias("doc_id"), F.coalesce(fold("id", FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"), "score", "distance", "rejected")

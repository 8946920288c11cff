"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every word, its written shape and the mark of a repeat are tokens. A token has a sparse ternary index vector
that its hash determines; its context vector is the sum of its neighbours' index vectors over all
texts outside the held-out fold, labelled or not. A document is the mean of its tokens' context vectors, words and shapes apart, with its length and the
share and energy of repeats. A small network scores it, and a temperature fitted on rows it wasn't trained on
turns the score into a probability.

The vectors take one scan: every task sums into a table of fixed size, and the tables are added up by blocks of tokens.
The network is fitted on a bounded sample: the TRAIN_ROWS labelled documents of least hash outside the
held-out fold. All documents are scored, whole, in one scan, by a model of fixed size (VOCABULARY by WIDTH).

Defined results: a null text counts as empty and gets a score from its length alone. Null labels and labels
of absent documents are ignored; of several labels for a document the highest holds. With labels of one kind
only, or none, every score is the share of good labels (1 without labels). Null identifiers are scored and
count as not held out. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from tickloom.llm.common import discard, mapped, own_columns, table, utf8, written

TRAIN_ROWS, VOCABULARY, WIDTH, NONZERO, REACH, HIDDEN = 8000, 1 << 14, 48, 4, 2, 24
FOLDS, HELD_FOLD, THRESHOLD = 5, 0, 0.3
#: Words whose tokens a worker remembers.
REMEMBERED = 500_000
#: Training texts go to so many tasks.
TRAIN_TASKS = 8
#: Context vectors are added up in blocks of so many tokens, and within a task over so many pairs of neighbours at a time.
BLOCK_TOKENS, PAIRS = 256, 1 << 20


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds


def _shape(word: bytes) -> bytes:
    """The word's outline: runs of capitals, small letters, digits and other letters, with its punctuation as it is."""
    out = bytearray()
    for c in word:
        k = 88 if 65 <= c <= 90 else 120 if 97 <= c <= 122 else 57 if 48 <= c <= 57 else 117 if c >= 128 else c
        if not out or out[-1] != k:
            out.append(k)
    return bytes(out)


class _Tokens(dict):
    """word: its token in the low half, its shape's in the high one. Shapes have the upper quarter of the vocabulary."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        low = VOCABULARY * 3 // 4
        bare = word.lower().strip(b"!?.,;:*#%&$|()[]{}\"'-_=+~<>")
        out = self[word] = xxh32_intdigest(bare, 1) % low | (low + xxh32_intdigest(_shape(word), 2) % (VOCABULARY - low)) << 16
        return out


def index_vectors() -> np.ndarray:
    """One sparse ternary vector a token, from its number alone."""
    rng = np.random.Generator(np.random.PCG64(7))
    out = np.zeros((VOCABULARY, WIDTH), np.float32)
    at = np.argsort(rng.random((VOCABULARY, WIDTH)), axis=1)[:, :NONZERO]
    np.put_along_axis(out, at, np.tile(np.array([1, -1], np.float32), NONZERO // 2)[None], axis=1)
    return out


def _context(texts: Iterator[bytes], index: np.ndarray) -> np.ndarray:
    """Sums of the index vectors of the neighbours within REACH, by token; whole numbers."""
    out, tokens = np.zeros(VOCABULARY * WIDTH, np.int64), _Tokens()
    at = np.argsort(index == 0, axis=1, kind="stable")[:, :NONZERO]
    sign = np.take_along_axis(index, at, axis=1).astype(np.float64)
    pairs, waiting = [], 0

    def add() -> None:
        to, of = (np.concatenate(x) for x in zip(*pairs, strict=True))
        for k in range(NONZERO):
            out[:] += np.bincount(to * WIDTH + at[of, k], sign[of, k], VOCABULARY * WIDTH).astype(np.int64)

    for text in texts:
        both = np.fromiter((tokens[w] for w in text.split()), np.int64)
        for ids in (both & 0xFFFF, both >> 16):
            for d in range(1, min(REACH, len(ids) - 1) + 1):
                for first in range(0, len(ids) - d, PAIRS):
                    a, b = ids[d:][first : first + PAIRS], ids[:-d][first : first + PAIRS]
                    pairs += [(a, b), (b, a)]
                    waiting += 2 * len(a)
                    if waiting >= PAIRS:
                        add()
                        pairs, waiting = [], 0
    if pairs:
        add()
    return out.reshape(VOCABULARY, WIDTH)


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """_context of all docs; the driver gets one table."""
    kinds = "block int, sums binary"

    def batch(found: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in found.values()], pa.binary())], names=["block", "sums"])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _context((t.as_py() for b in batches for t in b.column("text")), index_vectors())
        yield batch({k: x for k in range(VOCABULARY // BLOCK_TOKENS) if (x := found[k * BLOCK_TOKENS : (k + 1) * BLOCK_TOKENS]).any()})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("block").to_pylist(), b.column("sums"), strict=True):
                found[k] = found.get(k, 0) + np.frombuffer(x.as_buffer(), "<i8")
        yield batch(found)

    # Whole numbers, so the order of addition doesn't matter.
    out = np.zeros((VOCABULARY, WIDTH), np.int64)
    parts = mapped(docs.select(utf8(text_col).alias("text")), contexts, kinds)
    for r in mapped(parts.repartition("block"), added, kinds).toLocalIterator():
        out[r.block * BLOCK_TOKENS : (r.block + 1) * BLOCK_TOKENS] = np.frombuffer(r.sums, "<i8").reshape(BLOCK_TOKENS, WIDTH)
    return out


EXTRA = 6


def pooled(text: bytes, vectors: np.ndarray, index: np.ndarray, tokens: _Tokens) -> np.ndarray:
    """A document's features: pooled word and shape vectors, and EXTRA numbers on length and repeats."""
    both = np.fromiter(map(tokens.__getitem__, text.split()), np.int64)
    out = np.zeros(2 * WIDTH + EXTRA, np.float32)
    n = len(both)
    if not n:
        return out
    words, shapes = both & 0xFFFF, both >> 16
    for k, ids in enumerate((words, shapes)):
        found, times = np.unique(ids, return_counts=True)
        share = (times / n).astype(np.float32)
        out[k * WIDTH : (k + 1) * WIDTH] = share @ vectors[found]
        energy = share @ index[found]
        out[2 * WIDTH + k] = np.sqrt(energy @ energy)
        out[2 * WIDTH + 2 + k] = len(found) / n
    out[2 * WIDTH + 4] = np.log1p(n) / 8
    out[2 * WIDTH + 5] = (words[1:] == words[:-1]).mean() if n > 1 else 0
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Network:
    """Two layers, fitted by Adam on shuffled batches, then a temperature on the rows left out."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        order = rng.permutation(len(x))
        held, fit = order[: len(x) // 5], order[len(x) // 5 :]
        if len(set(y[fit].tolist())) < 2 or not len(held):
            fit = held = order
        self.mean, self.scale = x[fit].mean(0), x[fit].std(0) + 1e-4
        z = ((x - self.mean) / self.scale).clip(-8, 8)
        self.p = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
        self.temperature = 1.0
        first, second, step = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(fit), -(-len(fit) // 64)):
                h = np.tanh(z[rows] @ self.p[0] + self.p[1])
                d = (_sigmoid(h @ self.p[2] + self.p[3]) - y[rows]) / len(rows)
                dh = d[:, None] * self.p[2] * (1 - h * h)
                step += 1
                for k, g in enumerate((z[rows].T @ dh + 1e-3 * self.p[0], dh.sum(0), h.T @ d + 1e-3 * self.p[2], d.sum(keepdims=True))):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - 0.004 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        logits = self._logit(x[held])
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, -np.where(y[held] > 0, logits, -logits) / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale).clip(-8, 8) @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self._logit(x) / self.temperature)


def sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int, folds: int, held: int) -> DataFrame:
    """(text, y): the rows labelled documents of least hash outside the held-out fold, each whole."""
    marked = own_columns(labels, id_col, label_col).where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull() & (fold(id_col, folds) != held))
    marked = marked.groupBy(F.col(f"`{id_col}`").cast("long").alias("_id")).agg(F.max(F.col(f"`{label_col}`").cast("double")).alias("y"))
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), utf8(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("text", F.when(F.col("y") > 0, 1.0).otherwise(0.0).alias("y"))  # at most rows rows of 16 bytes


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS, folds: int = FOLDS, held: int = HELD_FOLD):
    """(vectors, network or the constant score). A pass over the texts outside the held-out fold and one over the sample; the driver gets tables of fixed size and a vector a row."""
    sample = written(sampled(docs, labels, id_col, text_col, label_col, rows, folds, held).repartition(TRAIN_TASKS), "sample")

    permitted = F.coalesce(fold(id_col, folds) != held, F.lit(True))
    vectors = context_sums(own_columns(docs, id_col, text_col).where(permitted), text_col).astype(np.float32)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, tokens = index_vectors(), _Tokens()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array([pooled(t.as_py(), vectors, index, tokens).astype("<f4").tobytes() for t in b.column("text")], pa.binary())], names=["y", "x"])

    got = sorted((bytes(r.x), r.y) for r in mapped(sample, features, "y double, x binary").collect())
    discard(sample)
    y = np.array([v for _, v in got])
    if len(set(y.tolist())) < 2:
        return vectors, float(y.mean()) if len(y) else 1.0
    return vectors, Network(np.array([np.frombuffer(x, "<f4") for x, _ in got], np.float64), y)


def score(docs: DataFrame, model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all, if not named) in a struct named row, and score."""
    vectors, network = model
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"), utf8(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, tokens = index_vectors(), _Tokens()
        for b in batches:
            if isinstance(network, float):
                scores = np.full(b.num_rows, network)
            else:
                x = [pooled(t.as_py(), vectors, index, tokens) for t in b.column("text")]
                scores = network(np.array(x, np.float64)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    return mapped(rows, run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every document's score."""
    docs = own_columns(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(fold("doc_id", FOLDS) == HELD_FOLD, F.lit(False))
    scored = score(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs that the classifier, fitted on the labelled ones, accepts."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where(F.col("score") >= THRESHOLD).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

"""Importance resampling towards a target distribution, over hashed n-grams.

Texts stay bytes: a table of 256 entries lower-cases ASCII letters and blanks separators, split() yields the words, and the
crc32 of an n-gram goes on as the seed of the next longer one. Every task counts buckets and hands its counter on; counters
are added up by bucket. The gains, one number a bucket, are all the driver holds; a second scan sums them over each
document's features. Scores are ranked by range-partitioned running counts, so no task sees all of them.

Features are computed twice rather than kept: kept, they would take more room than the texts.

Defined results: null texts have no words. A null identifier is hashed as the empty string and comes last among equal scores; repeated
rows are documents of their own. Without target texts, or without documents, the formulas hold with zero counts. An empty table
gives an empty table. Extra columns are ignored. A text of any length is cut into slices at spaces, and n-grams go on over the cuts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8, written
from tickloom.llm.mixing import running

BUCKETS, LEAST_WORDS, SEED = 10_000, 20, 42
#: Drawn: this many of 100 documents that are long enough.
PERCENT = 5
#: Bytes of a text whose words are held at once.
SLICE = 1 << 20
#: Letters and digits stay, capitals become small, other ASCII becomes a space; bytes from 128 on are parts of other characters.
TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def slices(text: bytes, most: int = SLICE) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    clean, at = text.translate(TABLE), 0
    while at < len(clean):
        end = clean.find(b" ", at + most)
        end = len(clean) if end < 0 else end
        yield clean[at:end].split()
        at = end


def features(text: bytes, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the n-grams that end in them) of each slice of a text."""
    before: list[bytes] = []
    for words in slices(text):
        if not words:
            continue
        run = before + words
        spaced = [b" " + w for w in run]
        one = list(map(crc32, run))
        two = list(map(crc32, spaced[1:], one))
        three = list(map(crc32, spaced[2:], two))
        # What lies within the words carried over was there before.
        skip = len(before)
        found = one[skip:] + two[max(0, skip - 1) :] + three[max(0, skip - 2) :]
        yield len(words), np.array(found, np.int64) % buckets
        before = run[-2:]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows: a counter for each task, added up by bucket."""
    names = ["bucket", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, found in features(text.as_py(), buckets):
                    if len(found) < buckets // 8:
                        np.add.at(counter, found, 1)
                    else:
                        counter += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(counter)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counter[seen])], names=names)

    return mapped(own_columns(docs, text_col).select(utf8(text_col).alias("text")), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """What a feature in each bucket adds to a document's weight."""
    s_all, t_all = sum(raw.values()), sum(target.values())
    ratio = [(target.get(b, 0) + 1.0) * (s_all + float(buckets)) / ((raw.get(b, 0) + 1.0) * (t_all + float(buckets))) for b in range(buckets)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A Gumbel draw that the identifier determines, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row."""
    schema = pa.schema([(n, pa.int64()) for n in ("id", "n_words", "n_features", "weight", "score")])
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column("id").to_pylist(), []
            for doc_id, text in zip(ids, batch.column("text"), strict=True):
                words = n = weight = 0
                for more, found in features(text.as_py(), buckets):
                    words, n, weight = words + more, n + len(found), weight + int(gain[found].sum())
                out.append((words, n, weight, weight + noise(doc_id, seed)))
            yield batch_of(dict(zip(schema.names, [ids, *zip(*out, strict=True)] if out else [[]] * 5, strict=True)), schema)

    rows = own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text"))
    return mapped(rows, run, "id long, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank is null where a row isn't drawn."""
    raw, aim = ({r.bucket: r.n for r in bucket_counts(d, c, buckets).collect()} for d, c in ((docs, text_col), (target, target_col)))  # at most a row a bucket
    rows = written(weighed(docs, gains(raw, aim, buckets), id_col, text_col, seed), "weights")
    long_enough = rows.where(F.col("n_words") >= least_words)
    drawn = percent * long_enough.count() // 100
    keyed = long_enough.select("*", F.lit(0).cast("long").alias("all"), F.lit(1).cast("long").alias("one"), (-F.col("score")).alias("down"), F.col("id").isNull().alias("nameless"))
    ranked = running(keyed, "all", ["down", "nameless", "id", "n_features"], "one", "at")
    names = ["id", "n_features", "weight", "score"]
    placed = ranked.select(*names, F.when(F.col("at") < drawn, F.col("at") + 1).alias("rank"))
    return placed.unionByName(rows.where(F.col("n_words") < least_words).select(*names, F.lit(None).cast("long").alias("rank")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents, drawn towards the benchmark's texts."""
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


#: Independent of the code above: n-grams as strings, checksums byte by byte from the polynomial.
ORACLE = """
WITH RECURSIVE poly(k, n, c) AS (
  SELECT 0, range, range FROM range(256)
  UNION ALL
  SELECT k + 1, n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8
), crcs AS (SELECT list(c ORDER BY n) AS tab FROM poly WHERE k = 8
), texts AS (
  SELECT 'd' AS kind, row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL
  SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
), words AS (
  SELECT kind, id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), grams AS (
  SELECT kind, id, array_to_string(w[i:i + g - 1], ' ') AS feature
  FROM (SELECT kind, id, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest([1, 2, 3]) AS g) WHERE i + g - 1 <= len(w)
), counted AS (SELECT kind, id, feature, count(*) AS n FROM grams GROUP BY ALL
), hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode(feature)) + 1), lambda i: ('0x' || substr(hex(encode(feature)), 2 * i - 1, 2))::BIGINT)),
                                  lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted), crcs
), sums AS (
  SELECT kind, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM sums WHERE kind = 'd') + 10000)::DOUBLE
         / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM sums WHERE kind = 'b') + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT * FROM sums WHERE kind = 'd') s LEFT JOIN (SELECT * FROM sums WHERE kind = 'b') t USING (bucket)
), weights AS (
  SELECT w.doc_id, len(w.w) AS n_words, coalesce(x.n, 0)::BIGINT AS n_features, coalesce(x.weight, 0)::BIGINT AS weight,
         ('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT AS h
  FROM words w LEFT JOIN (SELECT id, sum(n) AS n, sum(n * gain) AS weight FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY id) x USING (id)
  WHERE w.kind = 'd'
), scored AS (
  SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM weights
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM placed
"""

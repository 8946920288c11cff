"""Exact token counts by a two-tier lookup of pre-token lengths.

A text is cut before every space that something other than white space follows. The tokenizer's own pre-tokens never reach over
such a place and what it does on one side doesn't depend on the other, so a text's count is the sum of its pieces' lengths. A piece
is mostly one pre-token, or one with its punctuation. The first tier is a compact table of frequent pieces with their lengths,
broadcast once. What it lacks is encoded, once a worker, and remembered for the worker's later batches and tasks.

The table is counted over the whole texts of all rows: Spark sums up what stands between spaces and keeps the words above a count that
at most TABLE of them reach. A second scan gives the rows' counts. TABLE and ENTRY_CHARS bound the table to some megabytes, REMEMBERED
bounds what a worker adds, whatever the corpus.

Added tokens' strings in a text are one token each, as the tokenizer has it by default.

Defined results: a null text is empty and has no tokens. Null identifiers and repeated rows are counted like others. Bytes that
are not UTF-8 count as replacement characters. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8, written
from tickloom.llm.packing import encoder

LIMIT = 512
#: Entries of the broadcast table, and the longest piece in it or in a cache.
TABLE, ENTRY_CHARS = 1 << 16, 40
#: Steps for each doubling of a piece's count, by which the table's least count is found.
STEPS = 8
#: Pieces a worker remembers beside the table, and characters of a text that are cut at once.
REMEMBERED, SLICE = 1 << 20, 1 << 22
#: White space as Python has it holds all that the tokenizer's pattern has, so a cut is never within a run of it.
CUT = re.compile(r" (?=\S)")


def pieces(text: str) -> Iterator[tuple[bool, list[str]]]:
    """The text cut before spaces, some at a time; True where a cut, and so a space, is before the first piece too. The spaces are left out."""
    if len(text) <= SLICE:
        yield False, CUT.split(text)
        return
    at, cut = 0, False
    while True:
        m = CUT.search(text, at + SLICE)
        yield cut, CUT.split(text[at : m.start() if m else len(text)])
        if m is None:
            return
        at, cut = m.end(), True


class Lengths:
    """How many tokens texts have, by the tokenizer file at path. known: lengths of pieces, each with the space before it counted in."""

    def __init__(self, path: str, known: dict[str, int]):
        self.encode = encoder(path)
        self.added = [t["content"] for t in json.loads(open(path, encoding="utf-8").read())["added_tokens"]]
        self.known, self.lengths = known, dict(known)

    def of_text(self, text: str) -> int:
        if any(a in text for a in self.added):
            return len(self.encode(text))
        total = 0
        for cut, words in pieces(text):
            if not cut:
                total += len(self.encode(words[0]))
                del words[0]
            found = list(map(self.lengths.get, words))
            if None in found:
                found = [self.learned(w) if n is None else n for w, n in zip(words, found, strict=True)]
            total += sum(found)
        return total

    def learned(self, word: str) -> int:
        """The second tier; once it is full, it begins anew from the table."""
        n = self.lengths.get(word)
        if n is None:
            n = len(self.encode(" " + word))
            if len(word) <= ENTRY_CHARS:
                if len(self.lengths) >= len(self.known) + REMEMBERED:
                    self.lengths = dict(self.known)
                self.lengths[word] = n
        return n


@lru_cache(maxsize=2)
def worker(path: str, packed: bytes) -> Lengths:
    """The worker's tiers: kept from task to task for as long as the worker lives."""
    names, sizes = json.loads(zlib.decompress(packed))
    return Lengths(path, dict(zip(names, sizes, strict=True)))


def frequent(texts: DataFrame, tokenizer: str, most: int = TABLE) -> bytes:
    """The broadcast table, packed: the most frequent short words of all texts, at most so many, and their lengths."""
    words = texts.select(F.explode(F.split(F.col("text").cast("string"), " ")).alias("piece")).where(F.length("piece").between(1, ENTRY_CHARS))
    counted = words.groupBy("piece").agg(F.count("*").alias("n")).where("n > 1")
    counted = written(counted.select(F.col("piece").cast("binary").alias("piece"), "n", F.floor(F.log2(F.col("n").cast("double")) * STEPS).cast("int").alias("level")), "words")
    least, held = None, 0
    for level, n in sorted(counted.groupBy("level").count().collect(), reverse=True):  # a row a level, of which there are 64 * STEPS
        held += n
        if held > most:
            break
        least = level
    if least is None:
        return zlib.compress(json.dumps([[], []]).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            names = [w.as_py().decode("utf-8", "replace") for w in batch.column("piece")]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column("n"), pa.array([len(encode(" " + w)) for w in names], pa.int64())], names=["piece", "n", "tokens"])

    rows = mapped(counted.where(F.col("level") >= least).select("piece", "n"), run, "piece string, n long, tokens long").collect()  # at most `most` short rows
    rows.sort(key=lambda r: (-r.n, r.piece))
    return zlib.compress(json.dumps([[r.piece for r in rows], [r.tokens for r in rows]]).encode())


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text"))
    packed = docs.sparkSession.sparkContext.broadcast(frequent(rows.select("text"), tokenizer))
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = worker(tokenizer, packed.value)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("text")).to_pylist()
            counts = [lengths.of_text(t.as_py().decode("utf-8", "replace")) for t in batch.column("text")]
            yield batch_of({"id": batch.column("id"), "n_bytes": sizes, "n_tokens": counts, "over_limit": [n > limit for n in counts]}, schema)

    return mapped(rows, run, "id long, n_bytes long, n_tokens long, over_limit boolean")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the token counts of all documents."""
    return token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

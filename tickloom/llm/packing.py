"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens, cut into quanta. A window has window/quantum slots. Each slot goes to the
source with the right to it: a queue earns credit in proportion to its target share at every slot, is served
when its credit reaches a quantum, and carries the rest (its deficit) on, over windows and partitions alike.
The scheduler is hierarchical: a binary tree over the sources, each node of which deals the slots it gets
between its two sides, with the carried deficit being the remainder of n*share. That makes the state after n
slots a closed form, so any task can say which slots a run of tokens gets, and no task walks the schedule.

Target proportions are given as weights by source. Every token has to be packed, so once a source has ended the others go on
by their weights, and sources without a weight come last: each such phase has a schedule of its own, and what a phase leaves
due to a queue is carried to the next. Without weights the targets are the sources' shares of all tokens: all queues end together, in one phase.
Every window has its phase's mixture to within a quantum a level of the tree. Only the last window and the last quantum of each
source can fall short. With weights there is at most a phase for each of them, so they are meant for some hundred sources.

Steps: texts are tokenised once, in one scan, and written with their place in their partition's part of the
queue; the totals by (partition, source) give every part its place in the whole queue; then each row finds its
pieces by arithmetic. Token ids are never shuffled, unless the table of parts outgrows a broadcast.

Defined results: a null text is empty and has just the end token. Null sources are a queue of their own.
Null identifiers and repeated rows are packed like others. An empty table gives no pieces. Extra columns are
ignored.

Any number of sources: those beyond the most_sources largest share one queue of the schedule, in which their quanta take turns by a
second level, each source's k-th of q at the place (2k+1)/(2q) of all. These places are a table, made and joined by Spark.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8, written
from tickloom.llm.mixing import running

WINDOW, QUANTUM, END_ID = 1024, 32, 0
#: Characters of white space in a row from which on they are encoded by themselves.
LONG_RUN = 10_000
#: Queues of the schedule, which every task holds: about 100 bytes each.
MOST_SOURCES = 4096


@lru_cache(maxsize=1)
def encoder(path: str) -> Callable[[str], list[int]]:
    """The byte-level BPE of the tokenizer file at path, from its vocabulary as ranks: the same ids, several times faster.

    Strings that the file adds to the vocabulary are one id each wherever they are in a text, as the file has it by default.
    The pattern engine's stack grows with a run of white space, so a long run goes past it: all of it but its last character, or the
    whole where nothing follows, is what the pattern takes as one piece anyway.
    """
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path.removesuffix(".json") + ".tiktoken", "rb"))}
    added = {t["content"]: t["id"] for t in json.loads(open(path, encoding="utf-8").read())["added_tokens"]}
    known = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    runs = regex.compile(rf"\s{{{LONG_RUN},}}")
    cuts = regex.compile("(" + "|".join(map(regex.escape, added)) + ")")

    def plain(text: str) -> list[int]:
        ids, at = [], 0
        for m in runs.finditer(text) if len(text) >= LONG_RUN else ():
            last = m.end() - (m.end() < len(text))
            ids += known.encode_ordinary(text[at : m.start()])
            ids += known._encode_single_piece(text[m.start() : last])
            at = last
        return ids + known.encode_ordinary(text[at:]) if at else known.encode_ordinary(text)

    def encode(text: str) -> list[int]:
        if not any(t in text for t in added):
            return plain(text)
        ids = []
        for part in cuts.split(text):
            ids += [added[part]] if part in added else plain(part)
        return ids

    return encode


#: What a run of tokens needs to be placed: skip, the tokens of its document before it, tokens, all of its document's.
_PLACED = ["id", "queue", "shared", "place", "skip", "n", "tokens", "ids"]


def queue_of(source_col: str) -> Column:
    """A source's queue; null has one of its own."""
    c = F.col(f"`{source_col}`")
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), c))


def tokenised(docs: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer: str) -> DataFrame:
    """(id, queue, part, start, n, ids): ids as little-endian 16-bit numbers, start within the partition's part of the queue."""
    schema = pa.schema([("id", pa.int64()), ("queue", pa.string()), ("part", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        part, so_far = TaskContext.get().partitionId(), {}
        for batch in batches:
            queues, ids, starts = batch.column("queue").to_pylist(), [], []
            for queue, text in zip(queues, batch.column("text"), strict=True):
                found = np.array([*encode(text.as_py().decode("utf-8", "replace")), END_ID], "<u2")
                starts.append(so_far.get(queue, 0))
                so_far[queue] = starts[-1] + len(found)
                ids.append(found.tobytes())
            sizes = [len(x) // 2 for x in ids]
            yield batch_of({"id": batch.column("id"), "queue": batch.column("queue"), "part": pa.array([part] * len(ids), pa.int32()), "start": starts, "n": sizes, "ids": ids}, schema)

    rows = own_columns(docs, id_col, text_col, source_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), queue_of(source_col).alias("queue"), utf8(text_col).alias("text"))
    return mapped(rows, run, "id long, queue string, part int, start long, n long, ids binary")


def muldiv(n, a, m) -> tuple[np.ndarray, np.ndarray]:
    """floor(n*a/m) and the remainder, exact though n*a outgrows 64 bits.

    The quotient is first taken in floating point, which misses by a little; the remainder, taken modulo 2^64,
    is then small enough to be right, and corrects it.
    """
    n, a, m = np.asarray(n, np.int64), np.asarray(a, np.int64), np.asarray(m, np.int64)
    q = np.floor(n.astype(np.float64) * (a.astype(np.float64) / m.astype(np.float64))).astype(np.int64)
    with np.errstate(over="ignore"):
        r = n * a - q * m
    return q + r // m, r % m


class Schedule:
    """Which slots the queues get. sizes: quanta by queue, each at least 1."""

    def __init__(self, sizes: dict[str, int]):
        heap = [(n, str(q), q) for q, n in sorted(sizes.items())]
        heapq.heapify(heap)
        while len(heap) > 1:
            one, two = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (one[0] + two[0], min(one[1], two[1]), (one, two)))
        self.paths: dict[str, list[tuple[int, int, bool]]] = {}
        self.order: dict[str, int] = {}
        self.total = heap[0][0] if heap else 0
        todo = [(heap[0], [])] if heap else []
        while todo:
            (n, _, what), path = todo.pop()
            if isinstance(what, tuple):
                left, right = what
                todo += [(right, [*path, (left[0], n, False)]), (left, [*path, (left[0], n, True)])]
            else:
                self.paths[what], self.order[what] = path, len(self.order)

    def served(self, queue: str, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Among the first slots: quanta of this queue, and of the queues before it in the tree's order."""
        n, before = slots, np.zeros_like(slots)
        for a, m, left in self.paths[queue]:
            q, _ = muldiv(n, a, m)
            if left:
                n = q
            else:
                before, n = before + q, n - q
        return n, before

    def slot(self, queue: str, quanta: np.ndarray) -> np.ndarray:
        """The slot of each of the queue's quanta: the inverse of served()."""
        j = quanta
        for a, m, left in reversed(self.paths[queue]):
            if left:  # the first n with floor((n+1)*a/m) > j
                q, r = muldiv(j + 1, m, a)
                j = q + (r > 0) - 1
            else:
                j, _ = muldiv(j, m, m - a)
        return j


def phases(sizes: dict[str, int], weights: dict[str, float] | None = None) -> list[dict[str, int]]:
    """What each queue gives to each phase. A phase ends with a queue; the others go on by their weights, those without one come last, by their sizes."""
    if weights is None:
        return [sizes] if sizes else []
    full = {q: n / weights[q] for q, n in sizes.items() if weights.get(q)}
    out, given = [], dict.fromkeys(sizes, 0)
    for level in sorted(set(full.values())):
        upto = {q: sizes[q] if full[q] <= level else min(sizes[q], int(weights[q] * level)) for q in full}
        out.append({q: n - given[q] for q, n in upto.items() if n > given[q]})
        given |= upto
    out.append({q: n for q, n in sizes.items() if q not in full})
    return [p for p in out if p]


class Places:
    """Where tokens go: a Schedule for each phase, one after the other, with the queues' lengths in tokens."""

    def __init__(self, tokens: dict[str, int], window: int = WINDOW, quantum: int = QUANTUM, weights: dict[str, float] | None = None):
        self.tokens, self.quantum, self.slots = tokens, quantum, window // quantum
        dealt = phases({q: -(-n // quantum) for q, n in tokens.items()}, weights)
        self.schedules = [Schedule(p) for p in dealt]
        self.begins = np.cumsum([0, *(s.total for s in self.schedules)])  # a phase's first slot
        self.given = {q: np.cumsum([0, *(p.get(q, 0) for p in dealt)]) for q in tokens}  # a queue's quanta before each phase
        self.short: dict[int, list[tuple[int, int, int]]] = {}  # window: (phase, order, tokens that the last quantum of that queue lacks)
        for q, n in tokens.items():
            if lack := -n % quantum:
                phase, slot = self._slot(q, np.array([-(-n // quantum) - 1]))
                k = int(phase[0])
                self.short.setdefault(int(slot[0]) // self.slots, []).append((k, self.schedules[k].order[q], lack))

    def _slot(self, queue: str, quanta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phase and slot of each of the queue's quanta."""
        phase, slot = np.searchsorted(self.given[queue], quanta, "right") - 1, np.empty_like(quanta)
        for k in np.unique(phase).tolist():
            mine = phase == k
            slot[mine] = self.begins[k] + self.schedules[k].slot(queue, quanta[mine] - self.given[queue][k])
        return phase, slot

    def pieces(self, queue: str, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """For runs of the queue's tokens: row, first token within the run, length, window and offset of each piece."""
        quantum, total = self.quantum, self.tokens[queue]
        first, last = starts // quantum, (starts + sizes - 1) // quantum
        counts = last - first + 1
        row = np.repeat(np.arange(len(starts)), counts)
        j = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
        phase, slot = self._slot(queue, j)
        w = slot // self.slots
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (w[1:] != w[:-1]) | (phase[1:] != phase[:-1])
        row, w, phase = row[new], w[new], phase[new]
        # A phase's part of a window, in slots: low to high.
        low, high = np.maximum(w * self.slots, self.begins[phase]), np.minimum((w + 1) * self.slots, self.begins[phase + 1])
        have, before, then, after = (np.empty_like(w) for _ in range(4))
        for k in np.unique(phase).tolist():
            mine, served = phase == k, self.schedules[k].served
            have[mine], before[mine] = served(queue, low[mine] - self.begins[k])
            then[mine], after[mine] = served(queue, high[mine] - self.begins[k])
        have, then = have + self.given[queue][phase], then + self.given[queue][phase]
        opens = have * quantum
        a = np.maximum(starts[row], opens)
        b = np.minimum(starts[row] + sizes[row], np.minimum(then * quantum, total))
        offset = (low - w * self.slots + after - before) * quantum + a - opens
        if self.short:
            for k in np.flatnonzero(np.isin(w, np.fromiter(self.short, np.int64, len(self.short)))).tolist():
                mine = int(phase[k]), self.schedules[phase[k]].order[queue]
                offset[k] -= sum(lack for *place, lack in self.short[int(w[k])] if tuple(place) < mine)
        return row, a - starts[row], b - a, w, offset


def turns(totals: DataFrame, quantum: int) -> DataFrame:
    """(queue, k, at): where in the shared queue each quantum of each of its sources begins. totals: (queue, n)."""
    count = F.ceil(F.col("n") / quantum)
    quanta = totals.where("n > 0").select("queue", "n", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("k"))
    placed = quanta.select("queue", "k", ((2 * F.col("k") + 1) / (2.0 * count)).alias("turn"), F.least(F.lit(quantum), F.col("n") - F.col("k") * quantum).alias("tokens"), F.lit(0).cast("long").alias("all"))
    return running(placed.select("all", "turn", "queue", "k", "tokens"), "all", ["turn", "queue"], "tokens", "at").select("queue", "k", "at")


def _in_turn(rows: DataFrame, totals: DataFrame, quantum: int) -> DataFrame:
    """rows of the shared queue, cut by their own queues' quanta, each at its place there. rows: (id, queue, place, n, ids), place within the own queue."""
    last = F.col("place") + F.col("n") - 1
    cut = rows.withColumn("k", F.explode(F.sequence(F.expr(f"place div {quantum}"), F.floor(last / quantum))))
    low, high = F.greatest("place", F.col("k") * quantum), F.least(last + 1, (F.col("k") + 1) * quantum)
    runs = cut.select("id", "queue", "k", F.lit("rest").alias("shared"), (low - F.col("k") * quantum).alias("within"), (low - F.col("place")).alias("skip"), (high - low).alias("n"), F.col("n").alias("tokens"), F.substring("ids", (2 * (low - F.col("place")) + 1).cast("int"), (2 * (high - low)).cast("int")).alias("ids"))
    return runs.join(turns(totals, quantum), ["queue", "k"]).withColumn("place", F.col("at") + F.col("within")).select(*_PLACED)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tokenizer: str | None = None,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    most_sources: int = MOST_SOURCES,
    with_ids: bool = False,
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pieces (id, source_queue, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids as little-endian 32-bit numbers]).

    weights: target proportions by source (None: the null source).
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    tokens = written(tokenised(docs, id_col, text_col, source_col, tokenizer), "tokens")
    parts = tokens.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    by_queue = parts.groupBy("queue").agg(F.sum("n").alias("n"))
    largest = [r.asDict() for r in by_queue.orderBy(F.desc("n"), "queue").limit(most_sources + 1).collect()]
    named, more = {r["queue"]: r["n"] for r in largest[:most_sources]}, len(largest) > most_sources
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that its size is known when the join is planned: it is broadcast if small, and only then are no ids shuffled.
    bases = written(parts.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    based = tokens.join(bases, ["part", "queue"]).withColumn("place", F.col("base") + F.col("start"))
    own = F.col("queue").isin(list(named))
    whole = lambda df: df.select("id", "queue", F.col("queue").alias("shared"), "place", F.lit(0).cast("long").alias("skip"), "n", F.col("n").alias("tokens"), "ids")
    placed = whole(based)
    totals = dict(named)
    if more:
        few = by_queue.where(~own)
        totals["rest"] = few.agg(F.sum("n")).first()[0]
        placed = whole(based.where(own)).unionByName(_in_turn(based.where(~own).select("id", "queue", "place", "n", "ids"), few, quantum))
    aims = None if weights is None else {"null" if k is None else f"={k}": v for k, v in weights.items()}
    places = Places(totals, window, quantum, aims) if totals else None
    fields = [("id", pa.int64()), ("source_queue", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary())] if with_ids else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            queues, sizes = np.array(batch.column("shared").to_pylist(), object), batch.column("n").to_numpy()
            starts, skips, whole = (batch.column(c).to_numpy() for c in ("place", "skip", "tokens"))
            names, sources, ids = batch.column("id"), batch.column("queue"), batch.column("ids")
            for queue in dict.fromkeys(queues):
                mine = np.flatnonzero(queues == queue)
                row, at, length, w, offset = places.pieces(queue, starts[mine], sizes[mine])
                crcs, raw, now, view = [], [], -1, b""
                for r, a, n in zip(row.tolist(), at.tolist(), length.tolist(), strict=True):
                    if r != now:
                        now, view = r, memoryview(np.frombuffer(ids[int(mine[r])].as_buffer(), "<u2").astype("<u4").tobytes())
                    piece = view[4 * a : 4 * (a + n)]
                    crcs.append(zlib.crc32(piece))
                    if with_ids:
                        raw.append(bytes(piece))
                of = pa.array(mine[row])
                out = {"id": names.take(of), "source_queue": sources.take(of), "start": pa.array(at + skips[mine][row]), "length": pa.array(length), "ids_crc32": pa.array(crcs, pa.int64()), "doc_tokens": pa.array(whole[mine][row]), "sequence_id": pa.array(w), "offset": pa.array(offset)}
                yield batch_of(out | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}), schema)

    kinds = "id long, source_queue string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else "")
    return mapped(placed.select(*_PLACED), run, kinds)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """(sequence_id, used, ids): pack(with_ids=True)'s pieces put together, padded to window unless the length is a power of two."""
    schema = pa.schema([("sequence_id", pa.int64()), ("used", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, used = [], []
            for parts in batch.column("parts").to_pylist():
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32)
                used.append(len(ids))
                out.append(ids if len(ids) & (len(ids) - 1) == 0 else np.pad(ids, (0, window - len(ids)), constant_values=pad_id))
            yield batch_of({"sequence_id": batch.column("sequence_id"), "used": used, "ids": out}, schema)

    gathered = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return mapped(gathered, run, "sequence_id long, used long, ids array<int>")


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the pieces of all documents."""
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of docs."""
    return pack(docs).withColumnRenamed("id", "doc_id")

"""Mixing sources to target weights, by blocks.

Each source's words, documents in the order of their identifiers, are packed into blocks of fixed length. Output
shards draw multinomial counts of slots for the sources (first for groups of GROUP sources, then within each, so that
nothing holds a number for each source); a source's slots are numbered across the shards, and slot i takes block
perm(i), perm being a keyed pseudorandom permutation of the source's block indices, another one for each pass over
the source. A source's last block may be shorter and comes last in each pass. Slots and blocks are joined by index.

Multinomial draws miss the targets by chance, so the books are settled: slots numbered beyond a source's due
count are left out, missing ones are added to a last shard, and a source's last slot is cut to the words still
due. So each source gives its target to the word. It is due at most two passes, so no document is taken more than twice.

Defined results: a null text has no words; null sources are one source, last in order. Documents without
words are reported with taken 0. Null identifiers and repeated rows count row by row. An empty table gives an
empty table. Extra columns are ignored. Everything follows from the rows and the seed, however the rows are cut into files
and partitions; only rows with the same source, identifier and text can change places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import mapped, own_columns, table, utf8, written

BLOCK, SHARD_SLOTS, SEED = 64, 16_384, 20_260
WEIGHTS, VOLUME, MOST_PASSES = (5.0, 2.0, 1.0), 1.5, 2
#: Sources whose counts are drawn together.
GROUP = 4096
#: Slots that a task makes, until there are MOST_TASKS of them.
TASK_SLOTS, MOST_TASKS = 1 << 18, 1 << 14


def _source(col: str) -> Column:
    """A sortable source key; the null source comes last."""
    return F.struct(F.col(f"`{col}`").isNull().cast("int").alias("absent"), F.coalesce(F.col(f"`{col}`"), F.lit("")).alias("name"))


def _mix64(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(key % (1 << 64))
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def permute(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of range(size), at index: four Feistel rounds over the next power of four, walked until back in range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    x, todo = index.astype(np.uint64), np.arange(len(index))
    while todo.size:
        a, b = x[todo] >> np.uint64(half), x[todo] & low
        for k in range(4):
            a, b = b, a ^ _mix64(b, key * 4 + k + 1) & low
        x[todo] = a << np.uint64(half) | b
        todo = todo[x[todo] >= size]
    return x.astype(np.int64)


def running(df: DataFrame, group: str, order: list[str], value: str, out: str) -> DataFrame:
    """df, written in order of group and order, with out: the sum of value over the group's rows before this one.

    Rows are range-partitioned and summed within partitions; a table of at most one row a partition holds what a
    group's earlier partitions sum to, so a group of any size is spread over tasks. group and value are whole numbers.
    """
    kinds = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("inner", T.LongType())])
    names = kinds.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, so_far = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, values = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (group, value))
            before = np.cumsum(values) - values
            first = np.maximum.accumulate(np.where(np.append(True, groups[1:] != groups[:-1]), np.arange(len(groups)), 0))
            inner = before - before[first]
            if groups[0] == last:
                inner[first == 0] += so_far
            last, so_far = groups[-1], int(inner[-1] + values[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(groups), part, np.int32)), pa.array(inner)], names=names)

    put = written(mapped(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order), run, kinds), "running")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = put.groupBy("part", group).agg(F.sum(value).alias("held")).select("part", group, F.sum("held").over(earlier).alias("base")).where("base > 0")
    # Only the group that a partition begins with has earlier partitions.
    return put.join(F.broadcast(bases), ["part", group], "left").withColumn(out, F.col("inner") + F.coalesce("base", F.lit(0))).drop("part", "inner", "base")


def level(sources: DataFrame, volume: float = VOLUME, passes: int = MOST_PASSES) -> float:
    """The words due for each unit of weight: sources (size, weight) share volume times all words, none more than passes times its own.

    Each step shares what full sources leave among the others, which makes more of them full, or ends.
    """
    at, full = 0.0, -1
    while True:
        is_full = F.lit(full >= 0) & (F.col("weight") * at > F.col("size") * passes)
        sums = sources.agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("words"), F.count_if(is_full).alias("full"), F.coalesce(F.sum(F.when(is_full, F.col("size"))), F.lit(0)).alias("given"), F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)).alias("open")
        ).first()
        if sums.full == full or not sums.open:
            return at
        at, full = (volume * sums.words - passes * sums.given) / sums.open, sums.full


def planned(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, volume: float = VOLUME, passes: int = MOST_PASSES, block: int = BLOCK) -> DataFrame:
    """sizes (source, size) with rank, weight, target, and what follows from it: words, slots and blocks. One row a source."""
    ranked = running(sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1)), "all", ["source"], "one", "rank").drop("all", "one")
    weighed = written(ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))), "weighed")
    most = F.col("size") * passes
    aimed = weighed.withColumn("target", F.least(F.col("weight") * level(weighed, volume, passes), most.cast("double")))
    aimed = aimed.withColumn("words", F.least(F.round("target").cast("long"), most)).withColumn("blocks", F.ceil(F.col("size") / block))
    rest = F.col("words") % F.col("size")
    return aimed.withColumn("slots", F.when(F.col("size") > 0, F.expr("words div size") * F.col("blocks") + F.ceil(rest / block)).otherwise(F.lit(0)).cast("long"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str]) -> DataFrame:
    """(id, source, tie, row, size, uid): size in words, tie from the text, row the carried columns."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _source(source_col).alias("source"), F.xxhash64(f"`{text_col}`").alias("tie"), utf8(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(1).alias("none")]).alias("row"))
    kept = ["id", "source", "tie", "row"]
    kinds = T.StructType([*[rows.schema[c] for c in kept], T.StructField("size", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(t.as_py().split()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(sizes, pa.int64())], names=[*kept, "size"])

    return mapped(rows, run, kinds).withColumn("uid", F.monotonically_increasing_id())


def drawn(plan: DataFrame, shard_slots: int, seed: int, group: int = GROUP) -> tuple[DataFrame, int]:
    """((shard, rank, slots), all slots): multinomial counts by shard, and a last shard with all that is due."""
    spark = plan.sparkSession
    due = plan.where("slots > 0").select(F.expr(f"rank div {group}").alias("grp"), F.struct("rank", "slots").alias("m"))
    groups = written(due.groupBy("grp").agg(F.sum("m.slots").alias("due"), F.sort_array(F.collect_list("m")).alias("members")), "groups")
    held = {r.grp: r.due for r in groups.select("grp", "due").collect()}  # one number for GROUP sources
    names, sums = np.array(sorted(held), np.int64), np.array([held[g] for g in sorted(held)], np.int64)
    total = int(sums.sum())
    last = -(-total // shard_slots)

    def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                got = np.random.Generator(np.random.PCG64([seed, k])).multinomial(shard_slots, sums / total) if k < last else sums
                at = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(names[at]), pa.array(got[at].astype(np.int64))], names=["shard", "grp", "got"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, grp, n, members in zip(*(batch.column(c) for c in ("shard", "grp", "got", "members")), strict=True):
                ranks, parts = (members.values.field(c).to_numpy() for c in ("rank", "slots"))
                k = shard.as_py()
                got = np.random.Generator(np.random.PCG64([seed, k, grp.as_py()])).multinomial(n.as_py(), parts / parts.sum()) if k < last else parts
                at = np.flatnonzero(got)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k)), pa.array(ranks[at]), pa.array(got[at].astype(np.int64))], names=["shard", "rank", "slots"])

    shards = spark.range(last + 1 if total else 0)
    by = mapped(shards, by_group, "shard long, grp long, got long")
    return mapped(by.join(groups.select("grp", "members"), "grp"), within, "shard long, rank long, slots long"), total


def _taker(seed: int, block: int):
    """From numbered runs of slots the blocks they take, and at most how many words of each."""
    names = ["shard", "slot", "rank", "pass", "block", "most"]

    def of_run(shard: int, rank: int, first: int, n: int, due: int, blocks: int, size: int, words: int) -> list[np.ndarray]:
        i = np.arange(first, first + n)
        passed, place = i // blocks, i % blocks
        taken = np.full(n, blocks - 1)
        for p in np.unique(passed).tolist():
            mine = np.flatnonzero((passed == p) & (place < blocks - 1))
            taken[mine] = permute(place[mine], blocks - 1, (seed * 1_000_003 + rank) * 16 + p)
        most = np.full(n, block)
        if first + n == due:
            most[-1] = words - passed[-1] * size - place[-1] * block
        return [np.full(n, shard), i, np.full(n, rank), passed, taken, most]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, held, count = 1 << 16, [], 0
        for batch in batches:
            for shard, rank, first, n, *rest in zip(*(batch.column(c).to_pylist() for c in ("shard", "rank", "first", "slots", "due", "blocks", "size", "words")), strict=True):
                for at in range(first, first + n, step):
                    held.append(of_run(shard, rank, at, min(step, first + n - at), *rest))
                    count += len(held[-1][0])
                    if count >= step:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)
                        held, count = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)

    return take


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, taken).

    rows: uid, id, rank, at (the row's first word within its source), size, source_size, target, and with carry row (those columns).
    taken: shard, slot, rank, pass, block, uid, word (first one within the row), words: the mix itself, piece by piece.
    """
    base = written(sized(docs, id_col, text_col, source_col, carry or []), "sized")
    plan = written(planned(base.groupBy("source").agg(F.sum("size").alias("size")), block=block), "plan")
    named = plan.select("source", "rank", F.col("size").alias("source_size"), "target")
    rows = running(base.select("uid", "id", "source", "tie", "size").join(named, "source").drop("source"), "rank", ["id", "tie"], "size", "at").drop("tie")

    counts, total = drawn(plan, shard_slots, seed)
    numbered = running(written(counts, "drawn"), "rank", ["shard"], "slots", "first")
    runs = numbered.join(plan.select("rank", F.col("slots").alias("due"), "blocks", "size", "words"), "rank").withColumn("slots", F.least("slots", F.col("due") - F.col("first"))).where("slots > 0")
    spread = runs.repartition(max(1, min(MOST_TASKS, -(-total // TASK_SLOTS))), "rank", "shard")
    slots = mapped(spread, _taker(seed, block), "shard long, slot long, rank long, pass long, block long, most long")

    cut = F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    pieces = rows.where("size > 0").select("uid", "rank", "at", "size", cut.alias("block"))
    low = F.greatest("at", F.col("block") * block)
    pieces = pieces.select("uid", "rank", "block", (low - F.col("at")).alias("word"), (low - F.col("block") * block).alias("skip"), (F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block) - low).alias("held"))
    # Both sides grow with the input, which the plan can't see through the maps: sorted, and not broadcast.
    met = slots.hint("merge").join(pieces.hint("merge"), ["rank", "block"]).withColumn("words", F.least("held", F.col("most") - F.col("skip"))).where("words > 0")
    if carry:
        rows = rows.join(base.select("uid", "row"), "uid")
    return rows, met.select("shard", "slot", "rank", "pass", "block", "uid", "word", "words")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what the mix takes of every document."""
    rows, taken = mix(own_columns(table(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    sums = taken.groupBy("uid").agg(F.sum("words").alias("taken"))
    joined = rows.hint("merge").join(sums.hint("merge"), "uid", "left")
    return joined.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as documents: for each pass that takes of a document, a row with the words taken, in their order.

    A pass that takes all of a document keeps its text as it is.
    """
    rows, taken = mix(docs, carry=docs.columns)
    passes = taken.groupBy("uid", "pass").agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("word", "words"))).alias("runs"))
    joined = rows.hint("merge").join(passes.hint("merge"), "uid").select("row", "size", "words", "runs")
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, size, n, runs in zip(pa.compute.struct_field(batch.column("row"), "text").to_pylist(), batch.column("size").to_pylist(), batch.column("words").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                if n < size:
                    words = text.encode().split()
                    text = b" ".join(w for r in runs for w in words[r["word"] : r["word"] + r["words"]]).decode()
                texts.append(text)
            fields = {f.name: c for f, c in zip(batch.schema.field("row").type, batch.column("row").flatten(), strict=True)}
            fields["text"] = pa.array(texts, pa.string())
            if "n_chars" in fields:
                fields["n_chars"] = pa.array(map(len, texts), fields["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))

    return mapped(joined, run, kinds)

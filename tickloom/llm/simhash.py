"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit of a fingerprint gets a vector of radius+1 bits; each non-zero vector v of that length selects the
bits whose vector has an odd product with v. Any radius differing bits span at most radius dimensions, so
some v is orthogonal to all of them, and that table's masked fingerprints are equal: every pair within the
radius meets in one of the 2^(radius+1)-1 tables. There are no false negatives and nothing is sampled.

Equal fingerprints are merged first (one representative, the smallest identifier), so a group of copies of
any size is one entry. Within a bucket a breadth-first walk over the entries not yet reached emits a
spanning forest, never all pairs. A bucket over BUCKET entries isn't gathered: its entries go on to another
covering over the bits they may still differ in. Each such level halves those bits, so after three levels a
bucket has at most 256 distinct entries.

Defined results: a null or empty text has fingerprint zero and is linked like any other. Fewer than `width`
words make one shingle. A null identifier keeps its row and links others, but names no component. Rows that repeat an
identifier count as that one document. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8, written
from tickloom.llm.components import components

#: Entries of a bucket that one task gathers; larger ones are split by a further covering.
BUCKET = 20_000
#: Shingles of a text that are hashed at a time, each of which takes 64 bytes.
SHINGLES = 1 << 18
#: Union-find entries that a task keeps to leave out edges it has already implied.
REMEMBERED = 400_000


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """The SimHash of UTF-8 text: XXH64 of each run of width words, majority of each bit."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    step = min(width, len(words)) - 1
    starts, ends = starts[: len(words) - step], ends[step:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES):
        some = zip(starts[at : at + SHINGLES].tolist(), ends[at : at + SHINGLES].tolist(), strict=True)
        ones += _ones(np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in some), np.uint64))
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = len(bits) // 255 * 255
    counts = bits[full:].sum(axis=0, dtype=np.int64)
    if full:  # sums of at most 255 ones fit a byte, which numpy adds in wide registers
        counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts


def masks(radius: int, level: int = 0) -> list[int]:
    """The covering's bit masks. Bits get the non-zero vectors in turn; a level deals them in another order."""
    vectors = (1 << (radius + 1)) - 1
    order = np.random.Generator(np.random.PCG64(level)).permutation(64)
    given = {int(bit): i % vectors + 1 for i, bit in enumerate(order)}
    return [sum(1 << b for b, vec in given.items() if (vec & v).bit_count() & 1) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp) with the fingerprint as a signed long."""
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), width, seed) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield batch_of({"id": batch.column("id"), "fp": pa.array(found.view(np.int64))}, schema)

    return mapped(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), utf8(text_col).alias("text")), run, "id long, fp long")


def _forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within radius, by index."""
    if len(fps) == 2:
        return [(0, 1)] if int(fps[0] ^ fps[1]).bit_count() <= radius else []
    edges, left = [], np.arange(len(fps))
    while left.size > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and left.size:
            x = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[x]) <= radius
            if near.any():
                hit = left[near].tolist()
                edges += [(x, h) for h in hit]
                queue += hit
                left = left[~near]
    return edges


def _buckets(radius: int, level: int, bucket: int):
    """Sorted (path, key, fp, id) to edges (a, b), and to entries of the next level where a bucket is too large."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("path", pa.int64()), ("key", pa.int64()), ("fp", pa.int64()), ("id", pa.int64())])
    base, deeper = [masks(radius, k) for k in range(level)], masks(radius, level)

    def agreed(path: int) -> int:
        """The bits that all entries of a bucket share."""
        out, tables = 0, len(deeper)
        for k in range(level - 1, -1, -1):
            out |= base[k][path % tables]
            path //= tables
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (up := parent.get(root, root)) != root:
                root = up
            while (up := parent.get(x, x)) != root and up != x:
                parent[x], x = root, up
            return root

        found: list[tuple[int, int]] = []

        def solve(fps: np.ndarray, ids: np.ndarray) -> None:
            if len(parent) > REMEMBERED:
                parent.clear()
            for i, j in _forest(fps, radius):
                x, y = find(a := int(ids[i])), find(b := int(ids[j]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((a, b))

        def edges() -> pa.RecordBatch:
            a, b = [x for x, _ in found], [y for _, y in found]
            found.clear()
            none = pa.nulls(len(a), pa.int64())
            return batch_of({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "path": none, "key": none, "fp": none, "id": none}, schema)

        def pushed(path: int, fps: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
            have = agreed(path)
            for at in range(0, len(fps), 4096):
                part, own = fps[at : at + 4096], ids[at : at + 4096]
                for v, m in enumerate(deeper):
                    none = pa.nulls(len(part), pa.int64())
                    yield batch_of({"a": none, "b": none, "path": pa.array(np.full(len(part), path * len(deeper) + v)), "key": pa.array((part & np.uint64(m | have)).view(np.int64)), "fp": pa.array(part.view(np.int64)), "id": pa.array(own)}, schema)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        now: tuple[int, int] | None = None
        large = False

        def finish() -> None:
            if held and not large and sum(len(f) for f, _ in held) > 1:
                solve(np.concatenate([f for f, _ in held]), np.concatenate([i for _, i in held]))
            held.clear()

        for batch in batches:
            path, key, fps, ids = (batch.column(c).to_numpy() for c in ("path", "key", "fp", "id"))
            fps = fps.view(np.uint64)
            if not len(path):
                continue
            cuts = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(path)]])
            wanted = (ends - starts > 1) | (starts == 0) | (ends == len(path))  # entries alone in their bucket have no partner
            for s, e in zip(starts[wanted].tolist(), ends[wanted].tolist(), strict=True):
                if now != (mine := (int(path[s]), int(key[s]))):
                    finish()
                    now, large = mine, False
                if large:
                    yield from pushed(now[0], fps[s:e], ids[s:e])
                    continue
                held.append((fps[s:e].copy(), ids[s:e].copy()))
                if sum(len(f) for f, _ in held) > bucket:
                    large = True
                    for f, i in held:
                        yield from pushed(now[0], f, i)
                    held.clear()
            if len(found) > 5000:
                yield edges()
        finish()
        if found:
            yield edges()

    return run


def links(entries: DataFrame, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) of forests that connect every pair of entries (id, fp) within radius. fp and id are distinct."""
    tables = F.array(*[F.struct(F.lit(v).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for v, m in enumerate(masks(radius))])
    now = entries.select(F.explode(tables).alias("t"), "fp", "id").select("t.path", "t.key", "fp", "id")
    out = None
    for level in (1, 2, 3, 4):
        placed = now.repartition("path", "key").sortWithinPartitions("path", "key")
        made = written(mapped(placed, _buckets(radius, level, bucket if level < 4 else 1 << 60), "a long, b long, path long, key long, fp long, id long"), "links")
        edges = made.where("a is not null").select("a", "b")
        out = edges if out is None else out.unionAll(edges)
        now = made.where("a is null").select("path", "key", "fp", "id")
        if now.isEmpty():
            break
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, width: int = 4, seed: int = 42, bucket: int = BUCKET) -> DataFrame:
    """(id, fp, component) for each row; component is the smallest identifier reachable over links within radius."""
    prints = written(fingerprints(own_columns(docs, id_col, text_col), id_col, text_col, width, seed), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    # Nodes are fingerprints, so rows without an identifier link others too. An identifier on several rows is one document: it links what they have.
    twice = prints.where("id is not null").groupBy("id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("id", "x")
    own = prints.join(twice, "id").select(F.col("fp").alias("a"), F.col("x").alias("b"))
    grouped = components(links(classes.select("fp", F.col("fp").alias("id")), radius, bucket).unionAll(own))
    joined = written(classes.join(grouped, F.col("fp") == F.col("node")).select("fp", "first", "component"), "joined")
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    named = joined.join(least, "component").select(F.col("fp").alias("of"), "least")
    return prints.join(classes, "fp").join(named, F.col("fp") == F.col("of"), "left").select("id", "fp", F.when(F.col("of").isNull(), F.col("first")).otherwise(F.col("least")).alias("component"))


def op5_simhash_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without all but the smallest identifier of each component; a null identifier stays."""
    gone = near_duplicates(docs).where("id <> component").select(F.col("id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")

"""Prefix trie of conversations by whole-sequence collapse.

Conversations are rebuilt, and every prefix gets a key: its length and the sum of a 128-bit hash of each turn at its
place. Identical conversations collapse into one weighted sequence with the list of those that end there. Sequences
that another one has as a proper prefix are found by an anti-join; the others are the leaves. Only then are prefixes
made, of distinct sequences alone, and weights, leaves and bytes are added up by prefix.

Sums over a subtree need no walk of the tree. A node belongs to its smallest member, so a sequence owns the end
of its own path, from one depth on, and what a node's subtree holds is the sum, over the sequences that pass through it, of what
they hold from that depth on. Running sums of bytes give that row by row.

Nothing holds a conversation, a group of copies or the children of a node in one place: turns are numbered by range-partitioned
running sums, running hashes are taken within blocks of turns and then over blocks, and groups are pre-aggregated. The one
sequential step is the digest of a list of members, as SHA-256 is; it streams over lists that are put together in parts.

Defined results: turns are ordered by turn (null first); those that share a turn by the digest of role and
text. Null role or text is empty. Rows without a conv_id are left out. Repeated rows are turns of their own. An empty table gives
no nodes. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, mapped, own_columns, table, utf8, written
from tickloom.llm.mixing import running

#: Conversations borrow from the first of so many identifiers, and at most MOST_BORROWED - 1 turns.
FAMILY, MOST_BORROWED = 5, 9
#: Turns whose hashes are summed in one window, and the range of identifiers whose list is put together at once.
BLOCK, LIST = 4096, 4096
_SUMS = ["s0", "s1", "s2", "s3"]
_KEY = ["depth", "k1", "k2"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, digest, bytes): every turn with its place in its conversation, from 0. Texts are read here and nowhere else."""
    role, text = utf8("role"), utf8("text")
    # The role's length before it tells where the text begins.
    whole = F.concat(F.concat(F.octet_length(role).cast("string"), F.lit(":")).cast("binary"), role, text)
    rows = own_columns(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null")
    narrow = rows.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.sha2(whole, 256).alias("digest"), F.octet_length(text).cast("long").alias("bytes"), F.lit(1).alias("one"))
    return running(written(narrow, "turns"), "conv", ["turn", "digest"], "one", "pos").select("conv", "pos", "digest", "bytes")


def borrowed_turns(conv: Column) -> Column:
    """How many turns conv takes from the first conversation of its family."""
    own = F.crc32(conv.cast("string").cast("binary")) % MOST_BORROWED
    return F.when(conv % FAMILY == 0, F.lit(0)).otherwise(own).cast("long")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, digest, bytes) of the rebuilt conversations, depth from 1; (conv) of all of them, turnless ones too)."""
    conv, h = F.col("conv"), borrowed_turns(F.col("conv"))
    sizes = numbered.groupBy("conv").agg(F.count("*").alias("n"))
    firsts = sizes.where(conv % FAMILY == 0).select(conv.alias("first"), F.col("n").alias("there"))
    heirs = written(sizes.where(conv % FAMILY != 0).withColumn("first", conv - conv % FAMILY).join(firsts, "first", "left").select("conv", "first", h.alias("h"), F.least(h, F.coalesce("there", F.lit(0))).alias("taken")), "heirs")
    # The first conversation is shorter than what is taken from it: the own turns move up.
    short = heirs.where("taken < h").select("conv", (F.col("h") - F.col("taken")).alias("gap"))
    own = numbered.where(F.col("pos") >= h).join(short, "conv", "left").select("conv", (F.col("pos") + 1 - F.coalesce("gap", F.lit(0))).alias("depth"), "digest", "bytes")
    heads = numbered.where((conv % FAMILY == 0) & (F.col("pos") < MOST_BORROWED - 1)).withColumnRenamed("conv", "first")
    taken = heads.join(heirs.where("taken > 0").select("conv", "first", "taken"), "first").where("pos < taken").select("conv", (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    return own.unionByName(taken), sizes.select("conv")


def hashed(rows: DataFrame) -> DataFrame:
    """rows (conv, depth, digest, bytes) with the hash of a turn at its place, in four parts of 32 bits that can be summed without overflow."""
    parts = []
    for salt in (0, 1):
        h = F.xxhash64(F.lit(salt), F.col("depth"), F.col("digest"))
        parts += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]
    return rows.select("conv", "depth", "bytes", *[p.alias(n) for p, n in zip(parts, _SUMS, strict=True)])


def _keys(sums: list[Column]) -> list[Column]:
    """The key of a prefix from the sums over its turns: two numbers of 64 bits."""
    low = [s.bitwiseAND(F.lit(0xFFFFFFFF)) for s in sums]
    return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]


def collapsed(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Distinct sequences: (conv, weight, depth, k1, k2, held, ends_sha256), conv the smallest that has it, held its bytes."""
    ends = rows.groupBy("conv").agg(F.count("*").alias("depth"), *[F.sum(s).alias(s) for s in _SUMS], F.sum("bytes").alias("held"))
    k1, k2 = _keys([F.coalesce(F.col(s), F.lit(0)) for s in _SUMS])
    whole = convs.join(ends, "conv", "left").select("conv", F.coalesce("depth", F.lit(0)).alias("depth"), k1.alias("k1"), k2.alias("k2"), F.coalesce("held", F.lit(0)).alias("held"))
    # Parts of the lists: conv ids are distinct, so a part has at most LIST of them.
    part = F.floor(F.col("conv") / LIST)
    lists = whole.groupBy(*_KEY, part.alias("part")).agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.max("held").alias("held"), F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
    schema = pa.schema([("conv", pa.int64()), ("weight", pa.int64()), ("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("held", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, weight, held, digest, ready = None, 0, 0, 0, None, []

        def close() -> None:
            ready.append((conv, weight, *now, held, digest.hexdigest()))

        def flush() -> pa.RecordBatch:
            out = batch_of({f.name: list(c) for f, c in zip(schema, zip(*ready, strict=True), strict=True)}, schema)
            ready.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                key = row["depth"], row["k1"], row["k2"]
                if key == now:
                    digest.update(b"," + row["ids"].encode())
                    weight += row["n"]
                else:
                    if now is not None:
                        close()
                    now, conv, weight, held, digest = key, row["conv"], row["n"], row["held"], hashlib.sha256(row["ids"].encode())
            if len(ready) >= 2000:
                yield flush()
        if now is not None:
            close()
            yield flush()

    gathered = lists.repartition(*_KEY).sortWithinPartitions(*_KEY, "part")
    return mapped(gathered, run, "conv long, weight long, depth long, k1 long, k2 long, held long, ends_sha256 string")


def prefixes(rows: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every prefix of every distinct sequence: (conv, depth, k1, k2, up1, up2, bytes, before), up the parent's key, before the bytes of the turns ahead."""
    named = rows.join(sequences.select("conv"), "conv").withColumn("block", F.expr(f"depth div {BLOCK}"))
    values = [*_SUMS, "bytes"]
    within = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = named.groupBy("conv", "block").agg(*[F.sum(v).alias(v) for v in values])
    bases = blocks.select("conv", "block", *[F.sum(v).over(ahead).alias(f"b_{v}") for v in values]).where("block > 0")
    summed = named.select("conv", "block", "depth", *[F.col(v).alias(f"o_{v}") for v in values], *[F.sum(v).over(within).alias(v) for v in values])
    based = summed.join(bases, ["conv", "block"], "left")
    total = {v: F.col(v) + F.coalesce(F.col(f"b_{v}"), F.lit(0)) for v in values}
    k1, k2 = _keys([total[s] for s in _SUMS])
    up1, up2 = _keys([total[s] - F.col(f"o_{s}") for s in _SUMS])
    below = based.select("conv", "depth", k1.alias("k1"), k2.alias("k2"), up1.alias("up1"), up2.alias("up2"), F.col("o_bytes").alias("bytes"), (total["bytes"] - F.col("o_bytes")).alias("before"))
    zero = F.lit(0).cast("long")
    roots = sequences.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"), zero.alias("bytes"), zero.alias("before"))
    return roots.unionByName(below)


def trie(conversations: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuilt(turns(conversations))
    rows = written(hashed(rows), "rebuilt")
    sequences = written(collapsed(rows, convs), "sequences")
    paths = written(prefixes(rows, sequences).join(sequences.select("conv", "weight", F.col("depth").alias("ends"), "held"), "conv"), "paths")

    # Leaves: sequences that are no proper prefix of another.
    owned = written(paths.groupBy(*_KEY).agg(F.min("conv").alias("conv"), F.max(F.col("ends") > F.col("depth")).alias("inner"), F.first("before").alias("before"), F.first("up1").alias("up1"), F.first("up2").alias("up2")), "owned")
    leaves = sequences.join(owned.where("inner").select(*_KEY), _KEY, "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))
    # From which depth on a sequence owns the nodes on its path, and the bytes ahead of them.
    starts = owned.groupBy("conv").agg(F.min("depth").alias("start"), F.min("before").alias("ahead"))
    about = sequences.select("conv").join(starts, "conv", "left").join(leaves, "conv", "left")

    # All copies' bytes from here on, less those that the sequence's own nodes need once.
    later = F.col("weight") * (F.col("held") - F.col("before"))
    once = F.when(F.col("start").isNull(), F.lit(0)).otherwise(F.col("held") - F.greatest("before", "ahead"))
    sums = paths.join(about, "conv").groupBy(*_KEY).agg(F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(later - once).alias("saved_tokens"), F.first("up1").alias("up1"), F.first("up2").alias("up2"))

    above = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("k1"), F.col("up2").alias("k2")]
    children = owned.where("depth > 0").select(*above).groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    parents = owned.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("up1"), F.col("k2").alias("up2"), F.col("conv").alias("parent_conv_id"))
    nodes = sums.join(children, _KEY, "left").join(sequences.select(*_KEY, "ends_sha256"), _KEY, "left").join(parents, ["depth", "up1", "up2"], "left")
    none = hashlib.sha256().hexdigest()
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all nodes of all conversations."""
    return trie(table(spark, sf_dir, "conversations"))


#: Independent of the plan above: prefixes are strings of digests, subtrees are found by comparing them.
ORACLE = """
WITH RECURSIVE poly(k, n, c) AS (
  SELECT 0, range, range FROM range(256)
  UNION ALL
  SELECT k + 1, n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM poly WHERE k < 8
), crcs AS (SELECT list(c ORDER BY n) AS tab FROM poly WHERE k = 8
), own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), walk(conv_id, i, c) AS (
  SELECT DISTINCT conv_id, 0, 4294967295::BIGINT FROM own
  UNION ALL
  SELECT conv_id, i + 1, xor(tab[(xor(c, ascii(substr(conv_id::VARCHAR, i + 1, 1))) & 255) + 1], c >> 8)
  FROM walk, crcs WHERE i < length(conv_id::VARCHAR)
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(c, 4294967295) % 9 AS h FROM walk WHERE i = length(conv_id::VARCHAR)
), moved AS (
  SELECT c.conv_id, 0 AS own, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth, sha256(length(role) || ':' || role || text) AS digest, strlen(text) AS bytes FROM moved
), members AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth), bytes FROM placed
), longest AS (SELECT conv_id, max(depth) AS depth FROM members GROUP BY 1
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes, left(path, 64 * (depth - 1)) AS up FROM members GROUP BY path, depth
), ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM members JOIN longest USING (conv_id, depth) GROUP BY path
), kids AS (SELECT up AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up
), below AS (
  SELECT v.path, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.bytes)::BIGINT AS saved_tokens
  FROM nodes v JOIN nodes u ON starts_with(u.path, v.path) LEFT JOIN kids k ON k.path = u.path GROUP BY v.path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves, b.saved_tokens,
       sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN kids k ON k.path = n.path LEFT JOIN ends e ON e.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.up
"""

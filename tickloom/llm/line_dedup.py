"""Line deduplication by an exact set-similarity join. DataFrame functions only.

A line is the set of its lower-cased words. Lines that are alike but for white space and case are one class,
found by a hash aggregation that combines before it shuffles, so copies never meet each other. Classes
are joined at a Jaccard similarity of at least num/den:

- tokens get a global order, rare ones first: a token is 56 bits of its word's hash behind a rank of 7 bits. Long words are
  rare in most texts, so the rank is taken from the word's length, without a pass over all words. Where that leaves more than half
  of the prefixes to frequent tokens, words are counted over all classes in BUCKETS hash buckets (a table of fixed size), and the rank is the logarithm of a bucket's count;
- prefix filter: two similar sets share SHARED tokens in their first n-ceil(t*n)+SHARED tokens, and the smaller one even
  in its first n-ceil(2t/(1+t)*n)+SHARED;
- length filter: the smaller has at least t times the larger's tokens;
- positional filter: what a pair shares in its prefixes and the tokens left behind the last of that must be able to reach the overlap needed;
- the rest is verified on the whole sets.

Each entry also carries a signature, one bit of 128 for each token, of which smaller sets keep the first 64: a bit that only one of two sets has
is a token that only it has, which bounds their overlap before any set is fetched.

Tokens, but the rarest, are joined on the token and a band of sizes, the larger sets' whole prefixes with the smaller ones' short ones, each of which
is in its own band and the next one up; sets of other sizes can't be similar, so a token's chance pairs are never made for most of the classes that hold it.
Of tokens in more than RARE prefixes, many of them of one band or before the same token, the frequent ones, those that chance brings together are told from groups of near copies by the next common token, which lies in both
prefixes too: pairs of tokens are joined in the same way. Pairs in more than RARE classes again are cut by the sets' sizes into bands, of which only
neighbouring ones can be similar, and these into chunks of CHUNK classes, whose sets are told by what they lack and add against one of the
classes; every two such chunks of a pair meet in one row, whose pairs are made, verified and summed by class without being written. Two classes with the same token before one of the pair have met there, which is seen first, so that
copies with small changes, which share most of their tokens, are compared in full about once, and chunks with the same usual token before
don't meet at all. So no row is ever kept for each pair of a large group,
no group is gathered beyond a chunk, and no pair is lost. A pair is counted once, at its first common token or tokens.

A line stays if it is its class's first occurrence (by document, then line) and no similar class occurs
before it.

Defined results: a null text has no lines; lines without words always stay and match nothing. Null identifiers
come last and count as one document. Rows that repeat an identifier are one document: their lines are counted
together, and each of the rows is returned. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import discard, own_columns, table, written

NUM, DEN = 4, 5
BUCKETS, RARE, CHUNK = 1 << 18, 512, 128
#: Bits of a word's hash in its token, below the rank.
BITS = 56
#: So many chunks of a pair of tokens are left in one task.
TOGETHER = 8
#: Hash buckets of the keys that are wanted, of which a broadcast holds no more.
LIKELY = 1 << 21
#: Sets of so many tokens carry the second half of the signature.
WIDE = 64
#: Words of so many bytes, or in 64 classes at most where they are counted, are rare enough to be joined without bands.
LONG = 9
#: Tokens are joined in so many parts, one after the other, which bounds the disk that they take by a share of the input; each part reads all prefixes, so their number doesn't grow with the input.
#: Pairs of frequent tokens go in parts of no more rows than such a part has, or than PART.
PARTS, PART = 3, 1 << 24
#: Tokens that a pair must share in its prefixes, or all it needs if that's less. One more makes prefixes one longer, and rules out most pairs that meet by chance.
SHARED = 2
#: Ranks for each doubling of a bucket's count.
STEPS = 4
#: Lines are placed by identifier and line number in one number; null identifiers come last. A text has fewer lines than _LINES, as it has fewer bytes.
_LINES = 1 << 31
_PLACE = "decimal(30,0)"
_LAST = "9223372036854775808"


def _ceil(n: Column, num: int, den: int) -> Column:
    return F.floor((n * num + (den - 1)) / F.lit(den)).cast("int")


def lines_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line, norm): lines with a word."""
    text, other = F.col(f"`{text_col}`"), "\t\x0b\x0c\r"
    # Whole texts are searched and lower-cased much faster than their lines one by one, and few need the replacement.
    needs = reduce(or_, [F.contains(text, F.lit(c)) for c in [*other, "  "]])
    clean = F.when(needs, F.regexp_replace(text, f"[ {other}]+", " ")).otherwise(text)
    rows = own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.posexplode(F.split(F.lower(clean), "\n")).alias("line", "raw"))
    return rows.select("id", "line", F.trim("raw").alias("norm")).where("norm <> ''")


def _place() -> Column:
    return F.expr(f"CAST(coalesce(CAST(id AS DECIMAL(20,0)), {_LAST}BD) * {_LINES}BD + line AS {_PLACE})")


def _tokens(norm: Column) -> Column:
    """The line's set as sorted longs: a rank from 1 on, lower for longer words, then the hash."""
    token = lambda w: F.shiftleft((127 - F.least(F.octet_length(w), F.lit(126))).cast("long"), BITS).bitwiseOR(F.shiftrightunsigned(F.xxhash64(w), 64 - BITS))
    return F.sort_array(F.array_distinct(F.transform(F.split(norm, " "), token)))


def ranks(classes: DataFrame) -> bytes:
    """A byte a bucket: STEPS times the logarithm of how many classes its words occur in, at most 127. Of fixed size whatever the input."""
    counted = classes.select(F.explode_outer("tokens").alias("t")).groupBy(F.col("t").bitwiseAND(BUCKETS - 1).cast("int").alias("b")).agg(F.count("*").alias("n"))
    found = counted.select("b", F.least(F.lit(127), F.floor(F.log2(F.col("n").cast("double")) * STEPS).cast("int")).alias("r")).toArrow()
    out = np.zeros(BUCKETS, np.uint8)
    out[found["b"].to_numpy()] = found["r"].to_numpy()
    return out.tobytes()


def _ranked(tokens: Column, ranked: bytes) -> Column:
    """tokens, sorted by the ranks of their buckets. One of rank 0 is in no other class."""
    # Spark folds this into one array constant.
    known = F.split(F.lit(",".join(map(str, ranked))), ",").cast("array<tinyint>")
    rank = lambda t: F.get(known, t.bitwiseAND(BUCKETS - 1).cast("int")).cast("long")
    # Read from a table, an array may hold nulls as far as Spark knows; without that possibility it sorts plain numbers.
    return F.sort_array(F.transform(tokens, lambda t: F.coalesce(F.shiftleft(rank(t), BITS).bitwiseOR(t.bitwiseAND((1 << BITS) - 1)), F.lit(0).cast("long"))))


def _bit(token: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(63).cast("int"))


def _signature(tokens: Column, kind: int) -> Column:
    half = F.filter(tokens, lambda t: t.bitwiseAND(64) == kind)
    return F.aggregate(half, F.lit(0).cast("long"), lambda s, t: s.bitwiseOR(_bit(t)))


class _Filters:
    """The filters at threshold num/den, as conditions on two entries with n and i (the shared token's place)."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n: Column) -> Column:
        return n - _ceil(n, self.num, self.den) + SHARED

    def indexed(self, n: Column) -> Column:
        return n - _ceil(n, 2 * self.num, self.num + self.den) + SHARED

    def need(self, both: Column) -> Column:
        """The overlap of a similar pair with so many tokens in all."""
        return _ceil(both, self.num, self.num + self.den)

    def may(self, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        """Whether entries x and y, of which x has the larger set, can be of a similar pair; each gives its n, i and sig."""
        return (y("i") < self.indexed(y("n"))) & self.near(x, y)

    def near(self, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        """The same by sizes and signatures alone."""
        enough = lambda overlap: overlap * (self.num + self.den) >= (x("n") + y("n")) * self.num
        only = lambda a, b, sig: F.bit_count(a(sig).bitwiseAND(F.bitwise_not(b(sig))))
        wide = (x("n") >= WIDE) & (y("n") >= WIDE)
        lacks = lambda a, b: only(a, b, "sig") + F.when(wide, only(a, b, "sig2")).otherwise(0)
        return (y("n") * self.den >= x("n") * self.num) & enough(x("n") - lacks(x, y)) & enough(y("n") - lacks(y, x))

    def first(self, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        """Whether they can be such a pair's first common tokens."""
        return F.least(x("n") - x("i"), y("n") - y("i")) * (self.num + self.den) >= (x("n") + y("n")) * self.num

    def similar(self, n: Column, m: Column, common: Column) -> Column:
        return common * (self.num + self.den) >= (n + m) * self.num

    def band(self, n: Column) -> Column:
        """Sets of similar size are in the same band or in neighbouring ones."""
        return F.floor(F.log(n.cast("double")) / F.log(F.lit(self.den / self.num)) * (1 - 1e-9)).cast("int")


def _likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """rows without most of those whose key isn't wanted, before any is moved: by a broadcast of wanted's hash buckets, of which there are never more than LIKELY."""
    bucket = F.xxhash64(key).bitwiseAND(LIKELY - 1).cast("int")
    return rows.join(F.broadcast(wanted.select(bucket.alias("bucket")).distinct()), bucket == F.col("bucket"), "left_semi")


def _entries(sets: DataFrame) -> DataFrame:
    """A row for each token in the prefix of each set. A token of rank 0 is in no other class."""
    return sets.select("cid", "n", "sig", "sig2", "prefix", F.posexplode("prefix").alias("i", "token")).where(F.col("token") >= 1 << BITS)


def _once(value: Column) -> Column:
    """value as a generator's only row. Generated code computes it, once a row, where a lambda function, a filter or an aggregate over it would have it interpreted, or again for each use."""
    return F.explode(F.array(value))


def _part(df: DataFrame, key: str, k: int, parts: int) -> DataFrame:
    return df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == k)


def _frequent(entries: DataFrame, frequent: DataFrame) -> DataFrame:
    """The entries of frequent tokens. There are never more of these than one for each RARE entries."""
    return entries.join(F.broadcast(frequent), "token", "left_semi")


def _doubles(entries: DataFrame) -> DataFrame:
    """A row for each token after an entry's own in the same prefix, second, at i2; a set of one token has 0 for it.

    prev and prev2 are the tokens before token and before second, as far as they are others than these, or else a number of the class's own.
    """
    none = -F.col("cid") - 1
    rest = entries.withColumn("prev", F.when(F.col("i") > 0, F.get("prefix", F.col("i") - 1)).otherwise(none)).withColumn("rest", F.expr("slice(prefix, i + 2, size(prefix))"))
    seconds = rest.select("cid", "n", "sig", "sig2", "i", "token", "prev", "rest", F.posexplode_outer("rest").alias("j", "second")).where("second is not null or n = 1")
    prev2 = F.when(F.col("j") > 0, F.get("rest", F.col("j") - 1)).otherwise(none)
    return seconds.select("cid", "n", "sig", "sig2", "i", (F.col("i") + 1 + F.coalesce("j", F.lit(0))).alias("i2"), "token", F.coalesce("second", F.lit(0).cast("long")).alias("second"), "prev", prev2.alias("prev2"))


def _total(found: DataFrame) -> DataFrame:
    return found.groupBy("cid").agg(F.sum("links").alias("links"), F.min("earliest").alias("earliest"))


def _of_pairs(pairs: DataFrame, known: DataFrame, f: _Filters) -> DataFrame:
    """(cid, links, earliest) of verified pairs (cid, other, i, i2), of which each counts at its first common tokens only: those at i and i2 of cid's; a null i2 is not asked for."""
    n, m = F.size("tokens"), F.size("other_tokens")
    others = known.select(F.col("cid").alias("other"), F.col("first").alias("other_first"), F.col("tokens").alias("other_tokens"))
    both = pairs.join(known, "cid").join(others, "other")
    both = both.select("cid", "other", "i", "i2", "first", "other_first", "tokens", n.alias("n"), m.alias("m"), _once(F.array_intersect("tokens", "other_tokens")).alias("common"))
    same = lambda k, i: F.coalesce(F.get("common", F.lit(k)), F.lit(0).cast("long")) == F.coalesce(F.get("tokens", F.col(i)), F.lit(0).cast("long"))
    at = same(0, "i") & (F.col("i2").isNull() | same(1, "i2"))
    found = both.where(f.similar(F.col("n"), F.col("m"), F.size("common")) & at)
    ends = F.array(F.struct("cid", F.col("other_first").alias("earliest")), F.struct(F.col("other").alias("cid"), F.col("first").alias("earliest")))
    return _total(found.select(F.explode(ends).alias("e")).select("e.cid", F.lit(1).cast("long").alias("links"), "e.earliest"))


def _of_chunks(doubles: DataFrame, known: DataFrame, f: _Filters, chunk: int) -> DataFrame:
    """(cid, links, earliest) of what is similar within frequent pairs of tokens.

    Classes with the same prev or the same prev2 share an earlier token and are not compared here. So those with a key's most common prev
    never meet each other, nor do those with its most common prev2, which leaves little to compare in a group of near copies.
    A set is told by what it lacks and adds against one class of its key, the base: near copies' overlaps are counted on a few tokens, not on whole sets.
    """
    key, kind = ["token", "second"], ["usual", "usual2", "band"]
    counts = [doubles.groupBy(*key, c).agg(F.count("*").alias("c"), F.min("cid").alias("base")).groupBy(*key).agg(F.sum("c").alias("all"), F.min("base").alias("base"), F.max_by(c, F.struct("c", c)).alias(f"{c}_most")) for c in ("prev", "prev2")]
    # A key of many chunks is spread over tasks, each of which meets all of them with its share.
    spread = F.ceil(F.sqrt(F.col("all") / (chunk * TOGETHER))).cast("int").alias("spread")
    keys = counts[0].join(counts[1].drop("all", "base"), key).join(known.select(F.col("cid").alias("base"), F.col("tokens").alias("base_tokens")), "base").select(*key, "prev_most", "prev2_most", spread, "base_tokens")
    keys = written(keys, "keys", "lz4")
    usual = [(F.col(c) == F.col(f"{c}_most")).alias(u) for c, u in (("prev", "usual"), ("prev2", "usual2"))]
    banded = doubles.join(keys.drop("base_tokens", "spread"), key).select(*doubles.columns, *usual, f.band(F.col("n")).alias("band"))
    sizes = banded.groupBy(*key, *kind).agg(F.count("*").alias("c")).join(keys.drop("prev_most", "prev2_most"), key)
    placed = banded.join(sizes, [*key, *kind]).withColumn("k", F.pmod(F.xxhash64("cid"), F.ceil(F.col("c") / chunk)))
    before = F.array_except(F.slice("tokens", F.lit(1), F.col("i2")), F.array("token", "second"))
    lacks, adds = F.array_except("base_tokens", "tokens"), F.array_except("tokens", "base_tokens")
    members = F.struct("cid", "n", "i", "sig", "sig2", "prev", "prev2", "first", before.alias("before"), lacks.alias("lacks"), adds.alias("adds"))
    told = placed.join(known, "cid").select(*key, *kind, "k", "spread", _once(members).alias("member"))
    packed = written(told.groupBy(*key, *kind, "k", "spread").agg(F.collect_list("member").alias("members")), "packed", "lz4")

    x, y = F.col("x"), F.col("y")
    larger = (x.n > y.n) | ((x.n == y.n) & (x.cid > y.cid))
    apart = (x.prev != y.prev) & (x.prev2 != y.prev2)
    of_base = x.n - F.size(x.adds) - F.size(y.lacks) + F.size(F.array_intersect(x.lacks, y.lacks))
    alike = f.similar(x.n, y.n, of_base + F.size(F.array_intersect(x.adds, y.adds)))
    match = larger & apart & f.first(x.getField, y.getField) & f.may(x.getField, y.getField) & ~F.arrays_overlap(x.before, y.before) & alike

    salts = {"x": F.pmod(F.xxhash64("k", *kind), F.col("spread")).cast("int"), "y": F.explode(F.sequence(F.lit(0), F.col("spread") - 1))}
    left, right = (packed.select(*key, salt.alias("salt"), F.struct(*kind).alias(f"{c}_kind"), F.col("members").alias(f"{c}s")) for c, salt in salts.items())
    kinds = lambda name: (F.col(f"x_kind.{name}"), F.col(f"y_kind.{name}"))
    both = lambda name: kinds(name)[0] & kinds(name)[1]
    meet = (F.abs(kinds("band")[0] - kinds("band")[1]) <= 1) & ~both("usual") & ~both("usual2")
    met = left.hint("merge").join(right, [*key, "salt"]).where(meet).select("xs", "ys")
    # The pairs of two chunks are made and dropped one by one within generated code.
    found = met.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y")).where(match)
    ends = F.array(F.struct(x.cid.alias("cid"), y.first.alias("earliest")), F.struct(y.cid.alias("cid"), x.first.alias("earliest")))
    return _total(found.select(F.explode(ends).alias("e")).select("e.cid", F.lit(1).cast("long").alias("links"), "e.earliest"))


def _sets(classes: DataFrame, tokens: Column, f: _Filters) -> DataFrame:
    """(cid, n, sig, sig2, prefix) of classes whose sets are tokens."""
    sets, size = classes.select("cid", tokens.alias("tokens")), F.size("tokens")
    sigs = [_signature(F.col("tokens"), 0).alias("sig"), F.when(size >= WIDE, _signature(F.col("tokens"), 64)).otherwise(0).alias("sig2")]
    sets = sets.select("cid", size.alias("n"), *sigs, F.slice("tokens", F.lit(1), f.prefix(size)).alias("prefix"))
    return written(sets, "prefixes", "lz4")


def _often(sets: DataFrame, f: _Filters, rare: int) -> tuple[DataFrame, int, int]:
    """Frequent tokens, how many entries these have, and how many all have.

    They are in more than rare prefixes, and in more than twice as many of one band of sizes, or in more than half as many before the same token, as they are in a group of near copies.
    """
    bucket = F.xxhash64("token").bitwiseAND(BUCKETS - 1).cast("int").alias("bucket")
    entries = _entries(sets).select("token", f.band(F.col("n")).alias("band"), F.get("prefix", F.col("i") + 1).alias("after"), bucket)
    # Most tokens are ruled out by their buckets, before they are told from each other.
    buckets = written(entries.groupBy("bucket").agg(F.count("*").alias("c")), "counts")
    some = entries.join(F.broadcast(buckets.where(F.col("c") > rare).select("bucket")), "bucket", "left_semi")
    bands = some.groupBy("token", "band").agg(F.count("*").alias("c")).groupBy("token").agg(F.sum("c").alias("c"), (F.max("c") > 2 * rare).alias("often"))
    afters = some.where("after is not null").groupBy("token", "after").agg(F.count("*").alias("c")).groupBy("token").agg(F.lit(0).cast("long").alias("c"), (2 * F.max("c") > rare).alias("often"))
    both = bands.unionAll(afters).groupBy("token").agg(F.sum("c").alias("c"), F.bool_or("often").alias("often"))
    frequent = written(both.where((F.col("c") > rare) & F.col("often")).select("token", "c"), "counts")
    hot, every = (t.agg(F.sum("c")).first()[0] or 0 for t in (frequent, buckets))
    return frequent.select("token"), hot, every


def similar_classes(classes: DataFrame, num: int = NUM, den: int = DEN, rare: int = RARE, chunk: int = CHUNK) -> DataFrame:
    """(cid, links, earliest): for each class (cid, tokens, first) with similar ones, how many, and the first place of the earliest of them."""
    f, col = _Filters(num, den), F.col
    tokens, common = col("tokens"), 128 - LONG
    sets = _sets(classes, tokens, f)
    frequent, hot_entries, all_entries = _often(sets, f, rare)
    if 2 * hot_entries > all_entries:  # lengths don't tell which words are rare
        discard(sets)
        tokens, common = _ranked(tokens, ranks(classes)), 6 * STEPS
        sets = _sets(classes, tokens, f)
        frequent, hot_entries, all_entries = _often(sets, f, rare)
    some = hot_entries > 0
    entries = _entries(sets)
    larger = (col("x.n") > col("y.n")) | ((col("x.n") == col("y.n")) & (col("x.cid") > col("y.cid")))
    fields = (lambda c: col(f"x.{c}"), lambda c: col(f"y.{c}"))

    def met(k: int) -> DataFrame:
        part = _part(entries, "token", k, PARTS)
        part = part.join(F.broadcast(frequent), "token", "left_anti") if some else part
        plain, band = col("token") < common << BITS, f.band(col("n")) + 1
        keys = [col("token").bitwiseAND((1 << BITS) - 1).bitwiseOR(F.shiftleft(b.cast("long"), BITS)) for b in (F.lit(0), band, band + 1)]
        x = part.select("cid", "n", "sig", "sig2", "i", F.when(plain, keys[0]).otherwise(keys[1]).alias("key"))
        y = part.where(col("i") < f.indexed(col("n"))).select("cid", "n", "sig", "sig2", "i", F.explode(F.when(plain, F.array(keys[0])).otherwise(F.array(*keys[1:]))).alias("key"))
        both = x.alias("x").hint("merge").join(y.alias("y"), (col("x.key") == col("y.key")) & larger & f.near(*fields))
        return both.groupBy(col("x.cid").alias("cid"), col("y.cid").alias("other")).agg(F.min("x.i").alias("i"), F.count("*").alias("shared"), *[F.max(c).alias(c.replace(".", "_")) for c in ("x.n", "x.i", "y.n", "y.i")])

    # Each part is written by itself, so that its shuffle files are gone before the next one's are made.
    found = reduce(DataFrame.unionAll, [written(met(k), "met") for k in range(PARTS)])
    pairs = found.groupBy("cid", "other").agg(F.min("i").alias("i"), F.sum("shared").alias("shared"), *[F.max(c).alias(c) for c in ("x_n", "x_i", "y_n", "y_i")])
    need = f.need(col("x_n") + col("y_n"))
    enough = (col("shared") >= F.least(F.lit(SHARED), need)) & (col("shared") + F.least(col("x_n") - col("x_i"), col("y_n") - col("y_i")) - 1 >= need)
    if some:  # frequent tokens are not among those that were counted
        ids = written(_frequent(entries, frequent).groupBy("cid").agg(F.bit_or(_bit(col("token"))).alias("hot")), "hot")
        hot_sets = written(_likely(sets, "cid", ids).join(ids, "cid", "left_semi"), "hot", "lz4")
        others = ids.select(col("cid").alias("other"), col("hot").alias("other_hot"))
        # Null where one of them has no frequent token.
        may_share = F.coalesce(col("hot").bitwiseAND(col("other_hot")) != 0, F.lit(False))
        pairs = pairs.join(ids, "cid", "left").join(others, "other", "left").where(enough | may_share)
    else:
        pairs = pairs.where(enough)
    pairs = [written(pairs.select("cid", "other", "i", F.lit(None).cast("int").alias("i2")), "pairs")]

    # A pair whose first common token is frequent has a second one in both prefixes, or is of sets of one token.
    often, hot_parts, may = [], 0, larger & f.may(*fields)
    if some:
        rows = _frequent(_entries(hot_sets), frequent).agg(F.sum(F.size("prefix") - col("i"))).first()[0] or 0
        hot_parts = -(-rows // max(PART, all_entries // PARTS))
    for k in range(hot_parts):
        doubles = _doubles(_frequent(_part(_entries(hot_sets), "token", k, hot_parts), frequent))
        both = written(doubles.groupBy("token", "second").agg(F.count("*").alias("c")).where(col("c") > rare).select("token", "second"), "counts")
        often.append(written(doubles.join(both, ["token", "second"]), "frequent"))
        rest = doubles.join(both, ["token", "second"], "left_anti")
        once = (col("x.prev") != col("y.prev")) & (col("x.prev2") != col("y.prev2")) & f.first(lambda c: col(f"x.{c}"), lambda c: col(f"y.{c}"))
        within = col("y.i2") < F.greatest(F.lit(2), f.indexed(col("y.n")))
        joined = rest.alias("x").hint("merge").join(rest.alias("y"), (col("x.token") == col("y.token")) & (col("x.second") == col("y.second")) & may & within & once)
        pairs.append(written(joined.select(col("x.cid").alias("cid"), col("y.cid").alias("other"), "x.i", "x.i2"), "pairs"))
    discard(sets)

    pairs = reduce(DataFrame.unionAll, pairs)
    ends = [pairs.select(F.explode(F.array("cid", "other")).alias("cid"))] + [t.select("cid") for t in often]
    wanted = written(reduce(DataFrame.unionAll, ends).distinct(), "wanted")
    known = written(_likely(classes, "cid", wanted).join(wanted, "cid", "left_semi").select("cid", "first", tokens.alias("tokens")), "sets", "lz4")
    matched = [_of_pairs(pairs, known, f), *[_of_chunks(t, known, f, chunk) for t in often if not t.isEmpty()]]
    return _total(reduce(DataFrame.unionAll, [written(x, "matched") for x in matched]))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUM, den: int = DEN, rare: int = RARE, chunk: int = CHUNK) -> DataFrame:
    """(id, line, removed, links, earliest) for each line whose class has copies or similar classes; other lines stay."""
    lines = lines_of(docs, id_col, text_col)
    key, more = F.xxhash64("norm"), F.xxhash64(F.lit(1), F.col("norm"))
    classes = lines.groupBy("norm").agg(F.min(_place()).alias("first"), F.count("*").alias("copies"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), key.alias("k1"), more.alias("k2"), "first", "copies", _tokens(F.col("norm")).alias("tokens")), "lines", "lz4")
    linked = written(similar_classes(classes, num, den, rare, chunk), "linked")
    told = classes.drop("tokens").join(linked, "cid", "left").where("copies > 1 or links is not null")
    told = written(told.select("k1", "k2", "first", F.coalesce("links", F.lit(0)).alias("links"), F.least("first", "earliest").alias("earliest")), "told")
    placed = _likely(lines.withColumn("k1", key), "k1", told).select("id", "line", "k1", more.alias("k2"), _place().alias("place"))
    return placed.join(told, ["k1", "k2"]).select("id", "line", ((F.col("place") > F.col("first")) | (F.col("earliest") < F.col("first"))).alias("removed"), "links", "earliest")


def cleaned(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the removed lines; found is dedup_lines(docs)."""
    gone = found.where("removed").groupBy(F.col("id").alias("key")).agg(F.collect_set("line").alias("gone"))
    # docs' columns are kept in one, so that none can clash.
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("key")), "left")
    old = F.col("row").getField(text_col)
    text = F.when(F.col("gone").isNull(), old).otherwise(F.array_join(F.filter(F.split(old, "\n"), lambda _, i: ~F.array_contains("gone", i)), "\n"))
    return joined.select(*[(text if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its lines, those removed, the links of its lines to other classes, and class_id: the first document with a line equal or similar to one of its own."""
    docs = table(spark, sf_dir, "documents")
    found = dedup_lines(docs)
    first_doc = F.floor(F.col("earliest") / F.lit(_LINES)).cast("decimal(20,0)")
    by_doc = found.groupBy(F.col("id").alias("_id")).agg(F.sum(F.col("removed").cast("long")).alias("removed"), F.sum("links").alias("links"), F.min(first_doc).alias("first_doc"))
    ends = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    rows = docs.select("doc_id", F.coalesce(ends + 1, F.lit(0)).cast("long").alias("n_lines"))
    own = F.when(F.col("first_doc") < F.lit(_LAST).cast("decimal(20,0)"), F.col("first_doc").cast("long"))
    return rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
        "doc_id", "n_lines", F.coalesce("removed", F.lit(0)).alias("n_removed"), F.coalesce("links", F.lit(0)).alias("n_links"), F.least(F.coalesce(own, F.col("doc_id")), F.col("doc_id")).alias("class_id")
    )

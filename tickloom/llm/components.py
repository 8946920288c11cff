"""Connected components over a distributed edge list: alternating large and small stars.

Every round is two hash aggregations (which combine before they shuffle) and two equi-joins (which adaptive
execution splits when one node has many neighbours). No edge ever reaches the driver; only a count and a
checksum do, to see whether a round changed anything. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import discard, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u > v), one star operation on."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return hung.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that edges (a, b) name; component is the smallest node reachable.

    Null ends and loops are ignored; no edges give no rows. Long chains shrink by more than half a round.
    """
    now = written(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:  # each round either leaves all as it is or hangs a node lower
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen.n, seen.s) == mark or not seen.n:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = (seen.n, seen.s)
        after = written(_stars(_stars(now, True), False), "edges")
        discard(now)
        now = after

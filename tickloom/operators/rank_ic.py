"""Rank information coefficient of features against labels, by day, with a block bootstrap over days.

Ranks are halves of whole numbers, so a day's correlation is exact up to its root. The bootstrap resamples whole days by Poisson
weights that a hash of seed, replicate and day gives: no row is copied, and any task finds the same weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Poisson weights beyond this have a probability under 1e-10.
MOST_WEIGHT = 12


def _twice_rank(value: str, group: list[str]) -> Column:
    """Twice the mean rank of tied values: whole numbers."""
    tied = F.count("*").over(Window.partitionBy(*group, value))
    return 2 * F.rank().over(Window.partitionBy(*group).orderBy(value)) + tied - 1


def rank_ic(rows: DataFrame, features: list[str], label: str, block: str = "trade_date") -> DataFrame:
    """(block, feature, n, ic): Spearman's correlation with tied ranks over each block's rows where both are defined; null where either doesn't vary."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
    long = rows.select(block, F.col(label).cast("double").alias("y"), F.explode(pairs).alias("p")).select(block, "p.feature", "p.x", "y")
    long = long.where("x is not null and y is not null and not isnan(x) and not isnan(y)")
    group = [block, "feature"]
    ranked = long.select(*group, _twice_rank("x", group).cast("decimal(18,0)").alias("a"), _twice_rank("y", group).cast("decimal(18,0)").alias("b"))
    s = lambda c: F.sum(c).cast("double")
    sums = ranked.groupBy(*group).agg(F.count("*").alias("n"), s(F.col("a")).alias("a"), s(F.col("b")).alias("b"), s(F.col("a") * F.col("b")).alias("ab"), s(F.col("a") * F.col("a")).alias("aa"), s(F.col("b") * F.col("b")).alias("bb"))
    spread = (F.col("n") * F.col("aa") - F.col("a") * F.col("a")) * (F.col("n") * F.col("bb") - F.col("b") * F.col("b"))
    return sums.select(*group, "n", F.when(spread > 0, (F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(F.when(spread > 0, spread))).alias("ic"))


def poisson_weight(seed: int, replicate: Column, block: Column) -> Column:
    """A Poisson weight of mean 1 by the hash of seed, replicate and block."""
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), replicate.cast("string"), block.cast("string"))), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)
    weight, reached = F.lit(0), 0.0
    for k in range(MOST_WEIGHT):
        reached += math.exp(-1) / math.factorial(k)
        weight = weight + (u >= F.lit(reached)).cast("int")
    return weight


def bootstrap(ics: DataFrame, replicates: int = 200, seed: int = 7, level: float = 0.95, block: str = "trade_date") -> DataFrame:
    """(feature, blocks, mean_ic, low, high): the mean over blocks and its interval over resampled blocks. ics: rank_ic()'s rows."""
    known = ics.where("ic is not null")
    drawn = known.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", poisson_weight(seed, F.col("replicate"), F.col(block)))
    means = drawn.groupBy("feature", "replicate").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("ic")).alias("s")).where("w > 0").withColumn("m", F.col("s") / F.col("w"))
    tail = (1 - level) / 2
    ends = means.groupBy("feature").agg(F.percentile("m", F.lit(tail)).alias("low"), F.percentile("m", F.lit(1 - tail)).alias("high"))
    return known.groupBy("feature").agg(F.count("*").alias("blocks"), F.avg("ic").alias("mean_ic")).join(ends, "feature", "left")

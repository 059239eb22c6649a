"""Pre-aggregate (A6): a mergeable rollup of titles by
(primaryGenre, titleType, decade).

The rollup keeps *sums and counts*, never averages, so any coarser grouping
re-aggregated from it is exact: avg = sum(rating_sum) / sum(rated). Storing
per-group averages and averaging them again would weight small groups wrong.
Both steps are partial-then-final hash aggregates; the rollup has at most
(#genres x #kinds x #decades) rows regardless of data size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLLUP_KEYS = ("primaryGenre", "titleType", "decade")


def build_rollup(titles: DataFrame, keys=ROLLUP_KEYS) -> DataFrame:
    return (titles.groupBy(*keys)
            .agg(F.sum(F.col("averageRating").cast("double")).alias("rating_sum"),
                 F.count("averageRating").alias("rated"),
                 F.sum(F.col("numVotes").cast("long")).alias("total_votes"),
                 F.count(F.lit(1)).alias("cnt")))


def merge_rollups(rollups: list[DataFrame], keys=ROLLUP_KEYS) -> DataFrame:
    """One rollup of all rows that several cover: their sums and counts added,
    without looking at the rows again."""
    every = reduce(DataFrame.unionByName, rollups)
    return every.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("rating_sum", "rated", "total_votes", "cnt")])


def with_avg(rollup: DataFrame, digits: int = 2) -> DataFrame:
    """The reference's projection columns: avg_rating, total_votes, cnt."""
    return rollup.withColumn("avg_rating", F.round(F.try_divide("rating_sum", "rated"), digits))


def coarsen(rollup: DataFrame, keys: list[str], digits: int = 2) -> DataFrame:
    """Re-aggregate the rollup to fewer keys; exact because it merges sums."""
    return (rollup.groupBy(*keys)
            .agg(F.round(F.try_divide(F.sum("rating_sum"), F.sum("rated")), digits).alias("avg_rating"),
                 F.sum("total_votes").alias("total_votes"),
                 F.sum("cnt").alias("title_count")))

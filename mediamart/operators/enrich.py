"""Joins: enrichment (J1), name lookup for a bounded key set (J2 + J4), and
the bridge join to both dimensions (J3).

Broadcast policy. A side is broadcast explicitly only when its size is
bounded by construction (a top-k result: at most k rows). Everything else is
left to the planner, whose broadcast decision *is* a size check: statically
against ``spark.sql.autoBroadcastJoinThreshold`` using file-size statistics,
and at runtime by AQE against the measured shuffle output. Beyond the
threshold the join stays a shuffled sort-merge join, and AQE splits skewed
partitions of it (a key holding a third of all rows becomes many tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.specs import TITLES_COLUMNS


# Keys that lookup_names broadcasts: about 64 MB of short ids at most.
MAX_BROADCAST_KEYS = 1_000_000


def enrich(facts: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """``facts`` LEFT JOIN ``dim``: every fact row kept, unmatched dim
    columns NULL, duplicate dim keys fan out (no de-duplication)."""
    return facts.join(dim, on=on, how=how)


def titles_mart(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Cleaned basics LEFT JOIN cleaned ratings on tconst, 13 columns."""
    return enrich(basics, ratings, "tconst").select(*TITLES_COLUMNS)


def lookup_names(keys: DataFrame, dim: DataFrame, key: str, names: list[str], bound: int) -> DataFrame:
    """J4 + J2: ``keys`` (at most ``bound`` rows) LEFT JOIN ``dim`` for its
    names. Past MAX_BROADCAST_KEYS the planner's own size check decides.

    A left outer join can only build (broadcast) its right side, which here
    is the big dimension. So the dimension is first cut down with a semi join
    that *does* broadcast the bounded key set (BroadcastHashJoin LeftSemi,
    build right): one streaming pass over the dimension, no shuffle of it.
    The remaining outer join is between two tiny inputs."""
    wanted = keys.select(key)
    if bound <= MAX_BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    named = dim.select(key, *names).join(wanted, on=key, how="left_semi")
    return keys.join(named, on=key, how="left")


def bridge(bridge_df: DataFrame, left_dim: DataFrame, left_key: str,
           right_dim: DataFrame, right_key: str) -> DataFrame:
    """Bridge INNER JOIN both dimensions. Two equi-joins; when the serving
    tables are bucketed on the keys the exchanges disappear."""
    return bridge_df.join(left_dim, on=left_key, how="inner").join(right_dim, on=right_key, how="inner")

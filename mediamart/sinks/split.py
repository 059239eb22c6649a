"""A bucketed fact table without a hot bucket.

Bucketing facts and dimension on the join key removes the join's exchange, but
all rows of a key share a bucket, so a key with a third of the rows makes one
task that no cluster shortens. Here the facts are stored in two tables:

* ``<name>_cold``: bucketed and sorted on the key, without the heavy keys. It
  joins a dimension bucketed alike without any exchange, and no bucket holds
  more than its even share plus one key below the heavy share.
* ``<name>_hot``: the rows of the heavy keys (and of NULL, which joins
  nothing), dealt evenly whatever their key. They join the dimension's few
  rows of those keys by broadcast.

Heavy keys are found by Spark's mergeable frequent-items sketch, which misses
no key of at least the given share, and then counted exactly. There are at
most 1 / share of them, so that is the bound of what is collected and of the
keys of the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.sinks.serve import _publish, read_serving, serve_projection
from mediamart.sinks.lake import MAX_RECORDS_PER_FILE
from mediamart.specs import DatasetSpec


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold at least ``share`` of the rows, heaviest first, NULL left
    out: one pass for the sketch, one to count its candidates."""
    if not 0.0001 <= share <= 1:
        raise ValueError(f"share must lie between 0.0001 and 1, not {share}")
    found = df.stat.freqItems([key], share).first()[0]
    candidates = [k for k in found if k is not None]
    counted = df.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    if not candidates:
        return []
    counts = df.where(F.col(key).isin(candidates)).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.where(F.col("n") >= share * counted).orderBy(F.desc("n"), F.asc(key))
    return [r[0] for r in heavy.collect()]


def write_split(spark: SparkSession, lake_df: DataFrame, spec: DatasetSpec, db: str, root: str, buckets: int,
                share: float | None = None, max_records: int = MAX_RECORDS_PER_FILE) -> list:
    """Store a fact table as ``_cold`` and ``_hot``; returns the heavy keys. A
    key is heavy from half of a bucket's even share on (``share`` sets
    another). Each part is a version of its own, swapped in like any serving
    table."""
    (key,) = spec.bucket_by
    out = serve_projection(lake_df, spec)
    heavy = heavy_keys(out, key, share or max(0.0001, 0.5 / buckets))
    hot = F.col(key).isNull() | F.col(key).isin(heavy) if heavy else F.col(key).isNull()
    sort_by = [c for c in spec.sort_by if c not in spec.serve_partition_by]
    cold = out.where(~F.coalesce(hot, F.lit(True))).repartition(buckets, key)
    _publish(spark, db, root, f"{spec.name}_cold", cold.write.format("parquet").option("compression", "snappy")
             .option("maxRecordsPerFile", max_records).bucketBy(buckets, key).sortBy(*sort_by))
    _publish(spark, db, root, f"{spec.name}_hot", out.where(hot).hint("rebalance").write.format("parquet")
             .option("compression", "snappy").option("maxRecordsPerFile", max_records))
    return heavy


def read_split(spark: SparkSession, db: str, name: str) -> DataFrame:
    """All rows of a split table."""
    return read_serving(spark, db, f"{name}_cold").unionByName(read_serving(spark, db, f"{name}_hot"))


def join_split(spark: SparkSession, db: str, name: str, dim: DataFrame, key: str, condition=None) -> DataFrame:
    """Inner join of a split table with ``dim`` (bucketed on ``key`` like the
    cold part, for a join without exchange). ``condition`` filters the facts
    first. The heavy keys are read from the hot part, so a later write cannot
    leave them out of step."""
    cold, hot = (read_serving(spark, db, f"{name}_{x}") for x in ("cold", "hot"))
    if condition is not None:
        cold, hot = cold.where(condition), hot.where(condition)
    # distinct heavy keys: at most 1 / share rows
    keys = hot.where(F.col(key).isNotNull()).select(key).distinct()
    few = dim.join(F.broadcast(keys), key, "left_semi")
    return cold.join(dim, key).unionByName(hot.join(F.broadcast(few), key))

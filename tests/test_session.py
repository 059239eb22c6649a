"""The shared working folder comes from the session's checkpoint dir."""

import pytest

from mediamart.session import scratch_path, shared_dir


def test_shared_dir_is_the_checkpoint_dir(spark):
    base = shared_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:                                             # the cluster's setting wins
        assert base == named.rstrip("/")
    else:                                                 # else the context's folder
        assert base == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert shared_dir(spark) == base                      # stable across calls


def test_scratch_paths_are_fresh_and_below_the_shared_dir(spark):
    a, b = scratch_path(spark, "lake"), scratch_path(spark, "lake")
    assert a != b
    assert a.startswith(shared_dir(spark) + "/") and a.endswith("/lake")


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class _ClusterSession:
    conf, sparkContext = _Conf(), _Context()


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_ClusterSession())


def test_shuffles_are_sized_from_the_input(spark):
    from mediamart.session import size_shuffles
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        assert size_shuffles(spark, 0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert size_shuffles(spark, 1 << 40) == (1 << 40) // (64 << 20) == int(spark.conf.get(key))
    finally:
        spark.conf.unset(key)


def test_a_slot_replaces_its_folder_and_database(spark):
    from mediamart.session import scratch_slot
    from mediamart.sources.fs import exists
    first = scratch_slot(spark, "test_slot", "mm_slot_one")
    spark.range(3).write.parquet(first)
    spark.sql(f"CREATE DATABASE mm_slot_one LOCATION '{first}_db'")
    second = scratch_slot(spark, "test_slot", "mm_slot_two")
    assert first != second and not exists(spark, first)
    assert not spark.catalog.databaseExists("mm_slot_one")


def test_a_side_of_many_narrow_rows_is_not_broadcast(spark, tmp):
    """A few MB of Parquet that hold a million rows: far more as rows and as a
    hash table on the driver, so neither the static nor the runtime size check
    may broadcast them."""
    from pyspark.sql import functions as F

    from mediamart.session import apply_conf
    apply_conf(spark)
    spark.range(1_000_000).select(F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"),
                                  (F.col("id") % 100).cast("float").alias("rating")).write.parquet(f"{tmp}/dim")
    joined = spark.read.parquet(f"{tmp}/dim").join(spark.read.parquet(f"{tmp}/dim").select("tconst"), "tconst")
    total = joined.groupBy().sum("rating")
    assert total.collect()[0][0] == 49_500_000
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan

"""A key holding a third of all rows: aggregation stays partial map-side,
AQE splits the hot join partition across several tasks, and the lake
rebalance splits a hot directory."""

import glob
import os

from pyspark.sql import functions as F

from mediamart.plans import marts
from mediamart.sinks.lake import write_lake


def test_hot_key_join_is_split(spark):
    n = 30000
    pr = (spark.range(n).select(
        F.concat(F.lit("tt"), (F.col("id") % 1000).cast("string")).alias("tconst"),
        F.lit(1).alias("ordering"),
        F.when(F.col("id") % 3 == 0, F.lit("nm_hot")).otherwise(
            F.concat(F.lit("nm"), (F.col("id") % 5000).cast("string"))).alias("nconst"),
        F.lit("director").alias("category"), F.lit(None).cast("string").alias("job"),
        F.lit(None).cast("string").alias("characters")))
    titles = spark.range(1000).select(
        F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"), F.lit("T").alias("primaryTitle"),
        F.lit(2000).alias("startYear"), F.lit("Drama").alias("primaryGenre"),
        F.lit(7.0).cast("float").alias("averageRating"), F.lit(10).alias("numVotes"))
    people = spark.range(5000).select(F.concat(F.lit("nm"), F.col("id").cast("string")).alias("nconst"),
                                      F.lit("P").alias("primaryName")).unionByName(
        spark.createDataFrame([("nm_hot", "Hot")], "nconst string, primaryName string"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = marts.role_filmography(pr, titles, people, "director")
        assert df.count() == n                          # every credit kept
        hot = df.filter(F.col("nconst") == "nm_hot").count()
        assert hot == n // 3
        df.collect()                                    # runs df's own adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_partition_directory_is_written_by_several_tasks(spark, tmp):
    """A lake directory holding a third of all rows is split by the
    rebalance into advisory-size tasks (several files), not one straggler."""
    n = 30000
    df = spark.range(n).select(
        F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("category")).repartition(8)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = os.path.join(tmp, "hot")
        write_lake(df, path, ["category"])
        hot_files = glob.glob(os.path.join(path, "category=hot", "*.parquet"))
        assert len(hot_files) > 1                        # split across tasks
        back = spark.read.parquet(path)
        assert back.count() == n                         # nothing dropped
        assert back.filter(F.col("category") == "hot").count() == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_tie_group_of_a_global_sort_is_split(spark):
    """A (rating, votes) pair shared by a third of the rows: the sort's unique
    last key lets the range partitioner spread that group over several tasks."""
    n = 30000
    titles = spark.range(n).select(
        F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"),
        F.lit("movie").alias("titleType"), F.lit("T").alias("primaryTitle"),
        F.lit(2000).alias("startYear"), F.lit("Drama").alias("primaryGenre"), F.lit(2000).alias("decade"),
        F.when(F.col("id") % 3 == 0, F.lit(7.5)).otherwise((F.col("id") % 90) / 10).cast("float")
        .alias("averageRating"),
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id")).cast("int").alias("numVotes"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = marts.top_titles(titles, "movie", 0).withColumn("part", F.spark_partition_id())
        hot = out.filter((F.col("averageRating") == 7.5) & (F.col("numVotes") == 500))
        assert hot.count() == n // 3
        assert hot.select("part").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_join_has_no_exchange_and_no_hot_bucket(spark, tmp):
    """A third of all credits on one title: its rows are stored apart."""
    import uuid

    from mediamart import specs
    from mediamart.sinks.serve import load_serving, read_serving
    from mediamart.sinks.split import heavy_keys, join_split, read_split, write_split
    rows = [("tt1" if i % 3 == 0 else f"tt{i % 700 + 2}" if i % 50 else None, i % 200, f"nm{i}", "director" if i % 2 else "actor", None, None) for i in range(9000)]
    credits = spark.createDataFrame(rows, specs.PRINCIPALS.lake_schema).repartition(6)
    titles = spark.createDataFrame([(f"tt{i}", "movie", "t", "t", 0, 2000, None, None, [], "", 2000, 5.0, 1) for i in range(600)], specs.TITLES.lake_schema)
    assert heavy_keys(credits, "tconst", 0.03) == ["tt1"] and heavy_keys(credits, "tconst", 0.5) == []
    assert heavy_keys(credits.limit(0), "tconst", 0.1) == []
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"titles": titles}, specs.LAKE, db, tmp, buckets=8)
    assert write_split(spark, credits, specs.PRINCIPALS, db, tmp, 8) == ["tt1"]
    hot, cold = (read_serving(spark, db, f"principals_{x}") for x in ("hot", "cold"))
    assert {r.tconst for r in hot.select("tconst").distinct().collect()} == {"tt1"}          # a missing key is served as an empty one
    per_bucket = [r["count"] for r in cold.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_bucket) + hot.count() == 9000 and max(per_bucket) < 9000 / 8 * 1.5
    assert read_split(spark, db, "principals").count() == 9000
    dim = read_serving(spark, db, "titles").select("tconst", "numVotes")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange hashpartitioning(tconst" not in _plan(cold.join(dim, "tconst")).replace("#", "")
        joined = join_split(spark, db, "principals", dim, "tconst")
        want = sorted((r[0], r[2]) for r in rows if r[0] and int(r[0][2:]) < 600)
        assert sorted((r.tconst, r.nconst) for r in joined.collect()) == want
        plan = _plan(joined)
        assert "BroadcastHashJoin" in plan and plan.count("SortMergeJoin") in (1, 2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")

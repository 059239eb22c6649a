"""Lake sink and source (K1-K4, S5, S6) and partition pruning."""

import glob
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamart import specs
from mediamart.sinks.lake import overwrite_slice, read_lake, write_lake
from mediamart.specs import DatasetSpec, Derived


def titles_rows(spark, rows):
    return spark.createDataFrame(rows, specs.TITLES.lake_schema)


def title(tconst, kind, year, rating=None, votes=None):
    decade = None if year is None else year // 10 * 10
    return (tconst, kind, "t", "t", 0, year, None, None, ["Drama"], "Drama", decade, rating, votes)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_roundtrip_with_special_partition_values(spark, tmp):
    rows = [title("a", "un/known=x", 1994), title("b", "movie", None), title("c", "movie", 2001, 7.5, 10)]
    path = os.path.join(tmp, "titles")
    write_lake(titles_rows(spark, rows), path, specs.TITLES.partition_by)
    dirs = sorted(os.path.basename(d) for d in glob.glob(os.path.join(path, "titleType=*")))
    assert "titleType=un%2Fknown%3Dx" in dirs
    assert glob.glob(os.path.join(path, "titleType=movie", "decade=__HIVE_DEFAULT_PARTITION__"))
    back = {r.tconst: r for r in read_lake(spark, path, specs.TITLES).collect()}
    assert back["a"].titleType == "un/known=x" and back["a"].decade == 1990
    assert back["b"].decade is None
    assert back["c"].averageRating == 7.5 and back["c"].genres == ["Drama"]


def test_declared_schema_keeps_string_partition(spark, tmp):
    spec = DatasetSpec(name="codes", raw=("code", "v"),
                       columns=(Derived("v", lambda: F.col("v")), Derived("code", lambda: F.col("code"))),
                       partition_by=("code",))
    df = spark.createDataFrame([("007", "x")], "code string, v string")
    path = os.path.join(tmp, "codes")
    write_lake(df, path, ("code",))
    assert read_lake(spark, path, spec).first().code == "007"
    inferred = spark.read.parquet(path).schema["code"].dataType
    assert inferred != T.StringType()        # why the declared schema matters


def test_missing_dataset_reads_empty(spark, tmp):
    df = read_lake(spark, os.path.join(tmp, "nope"), specs.PEOPLE)
    assert df.count() == 0 and df.columns == specs.PEOPLE.column_names()


def test_one_file_per_partition_after_rebalance(spark, tmp):
    rows = [title(f"t{i}", ["movie", "short"][i % 2], 1990 + i % 20) for i in range(400)]
    df = titles_rows(spark, rows).repartition(16)
    path = os.path.join(tmp, "titles")
    write_lake(df, path, specs.TITLES.partition_by)
    leaves = glob.glob(os.path.join(path, "titleType=*", "decade=*"))
    files = glob.glob(os.path.join(path, "titleType=*", "decade=*", "*.parquet"))
    assert len(leaves) == 4 and len(files) == len(leaves)


def test_narrow_rows_are_not_split_by_row_count(spark, tmp):
    # 600k narrow rows are a few MB: one advisory-size task, so one file per
    # directory. File size follows bytes, not a low row cap.
    df = spark.range(600_000).select(F.concat(F.lit("tt"), F.col("id").cast("string")).alias("tconst"),
                                     F.lit("actor").alias("category"))
    path = os.path.join(tmp, "narrow")
    write_lake(df, path, ["category"])
    files = glob.glob(os.path.join(path, "category=actor", "*.parquet"))
    assert len(files) == 1
    assert spark.read.parquet(path).count() == 600_000


def test_slice_overwrite_idempotent_and_drops_vanished(spark, tmp):
    path = os.path.join(tmp, "titles")
    full = titles_rows(spark, [title("m1", "movie", 1994), title("m2", "movie", 2005), title("s1", "short", 1994)])
    write_lake(full, path, specs.TITLES.partition_by)
    for _ in range(2):
        overwrite_slice(full, path, "titleType", "movie", ("decade",))
    assert sorted(r.tconst for r in read_lake(spark, path, specs.TITLES).collect()) == ["m1", "m2", "s1"]
    # the 2000s vanish from the movie slice: its directory goes, 'short' stays
    changed = titles_rows(spark, [title("m1", "movie", 1994), title("s1", "short", 1994)])
    overwrite_slice(changed, path, "titleType", "movie", ("decade",))
    back = read_lake(spark, path, specs.TITLES)
    assert sorted(r.tconst for r in back.collect()) == ["m1", "s1"]
    assert not glob.glob(os.path.join(path, "titleType=movie", "decade=2000"))


def test_partition_filters_reach_the_scan(spark, tmp):
    path = os.path.join(tmp, "titles")
    write_lake(titles_rows(spark, [title("a", "movie", 1994), title("b", "short", 2001)]), path,
               specs.TITLES.partition_by)
    df = read_lake(spark, path, specs.TITLES).filter((F.col("titleType") == "movie") & (F.col("decade") == 1990))
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(titleType" in text and "(decade" in text
    assert [r.tconst for r in df.collect()] == ["a"]
    pushed = read_lake(spark, path, specs.TITLES).filter(F.col("numVotes") >= 10).select("tconst")
    text = plan_text(pushed)
    assert "PushedFilters: [IsNotNull(numVotes), GreaterThanOrEqual(numVotes,10)]" in text
    assert "ReadSchema: struct<tconst:string,numVotes:int>" in text


def test_slice_refuses_empty_and_reports_rows(spark, tmp):
    path = os.path.join(tmp, "titles")
    full = titles_rows(spark, [title("m1", "movie", 1994), title("s1", "a/b=c", 1994)])
    write_lake(full, path, specs.TITLES.partition_by)
    for empty in ("", None):
        with pytest.raises(ValueError):
            overwrite_slice(full, path, "titleType", empty, ("decade",))
    assert overwrite_slice(full, path, "titleType", "moive", ("decade",)) == 0      # a typo
    assert overwrite_slice(full, path, "titleType", "a/b=c", ("decade",)) == 1
    assert overwrite_slice(full, path, "titleType", "movie", ("decade",)) == 1
    back = {(r.tconst, r.titleType) for r in read_lake(spark, path, specs.TITLES).collect()}
    assert back == {("m1", "movie"), ("s1", "a/b=c")}
    assert sorted(os.listdir(path)) == sorted(x for x in os.listdir(path) if not x.startswith("_") or x == "_SUCCESS")
    assert len([x for x in os.listdir(path) if x.startswith("titleType=")]) == 2


def test_a_failed_rebuild_keeps_the_old_rows(spark, tmp):
    path = os.path.join(tmp, "titles")
    write_lake(titles_rows(spark, [title("m1", "movie", 1994)]), path, specs.TITLES.partition_by)
    failing = titles_rows(spark, [title("m2", "movie", 1994)]).withColumn(
        "tconst", F.when(F.col("tconst") == "m2", F.raise_error(F.lit("midway"))).otherwise(F.col("tconst")))
    with pytest.raises(Exception):
        write_lake(failing, path, specs.TITLES.partition_by)
    assert [r.tconst for r in read_lake(spark, path, specs.TITLES).collect()] == ["m1"]
    assert [x for x in os.listdir(tmp) if "_new_" in x or "_old_" in x] == []


def test_record_bound_is_an_option(spark, tmp):
    path = os.path.join(tmp, "titles")
    rows = titles_rows(spark, [title(f"m{i}", "movie", 1994) for i in range(100)]).coalesce(1)
    write_lake(rows, path, specs.TITLES.partition_by, max_records=10)
    assert len(read_lake(spark, path, specs.TITLES).inputFiles()) >= 10


def test_missing_dataset_is_named(spark, tmp, caplog):
    with caplog.at_level("WARNING", "mediamart"):
        assert read_lake(spark, os.path.join(tmp, "titels"), specs.TITLES).count() == 0
    assert "titels" in caplog.text


def test_file_columns_win_over_path_values(spark, tmp):
    from mediamart.sinks.lake import read_lake_own_columns
    names = ["a b", "50%", "x+y", "c=d", "é/ü", None]
    rows = [(f"tt{i}", i, f"nm{i}", names[i % 6], None, None) for i in range(24)]
    df = spark.createDataFrame(rows, specs.PRINCIPALS.lake_schema)
    path = tmp + "/principals"
    write_lake(df.where("ordering < 18"), path, ["category"])
    df.where("ordering >= 18 AND category IS NOT NULL").coalesce(1).write.parquet(path + "/category=elsewhere")
    back = read_lake_own_columns(spark, path, specs.PRINCIPALS)
    assert back.columns == specs.PRINCIPALS.column_names()
    assert sorted(map(str, back.collect())) == sorted(str(r) for r in df.where("ordering < 18 OR category IS NOT NULL").collect())
    plain = read_lake(spark, path, specs.PRINCIPALS)                     # by discovery the directory's value wins
    assert plain.where("category = 'elsewhere'").count() == 5
    assert read_lake_own_columns(spark, tmp + "/absent", specs.PRINCIPALS).count() == 0


def test_a_write_task_sorts_a_bounded_share(spark, tmp):
    """Some 60 MB of shuffled rows of one directory: several tasks, so that the
    memory of one task's sort does not follow the directory's size."""
    from mediamart.session import apply_conf
    apply_conf(spark)
    df = spark.range(0, 1_000_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("tconst"), F.lit("actor").alias("category"))
    write_lake(df, os.path.join(tmp, "wide"), ["category"])
    assert len(glob.glob(os.path.join(tmp, "wide", "category=actor", "*.parquet"))) > 1
    assert spark.read.parquet(os.path.join(tmp, "wide")).count() == 1_000_000

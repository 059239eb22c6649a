"""Serving layer."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from mediamart import specs
from mediamart.operators import checks
from mediamart.sinks.serve import load_serving, read_serving, require_tables, serve_projection


def credits(spark, rows):
    return spark.createDataFrame(rows, specs.PRINCIPALS.lake_schema)


def test_projection_fills_and_drops(spark):
    people = spark.createDataFrame([("nm1", None, 1970, None, None, None, "unknown")], specs.PEOPLE.lake_schema)
    out = serve_projection(people, specs.PEOPLE)
    assert out.columns == [c.name for c in specs.PEOPLE.serve]        # primaryProfession0 dropped
    r = out.first()
    assert r.primaryName == "" and r.primaryProfession == [] and r.knownForTitles == []
    assert r.deathYear is None                                       # nullable stays NULL
    assert out.schema["nconst"].metadata.get("comment") == "key of the person"


def test_absent_column_is_an_error(spark):
    df = spark.createDataFrame([("nm1",)], "nconst string")
    with pytest.raises(ValueError):
        serve_projection(df, specs.PEOPLE)


def test_load_stats_count_out_of_range_without_wrapping(spark, tmp):
    rows = [("tt1", 1, "nm1", "actor", None, None), ("tt1", 300, "nm2", "actor", None, None),
            ("tt2", 1, "nm1", "director", None, None)]
    db = "t_" + uuid.uuid4().hex[:8]
    stats = load_serving(spark, {"principals": credits(spark, rows)}, specs.LAKE, db, tmp)
    assert stats["principals"]["rows"] == 3 and stats["principals"]["out_of_range_ordering"] == 1
    assert stats["principals"]["files_written"] >= 2  # one directory per category at least
    back = read_serving(spark, db, "principals")
    assert stats["principals"]["files_written"] == len(back.inputFiles())     # metadata count = file index
    assert sorted(r.ordering for r in back.collect()) == [1, 1, 300]      # kept, not wrapped to 44
    # idempotent re-run with overwrite, and append adds
    load_serving(spark, {"principals": credits(spark, rows)}, specs.LAKE, db, tmp)
    assert read_serving(spark, db, "principals").count() == 3
    load_serving(spark, {"principals": credits(spark, rows)}, specs.LAKE, db, tmp, mode="append")
    assert read_serving(spark, db, "principals").count() == 6


def test_require_tables_names_all_missing(spark, tmp):
    db = "t_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(tmp, 'db')}'")
    with pytest.raises(RuntimeError) as err:
        require_tables(spark, db, ["titles", "people"])
    assert "titles" in str(err.value) and "people" in str(err.value)


def test_files_sorted_by_sort_key(spark, tmp):
    rows = [(f"tt{i % 97:03d}", i % 7, f"nm{i}", ["actor", "director"][i % 2], None, None) for i in range(3000)]
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"principals": credits(spark, rows).repartition(8)}, specs.LAKE, db, tmp)
    t = read_serving(spark, db, "principals").select(
        "tconst", "ordering", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i"))
    from pyspark.sql.window import Window
    w = Window.partitionBy("f").orderBy("i")
    bad = t.select((F.struct(F.lag("tconst").over(w), F.lag("ordering").over(w))
                    > F.struct("tconst", "ordering")).alias("bad")).filter("bad").count()
    assert bad == 0


def test_bucketed_layout_removes_join_exchange(spark, tmp):
    titles = spark.createDataFrame([(f"tt{i}", "movie", "t", "t", 0, 2000, None, None, [], "", 2000, 5.0, 1)
                                    for i in range(50)], specs.TITLES.lake_schema)
    cr = credits(spark, [(f"tt{i}", 1, f"nm{i}", "director", None, None) for i in range(50)])
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"titles": titles, "principals": cr}, specs.LAKE, db, tmp, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = read_serving(spark, db, "principals").join(read_serving(spark, db, "titles"), "tconst")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 50
        assert "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")


def test_reconcile_reports_duplicates(spark, tmp):
    rows = [("tt1", 1, "nm1", "actor", None, None), ("tt1", 1, "nm2", "actor", None, None)]
    lake = credits(spark, rows)
    r = checks.reconcile(lake, lake, specs.PRINCIPALS).first()
    assert r.lake_rows == 2 and r.counts_match and r.duplicate_keys == 1 and r.out_of_range == 0


def test_rebalance_layout_sorted_files_and_same_rows(spark, tmp):
    rows = [(f"tt{i % 97:03d}", i % 7, f"nm{i}", ["actor", "director"][i % 2], None, None) for i in range(3000)]
    db = "t_" + uuid.uuid4().hex[:8]
    stats = load_serving(spark, {"principals": credits(spark, rows).repartition(8)}, specs.LAKE, db, tmp,
                         layout="rebalance")
    assert stats["principals"]["rows"] == 3000
    t = read_serving(spark, db, "principals").select(*specs.PRINCIPALS.column_names())
    assert sorted(tuple(r) for r in t.collect()) == sorted(rows)
    with pytest.raises(ValueError):
        load_serving(spark, {"principals": credits(spark, rows)}, specs.LAKE, db, tmp, layout="zorder")


def test_range_layout_gives_files_disjoint_key_ranges(spark, tmp):
    rows = [(f"tt{(i * 7919) % 1000:04d}", i % 5, f"nm{i}", ["actor", "director"][i % 2], None, None)
            for i in range(6000)]
    db = "t_" + uuid.uuid4().hex[:8]
    # small input: keep AQE from merging the ranges into one file per directory
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load_serving(spark, {"principals": credits(spark, rows).repartition(8)}, specs.LAKE, db, tmp)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key = F.struct("tconst", "ordering")
    per_file = (read_serving(spark, db, "principals")
                .groupBy("category", F.col("_metadata.file_path").alias("f"))
                .agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
                .collect())
    by_dir = {}
    for r in per_file:
        by_dir.setdefault(r.category, []).append((tuple(r.lo), tuple(r.hi)))
    assert any(len(v) > 1 for v in by_dir.values())       # several files to compare
    for spans in by_dir.values():
        spans.sort()
        for (_, hi), (lo_next, _) in zip(spans, spans[1:]):
            assert hi <= lo_next


def test_range_layout_splits_a_hot_category(spark, tmp):
    # a third of all credits in one category: the range key continues past
    # the category (tconst, ordering), so that directory gets several files
    rows = [(f"tt{i:05d}", 1, f"nm{i}", "actor" if i % 3 == 0 else f"cat{i % 20}", None, None)
            for i in range(6000)]
    db = "t_" + uuid.uuid4().hex[:8]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stats = load_serving(spark, {"principals": credits(spark, rows).repartition(8)}, specs.LAKE, db, tmp)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert stats["principals"]["rows"] == 6000
    back = read_serving(spark, db, "principals")
    hot = back.filter(F.col("category") == "actor")
    assert hot.count() == 2000
    assert len(hot.inputFiles()) > 1


def test_range_count_from_size():
    from mediamart.sinks.serve import range_count
    assert range_count(None) is None
    assert range_count(0) == 1 and range_count(1) == 1
    assert range_count(10 * 1024 ** 4) == 10 * 1024 ** 4 // (128 * 1024 ** 2)     # 10 TiB -> 81920 ranges
    assert range_count(100 * 1024 ** 4) == 100_000     # capped: each range keeps ~30 bound samples
    mb = 1024 ** 2
    assert range_count(45 * mb, parallelism=8) == 8     # mid-size: one range per slot
    assert range_count(10 * mb, parallelism=8) == 3     # but no file under 4 MB
    assert range_count(18 * 1024, parallelism=8) == 1
    assert range_count(100 * 1024 ** 4, parallelism=8000) == 100_000


def test_unsorted_pairs_counts_breaks_inside_each_file(spark, tmp):
    schema = "grp string, tconst string, ordering int"
    ok = spark.createDataFrame([("a", "tt1", 1), ("a", "tt1", 2), ("a", "tt2", 1)], schema)
    bad = spark.createDataFrame([("b", "tt2", 1), ("b", "tt1", 2), ("b", "tt1", 1), ("b", "tt1", 3)], schema)
    for name, df in (("ok", ok), ("bad", bad)):
        df.coalesce(1).write.parquet(os.path.join(tmp, name))
    files = spark.read.parquet(os.path.join(tmp, "ok"), os.path.join(tmp, "bad"))
    out = {r.grp: (r.row_count, r.unsorted_pairs)
           for r in checks.unsorted_pairs(files, ["tconst", "ordering"], ["grp"]).collect()}
    # b: tt2 > tt1, then (tt1, 2) > (tt1, 1); (tt1, 1) < (tt1, 3) is fine
    assert out == {"a": (3, 0), "b": (4, 2)}


def test_reload_swaps_versions_and_a_failed_load_keeps_the_old_one(spark, tmp):
    from mediamart.sinks.serve import table_location
    rows = [("tt1", 1, "nm1", "actor", None, None), ("tt2", 1, "nm2", "director", None, None)]
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"principals": credits(spark, rows)}, specs.LAKE, db, tmp)
    first = table_location(spark, db, "principals")
    load_serving(spark, {"principals": credits(spark, rows[:1])}, specs.LAKE, db, tmp)
    second = table_location(spark, db, "principals")
    assert second != first and os.path.exists(first.replace("file:", ""))       # kept for readers that still scan it
    load_serving(spark, {"principals": credits(spark, rows[:1])}, specs.LAKE, db, tmp)
    assert not os.path.exists(first.replace("file:", ""))                       # gone with the next reload
    second = table_location(spark, db, "principals")
    assert read_serving(spark, db, "principals").count() == 1
    failing = credits(spark, rows).withColumn(
        "nconst", F.when(F.col("ordering") >= 0, F.raise_error(F.lit("load fails midway")))
        .otherwise(F.col("nconst")))
    with pytest.raises(Exception):
        load_serving(spark, {"principals": failing}, specs.LAKE, db, tmp)
    assert table_location(spark, db, "principals") == second                   # previous version kept
    assert [r.tconst for r in read_serving(spark, db, "principals").collect()] == ["tt1"]
    folders = [f for f in os.listdir(os.path.join(tmp, "principals")) if f.startswith("v")]
    versions = [t.name for t in spark.catalog.listTables(db) if t.name.startswith("principals__v")]
    assert len(folders) == len(versions) == 2                                  # nothing of the failed load is left


def test_unsorted_pairs_puts_null_first(spark, tmp):
    schema = "grp string, year int, tconst string"
    rows = [("x", 5, "a"), ("x", None, "b"), ("x", 3, "c"), ("x", None, "d"), ("x", None, "e")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp + "/f")
    out = checks.unsorted_pairs(spark.read.parquet(tmp + "/f"), ["year", "tconst"], []).first()
    assert (out.row_count, out.unsorted_pairs) == (5, 2)          # 5 > NULL, 3 > NULL
    # batches of one row: the same breaks are found where runs meet
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        out = checks.unsorted_pairs(spark.read.parquet(tmp + "/f"), ["year", "tconst"], []).first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert (out.row_count, out.unsorted_pairs) == (5, 2)


def test_row_loss_of_an_empty_source(spark):
    from mediamart.operators.clean import clean
    raw = spark.createDataFrame([], specs.PEOPLE.raw_schema)
    r = checks.row_loss(raw, clean(raw, specs.PEOPLE), specs.PEOPLE).first()
    assert (r.rows_in, r.rows_out, r.null_key_rows) == (0, 0, 0)


def test_load_leaves_folders_it_did_not_write(spark, tmp):
    """An external table of the same name over the lake: the load succeeds and
    the lake stays; a managed table of that name is refused."""
    from mediamart.jobs import load
    from mediamart.sinks.lake import write_lake
    lake = os.path.join(tmp, "lake")
    rows = credits(spark, [("tt1", 1, "nm1", "actor", None, None)])
    write_lake(rows, os.path.join(lake, "principals"), specs.PRINCIPALS.partition_by)
    db = "t_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{os.path.join(tmp, 'db')}'")
    spark.sql(f"CREATE TABLE {db}.principals USING parquet LOCATION '{lake}/principals'")
    load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])
    assert spark.read.parquet(os.path.join(lake, "principals")).count() == 1
    assert read_serving(spark, db, "principals").count() == 1
    load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])
    assert spark.read.parquet(os.path.join(lake, "principals")).count() == 1

    spark.sql(f"DROP VIEW {db}.principals")
    spark.sql(f"CREATE TABLE {db}.principals USING parquet AS SELECT 1 AS mine")
    with pytest.raises(RuntimeError, match="managed"):
        load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])
    assert spark.table(f"{db}.principals").count() == 1
    spark.sql(f"DROP TABLE {db}.principals")
    spark.sql(f"CREATE VIEW {db}.principals AS SELECT 2 AS mine")
    with pytest.raises(RuntimeError, match="view"):
        load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])


def test_load_skips_a_lake_dataset_without_files(spark, tmp):
    from mediamart.jobs import load
    from mediamart.sinks.lake import write_lake
    lake, db = os.path.join(tmp, "lake"), "t_" + uuid.uuid4().hex[:8]
    write_lake(credits(spark, [("tt1", 1, "nm1", "actor", None, None)]), os.path.join(lake, "principals"), ["category"])
    load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])
    os.rename(os.path.join(lake, "principals"), os.path.join(lake, "elsewhere"))
    os.makedirs(os.path.join(lake, "principals"))
    out = load(spark, lake, os.path.join(tmp, "serve"), db, only=["principals"])
    assert out["stats"]["principals"]["rows"] == 0
    assert read_serving(spark, db, "principals").count() == 1


def test_a_failed_swap_keeps_the_old_table(spark, tmp):
    from mediamart.sinks import serve
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"principals": credits(spark, [("tt1", 1, "nm1", "actor", None, None)])}, specs.LAKE, db, tmp)
    with pytest.raises(Exception):
        serve._point(spark, db, "principals", "principals__v" + "0" * 12)
    assert read_serving(spark, db, "principals").count() == 1


def test_range_bound_is_logged_when_it_binds(spark, tmp, caplog):
    from mediamart.sinks.serve import write_serving, ensure_database
    db = "t_" + uuid.uuid4().hex[:8]
    ensure_database(spark, db, os.path.join(tmp, "db"))
    df = credits(spark, [(f"tt{i}", 1, "nm1", "actor", None, None) for i in range(50)])
    with caplog.at_level("WARNING", "mediamart"):
        stats = write_serving(spark, df, specs.PRINCIPALS, db, tmp, input_bytes=1 << 40, max_ranges=3)
    assert stats["rows"] == 50 and "range count is at its bound" in caplog.text


def test_rollup_is_stored_and_refreshed(spark, tmp):
    from mediamart.operators import rollup
    from mediamart.sinks.serve import ROLLUP_TABLE
    def titles(rows):
        return spark.createDataFrame(
            [(t, "movie", t, t, 0, 1994, None, 90, [g], g, 1990, r, 10) for t, g, r in rows], specs.TITLES.lake_schema)
    db = "t_" + uuid.uuid4().hex[:8]
    load_serving(spark, {"titles": titles([("a", "Drama", 8.0), ("b", "Drama", 6.0)])}, specs.LAKE, db, tmp)
    got = rollup.coarsen(read_serving(spark, db, ROLLUP_TABLE), ["primaryGenre"]).collect()
    assert [tuple(r) for r in got] == [("Drama", 7.0, 20, 2)]
    load_serving(spark, {"titles": titles([("a", "Crime", 5.0)])}, specs.LAKE, db, tmp)
    got = rollup.coarsen(read_serving(spark, db, ROLLUP_TABLE), ["primaryGenre"]).collect()
    assert [tuple(r) for r in got] == [("Crime", 5.0, 10, 1)]


def titles_rows(spark, rows):
    return spark.createDataFrame(
        [(t, "movie", t, t, 0, year, None, 90, [g], g, year and year // 10 * 10, r, votes) for t, g, year, r, votes in rows], specs.TITLES.lake_schema)


def test_readers_never_miss_the_table_during_reloads(spark, tmp):
    import threading
    from mediamart.sinks.serve import write_serving, ensure_database
    db = "t_" + uuid.uuid4().hex[:8]
    ensure_database(spark, db, os.path.join(tmp, "db"))
    loads = [credits(spark, [(f"tt{i}", 1, "nm1", "actor", None, None) for i in range(n)]) for n in (1, 2, 3, 4)]
    write_serving(spark, loads[0], specs.PRINCIPALS, db, tmp)
    seen, failed, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(f"`{db}`.principals").count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for df in loads[1:]:
            write_serving(spark, df, specs.PRINCIPALS, db, tmp)
    finally:
        done.set()
        reader.join()
    assert not failed and seen == sorted(seen) and set(seen) <= {1, 2, 3, 4}
    assert spark.table(f"`{db}`.principals").count() == 4


def test_appends_merge_the_rollup_without_reading_all_titles(spark, tmp):
    from mediamart.operators import rollup
    from mediamart.sinks.serve import ROLLUP_TABLE, rollup_with, table_location, write_rollup, write_serving
    db = "t_" + uuid.uuid4().hex[:8]
    rows = [(f"t{i}", ["Drama", "Crime", "War"][i % 3], [1994, 2001, None][i % 3], None if i % 5 == 0 else i % 10 + 0.5, i) for i in range(60)]
    load_serving(spark, {"titles": titles_rows(spark, rows[:30])}, specs.LAKE, db, tmp)
    for part in (rows[30:40], rows[40:]):
        load_serving(spark, {"titles": titles_rows(spark, part)}, specs.LAKE, db, tmp, mode="append")
    key = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    whole = rollup.build_rollup(read_serving(spark, db, "titles"))
    assert read_serving(spark, db, "titles").count() == 60
    assert key(read_serving(spark, db, ROLLUP_TABLE)) == key(whole)
    delta = os.path.join(tmp, "delta")
    serve_projection(titles_rows(spark, rows[:2]), specs.TITLES).write.parquet(delta)
    files = rollup_with(read_serving(spark, db, ROLLUP_TABLE), spark.read.parquet(delta)).inputFiles()
    stored = table_location(spark, db, ROLLUP_TABLE).replace("file:", "")
    assert files and all(stored in f or delta in f for f in files)
    # a rollup that lags behind (a load that failed between its two steps) is rebuilt by the next append
    write_serving(spark, titles_rows(spark, rows[:7]), specs.TITLES, db, tmp, mode="append")
    load_serving(spark, {"titles": titles_rows(spark, rows[:1])}, specs.LAKE, db, tmp, mode="append")
    assert key(read_serving(spark, db, ROLLUP_TABLE)) == key(rollup.build_rollup(read_serving(spark, db, "titles")))
    write_rollup(spark, db, tmp)


def test_load_counts_the_files_that_it_read_itself(spark, tmp):
    from mediamart.sinks.lake import read_lake, write_lake
    rows = [(f"tt{i}", 1, "nm1", f"cat{i % 40}", None, None) for i in range(400)]
    path = os.path.join(tmp, "lake", "principals")
    write_lake(credits(spark, rows), path, ["category"])
    df = read_lake(spark, path, specs.PRINCIPALS)
    known = len(df.inputFiles())
    credits(spark, rows[:5]).write.mode("append").partitionBy("category").parquet(path)      # another job's file, after the listing
    db = "t_" + uuid.uuid4().hex[:8]
    stats = load_serving(spark, {"principals": df}, specs.LAKE, db, os.path.join(tmp, "serve"))
    assert (stats["principals"]["files"], stats["principals"]["rows"]) == (known, 400)
    kept = spark.table(f"`{db}`.load_stats").first()
    assert (kept.dataset, kept.rows, kept.files) == ("principals", 400, known)


def _scan_rows(df):
    """Rows that the file scan of ``df`` put out, from the scan's own metric."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_by_a_key_that_does_not_lead_the_sort_skips_row_groups(spark, tmp):
    n = 40_000
    rows = spark.range(n).selectExpr("concat('tt', id) tconst", "1 ordering", f"concat('nm', (id * 7919) % {n}) nconst", "'actor' category",
                                     "cast(null as string) job", "cast(null as string) characters").repartition(4)
    db, hadoop = "t_" + uuid.uuid4().hex[:8], spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(32 << 10))           # several row groups in small files
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        load_serving(spark, {"principals": rows}, specs.LAKE, db, tmp)
        found = read_serving(spark, db, "principals").where("nconst = 'nm12345'")
        assert found.count() == 1
        assert _scan_rows(found.select("tconst")) < n / 10
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_zorder_layout_serves_a_range_on_either_column(spark, tmp):
    rows = [(f"t{i}", "Drama", 1900 + i * 7919 % 120 if i % 50 else None, 5.0, i * 104729 % 5000 if i % 41 else None) for i in range(6000)]
    db = "t_" + uuid.uuid4().hex[:8]
    # one directory: kind and decade do not vary, so files differ by the key alone
    df = titles_rows(spark, rows).withColumn("decade", F.lit(1990))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        load_serving(spark, {"titles": df.repartition(8)}, specs.LAKE, db, tmp, layout="zorder")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    back = read_serving(spark, db, "titles")
    assert sorted((r.tconst, r.startYear, r.numVotes) for r in back.collect()) == sorted((r[0], r[2], r[4]) for r in rows)
    files = back.groupBy(F.col("_metadata.file_path")).agg(*[f(c).alias(f"{n}_{c}") for c in ("startYear", "numVotes")
                                                             for n, f in (("lo", F.min), ("hi", F.max))]).collect()
    assert len(files) > 30
    for c, a, b in (("startYear", 1950, 1955), ("numVotes", 1000, 1200)):
        hit = [f for f in files if f[f"lo_{c}"] is not None and f[f"lo_{c}"] <= b and f[f"hi_{c}"] >= a]
        assert len(hit) < len(files) / 2.5, c
    with pytest.raises(ValueError, match="zorder_by"):
        load_serving(spark, {"people": spark.createDataFrame([], specs.PEOPLE.lake_schema)}, specs.LAKE, db, tmp, layout="zorder")


def test_content_check_names_the_partition_of_one_altered_value(spark):
    rows = [("tt1", 1, "nm1", "actor", "a", None), ("tt2", 1, "nm2", "actor", None, "a"), ("tt3", 1, "nm3", "director", "", None),
            ("tt4", 2, "nm4", "writer", None, None), ("tt4", 2, "nm4", "writer", None, None)]

    def same(changed):
        return {r.category: (r.lake_rows, r.serve_rows, r.same_content)
                for r in checks.content_match(credits(spark, rows), serve_projection(credits(spark, changed), specs.PRINCIPALS), specs.PRINCIPALS).collect()}

    good = {"actor": (2, 2, True), "director": (1, 1, True), "writer": (2, 2, True)}
    assert same(rows[::-1]) == good                                                        # any order
    swap = lambda i, row: [*rows[:i], row, *rows[i + 1:]]
    assert same(swap(0, ("tt1", 1, "nm1", "actor", None, "a"))) == good | {"actor": (2, 2, False)}     # the value moved a column
    assert same(swap(2, ("tt3", 1, "nm3", "director", None, None))) == good | {"director": (1, 1, False)}     # empty became NULL
    assert same(rows[:4]) == good | {"writer": (2, 1, False)}                               # a repeated row lost
    assert same(swap(0, ("tt1", 1, "nm1", "director", "a", None))) == good | {"actor": (2, 1, False), "director": (1, 2, False)}


def test_partition_flow_names_where_rows_were_lost(spark):
    from mediamart.operators.clean import clean
    raw = spark.createDataFrame([("tt1", "1", "nm1", None, None, None), ("tt1", "2", None, "actor", None, None), ("tt2", "1", "nm2", "actor", None, None),
                                 ("tt3", "1", "nm3", " ", None, None)], specs.PRINCIPALS.raw_schema)
    lake = clean(raw, specs.PRINCIPALS)
    flow = lambda df: {(r.level, r.part1): tuple(r)[4:] for r in checks.partition_flow(raw, specs.PRINCIPALS, df).collect()}
    assert flow(None) == flow(lake) == {(1, "unknown"): (1, 0, 1, 1, True), (1, "actor"): (2, 1, 0, 1, True), (1, " "): (1, 0, 1, 1, True),
                                        (0, None): (4, 1, 2, 3, True)}
    short = flow(lake.where("category <> 'actor'"))
    assert short[1, "actor"] == (2, 1, 0, 0, False) and short[1, "unknown"][-1] and not short[0, None][-1]


def test_ranges_follow_the_memory_of_their_sort(spark, tmp, monkeypatch):
    """Narrow rows take many times their stored size in a sort: the ranges come
    from that, and stay as large when the table grows."""
    import uuid

    from mediamart import specs
    from mediamart.sinks import serve
    schema, mb = specs.PRINCIPALS.lake_schema, 1 << 20
    few = serve.range_count(serve.sort_bytes(33_000_000, schema, 291 * mb), serve.SORT_BYTES)
    many = serve.range_count(serve.sort_bytes(6 * 33_000_000, schema, 6 * 291 * mb), serve.SORT_BYTES)
    assert few > serve.range_count(291 * mb) and abs(many - 6 * few) <= 6
    monkeypatch.setattr(serve, "SORT_BYTES", 64 * 1024)
    rows = [(f"tt{i}", i % 9, f"nm{i % 50}", "actor", None, None) for i in range(4000)]
    db = "t_" + uuid.uuid4().hex[:8]
    serve.ensure_database(spark, db, f"{tmp}/_db")
    stats = serve.write_serving(spark, spark.createDataFrame(rows, schema), specs.PRINCIPALS, db, tmp, input_bytes=20_000)
    assert stats["rows"] == 4000 and stats["files_written"] > 4
    assert serve.read_serving(spark, db, "principals").count() == 4000

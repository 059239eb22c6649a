"""Serving tables.

The serving layer is a set of catalog tables stored as Parquet below the
shared folder, each:

* projected to the declared serving columns (P12; an absent column is an
  error), cast to the declared types (P10) and with NULLs filled in
  non-nullable columns (P11);
* partitioned like the reference's store (titleType/decade, category, region);
* sorted by its sort key inside every file (O6), so Parquet min/max
  statistics let a reader skip row groups outside a sort-key range.

Layouts (``layout=``):

* ``"range"`` (default): range-partitioned on (partition columns + sort
  key), then sorted. Files hold disjoint key ranges, so a range or point
  filter reads one file's row groups and only the footers of the others.
  Costs one sampling pass over the input at load time (write once, read
  many). The sort keys end in a (nearly) unique column, so a value holding a
  third of all rows is still cut into many similar-size ranges.
* ``"rebalance"``: one pass, no sampling; rows are rebalanced on the
  partition columns (AQE splits any oversized partition, whatever its keys)
  and sorted per file. Files overlap in key range but each is sorted.

Joins between serving tables are shuffled (or broadcast under the size
threshold), which lets AQE split a hot join key across tasks. Bucketing on
the join key (``buckets=N``) removes the join exchanges instead, but every
row of a key must then sit in one bucket: a key with a third of the rows
becomes one unsplittable write and read task. It is therefore opt-in, for
keys known to be evenly spread.

* ``"zorder"``: ranges on several columns at once (``zorder_by``, else the
  spec's): each column is ranked against its quantiles, the ranks' bits are
  interleaved, and files follow that key. A range on any one of the columns
  then lies in a fraction of the files, where a plain sort serves its first
  column only. Costs one more sampling pass.

Key lookups on columns that do not lead the sort (``spec.bloom``) are served by
Parquet Bloom filters: a reader skips every row group whose filter rules the
value out.

The public name is a view over the current version, a table ``<name>__v<12 hex
digits>`` in a folder of its own. A reload (``mode="overwrite"``) writes a new
version and, only after that job succeeded, points the view at it in one
catalog call, so readers always find a table: the old or the new one. A failed
load removes its own folder and changes nothing. The version just replaced
stays for readers that still scan it and goes at the next reload. An append
adds files to the current version; the genre rollup is merged with the
appended rows' sums, not rebuilt.

Only version folders that this loader wrote (``<root>/<table>/v<12 hex
digits>``) are ever deleted. A foreign table under the public name is replaced
in the catalog if it is external, its files staying as they are (that once, not
in one step); a managed one, whose files the catalog would delete, and a
foreign view are refused.

Spark has no unsigned integers: serving keeps the lake's signed type and
*counts* values outside the declared unsigned range instead of wrapping
them; the count is collected in the same pass as the write (Observation).
"""

from __future__ import annotations

import logging
import re
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamart.functions import out_of_range
from mediamart.operators.rollup import build_rollup, merge_rollups
from mediamart.sinks.lake import MAX_RECORDS_PER_FILE
from mediamart.sources.fs import data_file_count, delete, qualify
from mediamart.specs import DatasetSpec


log = logging.getLogger("mediamart")


def serve_projection(lake_df: DataFrame, spec: DatasetSpec) -> DataFrame:
    absent = [c.name for c in spec.serve if c.name not in lake_df.columns]
    if absent:
        raise ValueError(f"{spec.name}: serving columns missing from input: {absent}")
    cols = []
    for c in spec.serve:
        e = F.col(c.name).cast(c.dtype)
        if not c.nullable and c.fill is not None:
            fill = F.array().cast(c.dtype) if c.fill == "array" else F.lit(c.fill).cast(c.dtype)
            e = F.coalesce(e, fill)
        cols.append(e.alias(c.name, metadata={"comment": c.comment} if c.comment else {}))
    return lake_df.select(*cols)


def range_violations(df: DataFrame, spec: DatasetSpec) -> list:
    """Aggregate expressions counting out-of-range values per unsigned column."""
    return [F.sum(out_of_range(c.name, c.unsigned).cast("long")).alias(f"out_of_range_{c.name}")
            for c in spec.serve if c.unsigned]


def ensure_database(spark: SparkSession, db: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{location}'")


TARGET_FILE_BYTES = 128 * 1024 * 1024
# Spark's range partitioner draws at most about a million sample keys (three
# times that with its per-partition oversampling) to place the bounds. Past
# ~100 k ranges each range rests on only a few samples and comes out uneven,
# and every task carries the whole bounds array. Beyond this a range holds
# more than the target size and its task writes several sorted files, still
# disjoint from every other range's.
MAX_RANGES = 100_000         # default of the ``max_ranges`` argument; a log line says when it binds
# Floor for mid-size tables: at least one range per task slot, so the sort,
# the write and later scans use the whole cluster, unless that would make
# files smaller than this.
MIN_FILE_BYTES = 4 * 1024 * 1024


def range_count(input_bytes: int | None, target_bytes: int = TARGET_FILE_BYTES,
                max_ranges: int = MAX_RANGES, parallelism: int = 1) -> int | None:
    """Number of key ranges for the range layout: about one target-size file
    per range, at least ``parallelism`` ranges while files stay above
    ``MIN_FILE_BYTES``, at most ``max_ranges``. AQE can merge ranges but
    never split one, so at scale the count must come from the data size, not
    from the session's default."""
    if input_bytes is None:
        return None
    size = int(input_bytes)
    by_size = -(-size // target_bytes)
    floor = min(parallelism, -(-size // MIN_FILE_BYTES))
    return min(max_ranges, max(1, by_size, floor))


# Rows of one range are sorted in one task: about this much memory each, so that
# four tasks fit an executor without spilling, whatever the rows' width.
SORT_BYTES = 384 * 1024 * 1024


def sort_bytes(rows: int, schema: T.StructType, input_bytes: int) -> int:
    """Estimated memory of a sort of ``rows`` rows: the sorter's pointers and a
    row's header, a word per column, words for each string or array, and twice
    the compressed bytes for long values. Narrow rows take some twenty times
    their size in the lake, long texts about twice."""
    long_ones = sum(isinstance(f.dataType, (T.StringType, T.ArrayType)) for f in schema.fields)
    return int(rows) * (40 + 8 * len(schema.fields) + 16 * long_ones) + 2 * int(input_bytes)


ZORDER_BITS = 8            # ranks of a column are 0 .. 2^bits - 1


def zorder_key(df: DataFrame, columns: list[str], bits: int = ZORDER_BITS) -> tuple[DataFrame, str]:
    """``df`` with a long column (its name is returned) whose order follows all
    of ``columns`` (numeric) together: the interleaved bits of their ranks
    among 2^bits quantiles, which are all that the driver sees. NULL ranks
    first."""
    from pyspark.ml.feature import Bucketizer
    steps = 1 << bits
    known = [F.col(c).cast("double").alias(c) for c in columns]
    quantiles = df.select(*known).approxQuantile(columns, [i / steps for i in range(1, steps)], 1 / (4 * steps))
    inf = float("inf")
    ranked = df.withColumns({f"_{c}_n": F.coalesce(F.col(c).cast("double"), F.lit(-inf)) for c in columns})
    splits = [[-inf, *sorted(set(q)), inf] if q else [-inf, 0.0, inf] for q in quantiles]
    ranked = Bucketizer(splitsArray=splits, inputCols=[f"_{c}_n" for c in columns],
                        outputCols=[f"_{c}_rank" for c in columns]).transform(ranked)
    key: Column = F.lit(0).cast("long")
    for i in range(bits):
        for j, c in enumerate(columns):
            bit = F.shiftright(F.col(f"_{c}_rank").cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return ranked.withColumn("_zorder", key).drop(*[f"_{c}_{x}" for c in columns for x in ("n", "rank")]), "_zorder"


def _with_files(lake_df: DataFrame, name: str) -> tuple[DataFrame, Observation | None]:
    """``lake_df`` with the files it reads counted where they are scanned (a
    mergeable distinct sketch, so a second pass of the range sampler changes
    nothing). Rows that come from no file are not counted."""
    try:
        tagged = lake_df.withColumn("_file", F.col("_metadata.file_path"))
    except AnalysisException:
        return lake_df, None
    obs = Observation(f"files_{name}_{uuid.uuid4().hex[:8]}")
    return tagged.observe(obs, F.approx_count_distinct("_file", FILE_COUNT_RSD).alias("files")), obs


FILE_COUNT_RSD = 0.005     # relative error of the count of files read; small counts come out exact


def write_serving(spark: SparkSession, lake_df: DataFrame, spec: DatasetSpec, db: str, root: str,
                  buckets: int | None = None, mode: str = "overwrite", layout: str = "range",
                  input_bytes: int | None = None, max_ranges: int = MAX_RANGES,
                  max_records: int = MAX_RECORDS_PER_FILE, zorder_by: list[str] | None = None) -> dict:
    """Project, check and write one serving table; returns its load stats:
    rows, files (lake files that this load read), out-of-range counts,
    files_written, elapsed_s.

    ``input_bytes`` (the lake dataset's size on disk) and the lake's row count
    size the range layout: by file size and by the memory that sorting a range
    takes; without ``input_bytes`` the session's shuffle partition count is used and AQE merges
    small ranges."""
    t0 = time.time()
    tagged, files = _with_files(lake_df, spec.name)
    out = serve_projection(tagged, spec)
    parts = list(spec.serve_partition_by)
    sort_cols = [c for c in spec.sort_by if c not in parts]
    if buckets:
        # same hash as bucketBy: one file per bucket per partition directory
        laid_out = out.repartition(buckets, *spec.bucket_by)
    elif layout in ("range", "zorder"):
        n = range_count(input_bytes, max_ranges=max_ranges, parallelism=spark.sparkContext.defaultParallelism)
        if n:
            in_sort = sort_bytes(lake_df.count(), out.schema, input_bytes)      # the count reads the lake's footers
            n = max(n, range_count(in_sort, SORT_BYTES, max_ranges))
        if n == max_ranges:
            log.warning("%s: the range count is at its bound of %d; ranges hold more than %d MB",
                        spec.name, max_ranges, TARGET_FILE_BYTES >> 20)
        keyed, made = out, []
        if layout == "zorder":
            columns = list(zorder_by or spec.zorder_by)
            if not columns:
                raise ValueError(f"{spec.name}: layout 'zorder' needs zorder_by")
            keyed, key = zorder_key(out, columns)
            made = [key]
        order = [*parts, *made, *sort_cols]
        ranged = keyed.repartitionByRange(n, *order) if n else keyed.repartitionByRange(*order)
        laid_out = ranged.sortWithinPartitions(*order).drop(*made)
    elif layout == "rebalance":
        shuffled = out.hint("rebalance", *parts) if parts else out.hint("rebalance")
        laid_out = shuffled.sortWithinPartitions(*parts, *sort_cols)
    else:
        raise ValueError(f"unknown layout {layout!r}: use 'range', 'zorder' or 'rebalance'")
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode!r}: use 'overwrite' or 'append'")
    # Observed after the exchange: the range sampler's extra pass over the
    # input must not be counted.
    obs = Observation(f"serve_{spec.name}_{uuid.uuid4().hex[:8]}")
    laid_out = laid_out.observe(obs, F.count(F.lit(1)).alias("rows"), *range_violations(out, spec))
    current = current_version(spark, db, spec.name)
    writer = (laid_out.write.format("parquet").option("compression", "snappy")
              .option("maxRecordsPerFile", max_records))
    for column in spec.bloom:
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option("parquet.bloom.filter.adaptive.enabled", "true"))
    if parts:
        writer = writer.partitionBy(*parts)
    if buckets:
        writer = writer.bucketBy(buckets, *spec.bucket_by).sortBy(*sort_cols)
    if mode == "append" and current is not None:
        table_path = table_location(spark, db, spec.name)
        writer.mode("append").saveAsTable(f"`{db}`.`{current}`")
    else:
        table_path = _publish(spark, db, root, spec.name, writer)
    stats = dict(obs.get)
    stats["files"] = files.get["files"] if files else 0
    stats["elapsed_s"] = time.time() - t0
    # one file-system metadata call (no data read, no listing shipped to Python)
    stats["files_written"] = data_file_count(spark, table_path)
    return stats


def _version_of(name: str, table: str) -> str | None:
    found = re.fullmatch(rf"{re.escape(name)}__v([0-9a-f]{{12}})", table)
    return found and found[1]


def current_version(spark: SparkSession, db: str, name: str) -> str | None:
    """The version table that the public name points at (catalog metadata
    only); None if there is none, or the name is a table of someone else's."""
    if not spark.catalog.tableExists(f"{db}.{name}"):
        return None
    text = _table_detail(spark, db, name, "View Text") or ""
    found = re.search(rf"`({re.escape(name)}__v[0-9a-f]{{12}})`$", text.strip())
    return found and found[1]


def _publish(spark: SparkSession, db: str, root: str, name: str, writer) -> str:
    """Write a new version and point the public name at it; returns its folder."""
    current = current_version(spark, db, name)
    if current is None and spark.catalog.tableExists(f"{db}.{name}"):
        kind = _table_detail(spark, db, name, "Type")
        if kind in ("MANAGED", "VIEW"):
            raise RuntimeError(f"{db}.{name} is a {kind.lower()} table that this loader did not write; drop or rename it first")
        log.warning("%s.%s was not written by this loader; the catalog entry is replaced, its files stay", db, name)
    version = f"{name}__v{uuid.uuid4().hex[:12]}"
    path = f"{root.rstrip('/')}/{name}/{version[len(name) + 2:]}"
    try:
        writer.mode("error").option("path", path).saveAsTable(f"`{db}`.`{version}`")
    except BaseException:
        delete(spark, path)
        raise
    _point(spark, db, name, version)
    _drop_old(spark, db, root, name, keep={version, current})
    return path


def _point(spark: SparkSession, db: str, name: str, version: str) -> None:
    """Make the public name show ``version``: one catalog call if it is a view
    already, which it is after the first load."""
    query = f"SELECT * FROM `{db}`.`{version}`"
    if spark.catalog.tableExists(f"{db}.{name}") and _table_detail(spark, db, name, "Type") == "VIEW":
        spark.sql(f"ALTER VIEW `{db}`.`{name}` AS {query}")
        return
    if spark.catalog.tableExists(f"{db}.{name}"):
        spark.sql(f"DROP TABLE `{db}`.`{name}`")            # external: the files stay
    spark.sql(f"CREATE VIEW `{db}`.`{name}` AS {query}")


def _drop_old(spark: SparkSession, db: str, root: str, name: str, keep: set) -> None:
    """Remove versions of ``name`` other than ``keep``, files included, if they
    lie in this loader's folder."""
    for t in spark.sql(f"SHOW TABLES IN `{db}` LIKE '{name}__v*'").collect():
        if _version_of(name, t.tableName) and t.tableName not in keep:
            location = _table_detail(spark, db, t.tableName, "Location")
            spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{t.tableName}`")
            if location and _own_version(spark, location, root, name):
                delete(spark, location)


def _own_version(spark: SparkSession, location: str, root: str, name: str) -> bool:
    """Whether a table location is a version folder written by this loader."""
    folder = qualify(spark, f"{root.rstrip('/')}/{name}") + "/"
    found = qualify(spark, location)
    return found.startswith(folder) and re.fullmatch(r"v[0-9a-f]{12}", found[len(folder):]) is not None


def load_serving(spark: SparkSession, lake: dict[str, DataFrame], specs: dict[str, DatasetSpec],
                 db: str, root: str, datasets: list[str] | None = None, buckets: int | None = None,
                 mode: str = "overwrite", layout: str = "range",
                 input_bytes: dict[str, int] | None = None, max_ranges: int = MAX_RANGES,
                 max_records: int = MAX_RECORDS_PER_FILE) -> dict[str, dict]:
    """K5/K6/K7: load the chosen datasets (default all). ``mode='overwrite'``
    replaces the table (idempotent re-run); ``'append'`` adds rows. A
    dataset whose lake input is missing is skipped with zero stats. The
    statistics are also appended to the table ``load_stats``."""
    ensure_database(spark, db, f"{root.rstrip('/')}/_db")
    stats, loaded = {}, []
    for name in datasets or list(lake):
        if lake.get(name) is None:
            stats[name] = {"rows": 0, "files": 0, "elapsed_s": 0.0}
            continue
        if name == "titles" and mode == "append":
            stats[name] = append_titles(spark, lake[name], specs[name], db, root, buckets, layout,
                                        (input_bytes or {}).get(name), max_ranges, max_records)
        else:
            stats[name] = write_serving(spark, lake[name], specs[name], db, root, buckets, mode, layout,
                                        (input_bytes or {}).get(name), max_ranges, max_records)
            if name == "titles":
                write_rollup(spark, db, root)
        loaded.append(name)
    require_tables(spark, db, loaded)
    record_stats(spark, db, root, stats)
    return stats


STATS_TABLE = "load_stats"


def record_stats(spark: SparkSession, db: str, root: str, stats: dict[str, dict]) -> None:
    """K8: one row per dataset of a load, kept in the table ``load_stats``."""
    rows = [(name, int(s["rows"]), int(s["files"]), int(s.get("files_written") or 0),
             sum(int(v or 0) for k, v in s.items() if k.startswith("out_of_range_")), float(s["elapsed_s"]))
            for name, s in stats.items()]
    made = spark.createDataFrame(rows, "dataset string, rows long, files long, files_written long, out_of_range long, elapsed_s double")
    made = made.withColumn("loaded_at", F.current_timestamp())
    (made.coalesce(1).write.format("parquet").mode("append")
     .option("path", f"{root.rstrip('/')}/{STATS_TABLE}").saveAsTable(f"`{db}`.`{STATS_TABLE}`"))


def _table_detail(spark: SparkSession, db: str, name: str, detail: str) -> str | None:
    rows = (spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{name}`")
            .where(F.col("col_name") == detail).select("data_type").collect())
    return rows[0][0] if rows else None


ROLLUP_TABLE = "titles_by_genre"


def _store_rollup(spark: SparkSession, db: str, root: str, rows: DataFrame) -> None:
    """Publish a rollup. Its rows are bounded by genres x kinds x decades,
    hence one file, written after the aggregate and not by its last task."""
    _publish(spark, db, root, ROLLUP_TABLE, rows.repartition(1).write.format("parquet"))


def write_rollup(spark: SparkSession, db: str, root: str) -> None:
    """Store the genre rollup of the serving titles beside them, built from
    all of them."""
    _store_rollup(spark, db, root, build_rollup(read_serving(spark, db, "titles")))


def rollup_with(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """The stored rollup after ``delta`` (serving rows of titles) is added:
    reads the few stored rows and the delta, never the other titles."""
    return merge_rollups([stored, build_rollup(delta)])


def append_titles(spark: SparkSession, lake_df: DataFrame, spec: DatasetSpec, db: str, root: str, *layout) -> dict:
    """Append to titles and keep the rollup in step by merging in the sums of
    the appended rows. A rollup that did not cover all titles before (its
    counts, against the row count in the files' footers), as after a load that
    failed between the two steps, is rebuilt instead."""
    covered = (current_version(spark, db, "titles") is not None and current_version(spark, db, ROLLUP_TABLE) is not None
               and (read_serving(spark, db, ROLLUP_TABLE).agg(F.sum("cnt")).first()[0] or 0) == read_serving(spark, db, "titles").count())
    buckets, kind, *rest = layout
    stats = write_serving(spark, lake_df, spec, db, root, buckets, "append", kind, *rest)
    if covered:
        _store_rollup(spark, db, root, rollup_with(read_serving(spark, db, ROLLUP_TABLE), serve_projection(lake_df, spec)))
    else:
        write_rollup(spark, db, root)
    return stats


def table_location(spark: SparkSession, db: str, name: str) -> str | None:
    """Storage folder of the current version, or of a table that someone else
    wrote under the name (catalog metadata only), else None."""
    if not spark.catalog.tableExists(f"{db}.{name}"):
        return None
    return _table_detail(spark, db, current_version(spark, db, name) or name, "Location")


def require_tables(spark: SparkSession, db: str, names: list[str]) -> None:
    """Fail with one message naming every missing table."""
    missing = [n for n in names if not spark.catalog.tableExists(f"{db}.{n}")]
    if missing:
        raise RuntimeError(f"serving tables missing in {db}: {missing}")


def read_serving(spark: SparkSession, db: str, name: str) -> DataFrame:
    """The current version of a serving table, itself (with its files'
    metadata and layout), or whatever else has the name."""
    return spark.table(f"`{db}`.`{current_version(spark, db, name) or name}`")

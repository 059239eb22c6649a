"""Parquet lake: write (K1-K4) and read back.

Layout: ``<root>/<dataset>/<col>=<value>/.../part-*.snappy.parquet``.

Writes are one job per dataset. Before a partitioned write the rows are
*rebalanced* on the partition columns (AQE ``RebalancePartitions``): rows of
one directory go to the same tasks, so each directory gets few files, and a
directory holding a third of all rows is split into several advisory-size
tasks instead of one straggler (a plain ``repartition(cols)`` would put it
in one task). File size therefore follows task size (about the advisory
partition size); ``maxRecordsPerFile`` is only a loose safety bound.
"""

from __future__ import annotations

import logging
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.sources.fs import child_folders, delete, exists, replace_folder
from mediamart.specs import DatasetSpec

log = logging.getLogger("mediamart")

# Safety bound only: files are sized by bytes (rebalance advisory size here,
# range count in the serving layout), so a task rarely reaches it. Narrow
# datasets store under 10 bytes a row; a low row cap would split every
# 128 MB task into dozens of small files.
MAX_RECORDS_PER_FILE = 10_000_000


def _beside(path: str) -> str:
    """A fresh hidden folder next to ``path`` (same file system, so a rename
    moves it into place)."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}_new_{uuid.uuid4().hex[:12]}"


def _write(df: DataFrame, path: str, partition_by, mode: str, max_records: int) -> None:
    out = df.hint("rebalance", *partition_by) if partition_by else df.hint("rebalance")
    (out.write.mode(mode)
     .option("compression", "snappy")
     .option("maxRecordsPerFile", max_records)
     .partitionBy(*partition_by)
     .parquet(path))


def write_lake(df: DataFrame, path: str, partition_by: tuple[str, ...] | list[str],
               mode: str = "overwrite", max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """K1/K2: one job, Snappy Parquet, an idempotent full rebuild
    (``overwrite``) or ``append``. A rebuild is written next to the dataset
    and swapped in when it succeeded, so a failed one leaves the old rows."""
    if mode != "overwrite":
        _write(df, path, partition_by, mode, max_records)
        return
    fresh = _beside(path)
    try:
        _write(df, fresh, partition_by, "error", max_records)
        replace_folder(df.sparkSession, fresh, path)
    except BaseException:
        delete(df.sparkSession, fresh)
        raise


def overwrite_slice(df: DataFrame, path: str, column: str, value: str,
                    sub_partition_by: tuple[str, ...] = (), max_records: int = MAX_RECORDS_PER_FILE) -> int:
    """K3: rewrite one value of the first partition column, e.g. one
    titleType, leaving every other slice untouched; returns the rows written.

    The slice is written next to the dataset by Spark's own partitioning (so
    the directory name is the writer's) and its directory is swapped in whole:
    a re-run is idempotent and sub-partitions that vanished from the source
    disappear too. An empty value has no directory of its own and is refused;
    a value without rows (a typo, say) is logged and changes nothing."""
    if not value:
        raise ValueError(f"{column}: a slice needs a non-empty value")
    spark, fresh = df.sparkSession, _beside(path)
    part = df.filter(F.col(column) == value)
    try:
        _write(part, fresh, (column, *sub_partition_by), "error", max_records)
        made = [d for d in child_folders(spark, fresh) if d.startswith(f"{column}=")]
        rows = spark.read.schema(part.schema).parquet(fresh).count() if made else 0   # from the footers
        if rows:
            (name,) = made
            replace_folder(spark, f"{fresh}/{name}", f"{path.rstrip('/')}/{name}")
        else:
            log.warning("%s = %r has no rows; %s is left as it was", column, value, path)
    finally:
        delete(spark, fresh)
    return rows


def _path_value(column: str) -> Column:
    """A partition column's value from the path of the row's file: the
    directory ``column=value``, decoded; the Hive default name is NULL."""
    found = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(column)}=([^/]*)/", 1)
    # the path is a URI, so what the writer escaped is escaped once more; '+' is itself
    plain = found
    for _ in range(2):
        plain = F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))
    return F.when(F.length(found) > 0, F.nullif(plain, F.lit("__HIVE_DEFAULT_PARTITION__")))


def read_lake_own_columns(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """S6 for lakes whose files hold partition columns themselves: the value in
    the file wins, the directory's fills in where the file has none (or
    NULL). Files are read as they lie, without partition discovery, so a
    filter on a partition column prunes by the files' statistics only; use
    :func:`read_lake` where files do not hold these columns."""
    if not exists(spark, path):
        log.warning("lake dataset not found, read as empty: %s", path)
        return spark.createDataFrame([], spec.lake_schema)
    files = spark.read.schema(spec.lake_schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
    types = {f.name: f.dataType for f in spec.lake_schema}
    return files.select(*[
        F.coalesce(F.col(c), _path_value(c).try_cast(types[c])).alias(c) if c in spec.partition_by else F.col(c)
        for c in spec.column_names()])


def read_lake(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """Read a dataset with its declared schema.

    The declared schema keeps partition values typed as declared ('007'
    stays a string) and lets an absent dataset read as an empty table
    instead of failing schema inference. Partition values are URL-decoded
    and ``__HIVE_DEFAULT_PARTITION__`` becomes NULL by partition discovery."""
    if not exists(spark, path):
        log.warning("lake dataset not found, read as empty: %s", path)
        return spark.createDataFrame([], spec.lake_schema)
    return spark.read.schema(spec.lake_schema).option("basePath", path).parquet(path)


def build_lake(spark: SparkSession, root: str, frames: dict[str, DataFrame],
               specs: dict[str, DatasetSpec], datasets: list[str] | None = None,
               max_records: int = MAX_RECORDS_PER_FILE) -> dict[str, str]:
    """K4: write the chosen datasets (default: all), one job each."""
    written = {}
    for name in datasets or list(frames):
        path = f"{root.rstrip('/')}/{name}"
        write_lake(frames[name], path, specs[name].partition_by, max_records=max_records)
        written[name] = path
    return written

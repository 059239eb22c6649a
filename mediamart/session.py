"""Session construction and the shared working folder.

Everything the library writes (lake, serving tables, TSV copies) goes below
the folder the cluster names in ``spark.checkpoint.dir``. On a cluster that
is shared storage (HDFS, object store); a machine-local temp folder is only
used when the setting is absent, which happens in tests and local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from mediamart.sources.fs import delete

# Session settings the pipeline relies on. AQE is what turns the static plan
# into a scale-safe one: it coalesces small shuffle partitions, converts a
# sort-merge join to a broadcast join only when the *measured* build side is
# under the threshold below, and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Compressed shuffle bytes of a task. Narrow rows take about ten times as
    # much in a sort, so a task of the lake write sorts some 330 MB and four of
    # them fit an executor's memory without spilling.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Static and runtime broadcast thresholds: a join side is broadcast only
    # when its estimated (static) or measured (AQE) size is below this. All of
    # a broadcast side passes through the driver, as rows and as a hash table.
    # The static estimate starts from compressed file bytes, which are far
    # fewer than the rows' (gzip TSV, narrow Parquet): hence the factor.
    "spark.sql.autoBroadcastJoinThreshold": "8m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16m",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "mediamart", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's master and a
    shuffle partition count sized to the data (about 128 MB per partition);
    AQE coalesces from there."""
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (e.g. one the
    caller built). Only SQL confs, which are settable at runtime."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir``.

    When the session has none and runs in local mode (tests, ad-hoc local
    runs) a fresh local folder is created and registered as the checkpoint
    dir, so later calls and ``DataFrame.checkpoint()`` agree on it. On a
    cluster a machine-local folder would be invisible to the executors and
    lost with the driver, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(HDFS or object store) for the lake, serving tables and checkpoints")
        base = tempfile.mkdtemp(prefix="mediamart-ckpt-")
        # spark.checkpoint.dir is a core conf and cannot be set at runtime;
        # the context keeps the folder, so later calls find it again.
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    return base.rstrip("/")


def size_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = 64 << 20) -> int:
    """Start shuffles with enough partitions for ``input_bytes`` (compressed
    input of ``per_partition`` bytes each, never fewer than the session's
    count). AQE merges small ones afterwards but does not split uniformly
    large ones, so the start has to come from the data."""
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(input_bytes) // per_partition))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return n


# (application, slot) -> folder and database of the slot's latest use
_SLOTS: dict[tuple[str, str], tuple[str, str | None]] = {}


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused location below the shared folder."""
    return "/".join([shared_dir(spark), "mediamart", spark.sparkContext.applicationId, uuid.uuid4().hex, *parts])


def scratch_slot(spark: SparkSession, slot: str, database: str | None = None) -> str:
    """A fresh location that replaces the slot's previous one, whose folder
    (and database) is removed now. Results are lazy, so a location stays until
    the slot's next use; ``clear_scratch`` removes all at the session's end."""
    key = (spark.sparkContext.applicationId, slot)
    old = _SLOTS.pop(key, None)
    if old:
        _remove(spark, *old)
    path = scratch_path(spark, slot)
    _SLOTS[key] = (path, database)
    return path


def _remove(spark: SparkSession, path: str, database: str | None) -> None:
    if database:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
    delete(spark, path.rsplit("/", 1)[0])


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote below the shared folder, and
    the databases of its slots. Call it when no result is read any more."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SLOTS if k[0] == app]:
        _remove(spark, *_SLOTS.pop(key))
    delete(spark, "/".join([shared_dir(spark), "mediamart", app]))

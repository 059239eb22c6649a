"""File-system metadata through the session's Hadoop FileSystem, so the same
calls work for local paths, HDFS and object stores. Metadata only: no data
is read and nothing but a flag or a number comes back to the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes of all files below ``path``."""
    fs, hpath = _fs_and_path(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def data_file_count(spark: SparkSession, path: str) -> int:
    """Data files below a table folder written by Spark: one content-summary
    call (checksum files are not counted) minus the job's ``_SUCCESS``
    marker. Nothing is listed into Python, so it stays cheap at a million
    files."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return 0
    files = int(fs.getContentSummary(hpath).getFileCount())
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(hpath, "_SUCCESS")
    return files - (1 if fs.exists(marker) else 0)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file lies below ``path``; stops at the first one."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return False
    files = fs.listFiles(hpath, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path`` (none if it is missing)."""
    fs, hpath = _fs_and_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()) if fs.exists(hpath) else []


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put folder ``new`` in the place of ``target``. The old folder is moved
    aside first and deleted last, and moved back if the new one cannot be put
    in its place, so a failure leaves one of the two readable. Between the two
    renames (two metadata calls) the target is absent."""
    fs, target_path = _fs_and_path(spark, target)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    aside = path(target_path.getParent(), f"_{target_path.getName()}_old_{uuid.uuid4().hex[:12]}")
    had_old = bool(fs.exists(target_path))
    if had_old and not fs.rename(target_path, aside):
        raise OSError(f"cannot move {target} aside")
    fs.mkdirs(target_path.getParent())
    if not fs.rename(path(new), target_path):
        if had_old:
            fs.rename(aside, target_path)
        raise OSError(f"cannot put {new} in the place of {target}")
    if had_old:
        fs.delete(aside, True)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and everything below it (a superseded table version)."""
    fs, hpath = _fs_and_path(spark, path)
    fs.delete(hpath, True)


def qualify(spark: SparkSession, path: str) -> str:
    """Fully qualified form of a path (scheme and authority), for comparing."""
    fs, hpath = _fs_and_path(spark, path)
    return str(fs.makeQualified(hpath).toString()).rstrip("/")

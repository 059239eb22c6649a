"""Small helpers shared by the operators: shipping the package to executors,
written intermediate tables, id remainders and numpy/Arrow conversions."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart.session import scratch_path

_SHIPPED: set[str] = set()
BROADCAST_IDS = 1_000_000       # repeated ids up to this number are broadcast


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that the
    functions that run in tasks can be imported there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="mediamart-ship-")
    target = os.path.join(folder, "mediamart_llm.zip")
    with zipfile.ZipFile(target, "w") as z:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later uses do
    not recompute it and survive the loss of an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, mod: int) -> Column:
    """crc32 of the id as text modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % mod


def spread(spark: SparkSession, size_bytes: int, per_task: int = 16 << 20) -> int:
    """Number of blocks for ``size_bytes`` of data at ``per_task`` bytes each,
    never fewer than the session's default parallelism."""
    return max(spark.sparkContext.defaultParallelism, 1, -(-int(size_bytes) // per_task))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return ["" if v is None else v for v in column.to_pylist()]


def slices(batch: pa.RecordBatch, column: int, limit: int = 2 << 20):
    """Cut a batch into consecutive runs of rows whose text ``column`` holds about
    ``limit`` bytes (a single longer value makes a run of its own)."""
    if batch.num_rows == 0:
        return
    col = batch.column(column)
    size = np.asarray([0 if n is None else n for n in pa.compute.binary_length(col).to_pylist()], np.int64)
    start, held = 0, 0
    for i, n in enumerate(size):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    yield batch.slice(start)


def int_list(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def valid_vectors(df: DataFrame, id_col: str, vec_col: str, zero_ok: bool) -> DataFrame:
    """(vec_id, v) of the rows that take part: id set, vector not null or
    empty, every component set and finite (and, unless ``zero_ok``, not all
    zero). Repeated rows of an id count once (the smallest vector)."""
    v = F.col(vec_col).cast("array<double>")
    inf = float("inf")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf))))
    if not zero_ok:
        rows = rows.where(F.exists("v", lambda x: x != 0.0))
    # repeats are rare: they are found on the ids alone, so that vectors do not move for them
    repeated = written(rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id"), "repeated_ids")
    n = repeated.count()
    if not n:
        return rows
    some = F.broadcast(repeated) if n <= BROADCAST_IDS else repeated
    least = rows.join(some, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    return rows.join(some, "vec_id", "left_anti").unionByName(least)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a non-null list<double> column of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def appended(df: DataFrame, column: str, kind: str, text_col: str, compute) -> DataFrame:
    """``df`` with one more column that ``compute(values: list[bytes]) ->
    pa.Array`` makes from the whole texts, run by run of a few megabytes."""
    ship(df.sparkSession)
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, at):
                new = compute(text_bytes(part.column(at)))
                yield pa.RecordBatch.from_arrays([*part.columns, new], names=[*part.schema.names, column])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{column}` {kind}")

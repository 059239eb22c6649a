"""Data-quality checks.

Every check is a DataFrame (aggregates computed on the executors, a handful
of rows out), so it can be collected, asserted on or written like any
result. Loops below run over the four dataset *names* to build one plan;
they never iterate over data.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamart.functions import out_of_range, readable_size
from mediamart.operators.clean import clean, required_filter
from mediamart.sinks.serve import serve_projection
from mediamart.specs import DatasetSpec


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _side_by_side(frames: list[DataFrame]) -> DataFrame:
    """Put several one-row aggregates next to each other: UNION ALL with
    missing columns as NULL, then max() per column (no join)."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def tagged_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (tbl, rows) row per table, UNION ALL of global counts."""
    return _union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
                   for name, df in tables.items()])


def row_loss(raw: DataFrame, cleaned: DataFrame, spec: DatasetSpec) -> DataFrame:
    """C4: rows in, rows out and rows with a NULL required key. The cleaner
    loses no row exactly when rows_in = rows_out + null_key_rows. The two
    counts are taken in passes of their own, so that the check does not rest
    on the cleaner's plan."""
    cond = required_filter(spec)
    null_keys = (F.count_if(~cond) if cond is not None
                 else F.lit(0).cast("long"))
    stats_in = raw.agg(F.count(F.lit(1)).alias("rows_in"), null_keys.alias("null_key_rows"))
    stats_out = cleaned.agg(F.count(F.lit(1)).alias("rows_out"))
    return (_side_by_side([stats_in, stats_out])
            .select(F.lit(spec.name).alias("dataset"), "rows_in", "rows_out", "null_key_rows"))


def malformed_values(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Per numeric column: non-NULL raw text whose typed value is NULL."""
    numeric = [d for d in spec.columns
               if isinstance(d.dtype, (T.IntegerType, T.FloatType)) and d.name in spec.raw]
    if not numeric:
        return raw.sparkSession.createDataFrame([], "dataset string, column_name string, malformed long")
    aggs = [F.sum((F.col(d.name).isNotNull() & d.build().isNull()).cast("long")).alias(d.name)
            for d in numeric]
    wide = raw.agg(*aggs)
    stack = ", ".join(f"'{d.name}', `{d.name}`" for d in numeric)
    return wide.selectExpr(f"stack({len(numeric)}, {stack}) AS (column_name, malformed)").select(
        F.lit(spec.name).alias("dataset"), "column_name", F.coalesce("malformed", F.lit(0)).alias("malformed"))


def reconcile(lake: DataFrame, serve: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Lake rows vs serving rows, values outside the unsigned serving
    range, and keys that occur more than once (they fan out joins)."""
    oor = [out_of_range(c.name, c.unsigned).cast("long") for c in spec.serve if c.unsigned]
    bad = reduce(lambda a, b: a + b, oor) if oor else F.lit(0).cast("long")
    # one scan of the lake: rows and violations are summed within the grouping
    # that finds repeated keys
    per_key = lake.groupBy(*spec.unique_key).agg(F.count(F.lit(1)).alias("n"), F.sum(bad).alias("bad"))
    lake_stats = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("lake_rows"), F.coalesce(F.sum("bad"), F.lit(0)).alias("out_of_range"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"))
    serve_stats = serve.agg(F.count(F.lit(1)).alias("serve_rows"))
    return (_side_by_side([lake_stats, serve_stats])
            .select(F.lit(spec.name).alias("dataset"), "lake_rows", "serve_rows",
                    (F.col("lake_rows") == F.col("serve_rows")).alias("counts_match"),
                    "out_of_range", "duplicate_keys"))


def row_hashes(df: DataFrame) -> list[Column]:
    """Two 32-bit hashes of a whole row, as longs, so that sums of very many
    stay exact. NULL and empty values, and values that stand in another
    column, give other hashes."""
    marks, values = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        marks.append(c.isNull())
        if isinstance(f.dataType, T.ArrayType):
            marks += [F.coalesce(F.size(c), F.lit(-1)), F.transform(c, lambda x: x.isNull())]
        values.append(c)
    whole = F.xxhash64(*marks, *values)
    return [whole.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(whole, 32)]


def content_match(lake: DataFrame, serve: DataFrame, spec: DatasetSpec) -> DataFrame:
    """C5 by content: per partition of the serving table, rows of both sides
    and whether the sides hold the same rows (as multisets, in any order).
    One scan of each side: the counts and the hash sums come from the same
    aggregate, one row per partition and task is shuffled. ``lake`` is put
    through the serving projection first."""
    parts = list(spec.serve_partition_by)
    sides = []
    for name, df in (("lake", serve_projection(lake, spec)), ("serve", serve.select(*[c.name for c in spec.serve]))):
        low, high = row_hashes(df)
        sides.append(df.select(F.lit(name).alias("side"), *parts, low.alias("low"), high.alias("high"))
                     .groupBy("side", *parts).agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")))
    of = {s: F.col("side") == s for s in ("lake", "serve")}

    def total(side: str, c: str) -> Column:
        return F.coalesce(F.sum(F.when(of[side], F.col(c))), F.lit(0))

    both = sides[0].unionByName(sides[1]).groupBy(*parts).agg(
        total("lake", "n").alias("lake_rows"), total("serve", "n").alias("serve_rows"),
        *[(total("lake", c) == total("serve", c)).alias(f"_{c}") for c in ("low", "high")])
    return both.select(F.lit(spec.name).alias("dataset"), *parts, "lake_rows", "serve_rows",
                       ((F.col("lake_rows") == F.col("serve_rows")) & F.col("_low") & F.col("_high")).alias("same_content"))


def partition_flow(raw: DataFrame, spec: DatasetSpec, lake: DataFrame | None = None) -> DataFrame:
    """C4 by partition: for every lake partition, every value of its first
    column and the whole table (``level`` 2, 1, 0 for two columns): rows that
    the raw source has there, those dropped for a missing key, those whose
    partition value is a filled-in default, and the rows of the cleaned table
    (``lake``: another one to hold against it). Rows got lost or were gained
    where raw_rows - dropped differs from lake_rows."""
    parts = list(spec.partition_by)
    made = {d.name: d for d in spec.columns}
    kept = required_filter(spec)
    kept = F.lit(True) if kept is None else kept
    filled = reduce(lambda a, b: a | b, [
        F.col(p).isNull() | (F.trim(p) == "") for p in parts if p in spec.raw] or [F.lit(False)])
    source = raw.select(*[made[p].build().alias(p) for p in parts], F.lit(1).alias("raw_rows"), F.when(kept, 0).otherwise(1).alias("dropped"),
                        F.when(kept & filled, 1).otherwise(0).alias("defaulted"), F.lit(0).alias("lake_rows"))
    cleaned = (clean(raw, spec) if lake is None else lake).select(
        *parts, *[F.lit(n).alias(c) for c, n in (("raw_rows", 0), ("dropped", 0), ("defaulted", 0), ("lake_rows", 1))])
    levels = [[F.col(p) for p in parts[:i]] for i in range(len(parts), -1, -1)]
    sums = [F.sum(c).alias(c) for c in ("raw_rows", "dropped", "defaulted", "lake_rows")]
    # aggregated by the full partition first: the sets then expand few rows
    each = source.unionByName(cleaned).groupBy(*parts).agg(*sums)
    flow = each.groupingSets(levels, *parts).agg(F.grouping_id().alias("_gid"), *sums)
    shown = F.lit(len(parts)) - F.bit_count("_gid")
    return flow.select(F.lit(spec.name).alias("dataset"), shown.cast("int").alias("level"),
                       *[F.col(p).cast("string").alias(f"part{i + 1}") for i, p in enumerate(parts)],
                       *[F.lit(None).cast("string").alias(f"part{i + 1}") for i in range(len(parts), 2)],
                       "raw_rows", "dropped", "defaulted", "lake_rows",
                       (F.col("raw_rows") - F.col("dropped") == F.col("lake_rows")).alias("balanced"))


def range_violations(lake: DataFrame, spec: DatasetSpec) -> DataFrame:
    """P10: (tbl, column_name, out_of_range) per unsigned serving column, one scan."""
    checked = [c for c in spec.serve if c.unsigned]
    wide = lake.agg(*[F.count_if(out_of_range(c.name, c.unsigned)).alias(c.name) for c in checked])
    stack = ", ".join(f"'{c.name}', `{c.name}`" for c in checked)
    return wide.selectExpr(f"'{spec.name}' AS tbl", f"stack({len(checked)}, {stack}) AS (column_name, out_of_range)")


def storage_report(stored: dict[tuple[str, str], tuple[DataFrame, int, int]]) -> DataFrame:
    """Bytes, files and rows per (layer, table) with a readable size.
    ``stored`` maps (layer, table) to its DataFrame and to the bytes and files
    that the file system's metadata gives (``sources.fs``); only the row counts
    are jobs, and those read Parquet footers."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("tbl"), F.lit(size).cast("long").alias("bytes"),
            F.lit(files).cast("long").alias("files"), "rows")
        for (layer, name), (df, size, files) in stored.items()]).withColumn("disk_size", readable_size("bytes"))


def unsorted_pairs(files_df: DataFrame, key: list[str], group_by: list[str]) -> DataFrame:
    """Per group, rows and adjacent row pairs inside one data file that
    break ascending ``key`` order, NULL first (0 when every file is sorted).

    ``files_df`` must come straight from a file scan: its rows arrive in file
    order. Each task compares neighbours batch by batch and sends one row per
    run of a file and group, with the run's first and last key; only those few
    rows are shuffled, to compare where one run ends and the next begins."""
    types = dict(files_df.dtypes)
    names = [*group_by, *key]
    rows = files_df.select(F.col("_metadata.file_path").alias("file__"), F.col("_metadata.row_index").alias("pos__"), *names)
    ng, nk = len(group_by), len(key)

    def breaks(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = batch.columns
            runs, keys = [cols[0], *cols[2:2 + ng]], cols[2 + ng:]
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for c in runs:
                new[1:] |= ~_same(c)
            bad, equal = np.zeros(batch.num_rows - 1, bool), np.ones(batch.num_rows - 1, bool)
            for c in keys:
                bad |= equal & _falls(c)
                equal &= _same(c)
            bad = np.r_[False, bad] & ~new
            first = np.flatnonzero(new)
            last = np.r_[first[1:], batch.num_rows] - 1
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(first)) for c in cols), *(c.take(pa.array(last)) for c in keys),
                 pa.array(last - first + 1), pa.array(np.add.reduceat(bad.astype(np.int64), first))],
                names=["file__", "pos__", *names, *(f"last__{i}" for i in range(nk)), "rows__", "bad__"])

    fields = ["file__ string", "pos__ long", *(f"`{c}` {types[c]}" for c in names),
              *(f"last__{i} {types[k]}" for i, k in enumerate(key)), "rows__ long", "bad__ long"]
    runs = rows.mapInArrow(breaks, ", ".join(fields))
    # a run against the one before it in its file
    before = Window.partitionBy("file__").orderBy("pos__")
    falls, equal = F.lit(False), F.lit(True)
    for i, k in enumerate(key):
        last, now = F.lag(f"last__{i}").over(before), F.col(k)
        falls = falls | (equal & last.isNotNull() & (now.isNull() | F.coalesce(last > now, F.lit(False))))
        equal = equal & last.eqNullSafe(now)
    has_before = F.lag("pos__").over(before).isNotNull()
    return (runs.withColumn("edge__", (has_before & falls).cast("long"))
            .groupBy(*group_by).agg(F.sum("rows__").alias("row_count"), F.sum(F.col("bad__") + F.col("edge__")).alias("unsorted_pairs")))


def _same(c: pa.Array) -> np.ndarray:
    """Whether each value equals the one before it (NULL equals NULL)."""
    a, b = c[:-1], c[1:]
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    return np.asarray(pc.or_(both_null, pc.fill_null(pc.equal(a, b), False)))


def _falls(c: pa.Array) -> np.ndarray:
    """Whether each value is smaller than the one before it (NULL is smallest)."""
    a, b = c[:-1], c[1:]
    to_null = pc.and_(pc.is_valid(a), pc.is_null(b))
    return np.asarray(pc.or_(to_null, pc.fill_null(pc.greater(a, b), False)))

"""The two batch jobs as functions: ``etl`` (raw TSV -> Parquet lake) and
``load`` (lake -> serving tables + verification).

    from mediamart.jobs import etl, load
    etl(spark, "/data/raw", "/data/lake")                       # all datasets
    etl(spark, "/data/raw", "/data/lake", ["titles"], title_type="movie")   # one slice
    stats = load(spark, "/data/lake", "/data/serve", db="media")

Each dataset is one Spark job. Inputs are checked up front (every missing
file reported at once); a lake dataset without data files is skipped at load time
with zero statistics, its serving table staying as it was.
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, SparkSession

from mediamart import specs
from mediamart.operators import checks
from mediamart.operators.clean import clean
from mediamart.operators.enrich import titles_mart
from mediamart.sinks.lake import MAX_RECORDS_PER_FILE, overwrite_slice, read_lake, write_lake
from mediamart.sinks.serve import MAX_RANGES, load_serving, read_serving
from mediamart.session import apply_conf, size_shuffles
from mediamart.sources.fs import has_data, size_bytes
from mediamart.sources.tsv import check_inputs, read_tsv

log = logging.getLogger("mediamart")

DATASETS = ("titles", "people", "principals", "akas")
# lake dataset -> raw sources it is built from
INPUTS = {"titles": ("basics", "ratings"), "people": ("people",),
          "principals": ("principals",), "akas": ("akas",)}


def lake_frame(spark: SparkSession, input_dir: str, dataset: str, check_header: bool = False) -> DataFrame:
    """The cleaned DataFrame of one lake dataset, read from its TSV input(s)."""
    def src(name):
        spec = specs.SOURCES[name]
        return clean(read_tsv(spark, f"{input_dir.rstrip('/')}/{spec.file_stem}", spec, check_header), spec)
    if dataset == "titles":
        return titles_mart(src("basics"), src("ratings"))
    return src(dataset)


def etl(spark: SparkSession, input_dir: str, output_dir: str, datasets: list[str] | None = None,
        title_type: str | None = None, check_header: bool = False,
        max_records: int = MAX_RECORDS_PER_FILE) -> dict[str, str]:
    """Build the lake. ``datasets`` defaults to all four. With ``title_type``
    only that titleType slice of titles is rewritten (idempotent).
    ``max_records`` bounds the rows of a file."""
    chosen = list(datasets or DATASETS)
    unknown = set(chosen) - set(DATASETS)
    if unknown:
        raise ValueError(f"unknown datasets {sorted(unknown)}; choose from {DATASETS}")
    found = check_inputs(spark, input_dir, [specs.SOURCES[s] for d in chosen for s in INPUTS[d]])
    apply_conf(spark)
    written = {}
    for name in chosen:
        path = f"{output_dir.rstrip('/')}/{name}"
        size_shuffles(spark, sum(size_bytes(spark, found[s]) for s in INPUTS[name]))
        df = lake_frame(spark, input_dir, name, check_header)
        if name == "titles" and title_type is not None:
            overwrite_slice(df, path, "titleType", title_type, ("decade",), max_records)
        else:
            write_lake(df, path, specs.LAKE[name].partition_by, max_records=max_records)
        written[name] = path
    return written


def load(spark: SparkSession, lake_dir: str, serve_root: str, db: str, only: list[str] | None = None,
         truncate: bool = True, buckets: int | None = None, verify: bool = True,
         layout: str = "range", max_ranges: int = MAX_RANGES, max_records: int = MAX_RECORDS_PER_FILE) -> dict:
    """Load serving tables from the lake. ``truncate`` (default) replaces
    the tables, so a re-run never duplicates; ``truncate=False`` appends.
    The genre rollup is stored beside titles: rebuilt with them, merged with
    the new rows' sums on an append. Returns per-dataset statistics (``files``:
    lake files that the load itself read), which the table ``load_stats`` keeps
    too, and, with ``verify``, the tagged row counts of the serving tables."""
    t0 = time.time()
    apply_conf(spark)
    chosen = list(only or DATASETS)
    lake, sizes = {}, {}
    for name in chosen:
        path = f"{lake_dir.rstrip('/')}/{name}"
        if has_data(spark, path):
            lake[name] = read_lake(spark, path, specs.LAKE[name])
            sizes[name] = size_bytes(spark, path)
        else:
            log.warning("lake dataset without data files, skipped: %s", path)
            lake[name] = None
    stats = load_serving(spark, lake, specs.LAKE, db, serve_root, chosen, buckets=buckets,
                         mode="overwrite" if truncate else "append", layout=layout, input_bytes=sizes,
                         max_ranges=max_ranges, max_records=max_records)
    result = {"stats": stats, "total_elapsed_s": time.time() - t0}
    if verify:
        present = {n: read_serving(spark, db, n) for n in chosen if lake[n] is not None}
        result["counts"] = {r.tbl: r.rows for r in checks.tagged_counts(present).collect()} if present else {}
    return result

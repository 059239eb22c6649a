"""All layers for one input directory: raw -> clean -> lake -> serving.

Each dataset of each layer is built at most once per Spark application and
input directory, on first use (the lake and serving tables are written below
``spark.checkpoint.dir``); queries then read whichever layer they are about. Written layers cut the
lineage: later plans start from Parquet files, not from the raw derivation.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from mediamart import specs
from mediamart.operators.clean import clean
from mediamart.operators.enrich import titles_mart
from mediamart.plans.analogs import raw_frame
from mediamart.session import scratch_path
from mediamart.sources.fs import data_file_count, size_bytes
from mediamart.sinks.lake import build_lake, read_lake, write_lake
from mediamart.sinks.serve import ROLLUP_TABLE, ensure_database, load_serving, read_serving, record_stats, table_location, write_rollup, write_serving

LAKE_DATASETS = ("titles", "people", "principals", "akas")

_LOCK = threading.RLock()
_CACHE: dict[tuple[str, str], "Workbench"] = {}


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str, buckets: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.buckets = buckets   # None: range-partitioned serving tables (see sinks.serve)
        self._lake_root: str | None = None
        self._lake_done: set[str] = set()
        self._serve_db: str | None = None
        self._serve_root: str | None = None
        self._serve_stats: dict[str, dict] = {}

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Workbench":
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        with _LOCK:
            if key not in _CACHE:
                _CACHE[key] = cls(spark, sf_dir)
            return _CACHE[key]

    # raw and clean ---------------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return raw_frame(self.spark, self.sf_dir, name)

    def clean(self, name: str) -> DataFrame:
        return clean(self.raw(name), specs.SOURCES[name])

    def titles(self) -> DataFrame:
        return titles_mart(self.clean("basics"), self.clean("ratings"))

    def lake_frame(self, name: str) -> DataFrame:
        return self.titles() if name == "titles" else self.clean(name)

    def lake_frames(self) -> dict[str, DataFrame]:
        return {n: self.lake_frame(n) for n in LAKE_DATASETS}

    # lake ------------------------------------------------------------------
    def write_lake(self, root: str | None = None, adopt: bool = False) -> str:
        """Write all four datasets into a fresh lake (one job each). With
        ``adopt`` it becomes this workbench's lake."""
        root = root or scratch_path(self.spark, "lake")
        build_lake(self.spark, root, self.lake_frames(), specs.LAKE, list(LAKE_DATASETS))
        if adopt:
            with _LOCK:
                self._lake_root, self._lake_done = root, set(LAKE_DATASETS)
        return root

    def lake_path(self, name: str) -> str:
        """Path of one dataset in this workbench's lake, written on first use
        (a query pays only for the datasets it reads)."""
        with _LOCK:
            if self._lake_root is None:
                self._lake_root = scratch_path(self.spark, "lake")
            path = f"{self._lake_root}/{name}"
            if name not in self._lake_done:
                write_lake(self.lake_frame(name), path, specs.LAKE[name].partition_by)
                self._lake_done.add(name)
            return path

    def lake(self, name: str) -> DataFrame:
        return read_lake(self.spark, self.lake_path(name), specs.LAKE[name])

    # serving ---------------------------------------------------------------
    def load_serving(self, db: str | None = None, root: str | None = None,
                     mode: str = "overwrite", adopt: bool = False) -> tuple[str, str, dict]:
        """Load all four serving tables into a (fresh) database. With
        ``adopt`` they become this workbench's serving layer."""
        root = root or scratch_path(self.spark, "serve")
        db = db or "mm_" + root.rstrip("/").split("/")[-2][:12]
        lake = {n: self.lake(n) for n in LAKE_DATASETS}
        sizes = {n: size_bytes(self.spark, self.lake_path(n)) for n in LAKE_DATASETS}
        stats = load_serving(self.spark, lake, specs.LAKE, db, root, list(LAKE_DATASETS),
                             buckets=self.buckets, mode=mode, input_bytes=sizes)
        if adopt:
            with _LOCK:
                self._serve_db, self._serve_root, self._serve_stats = db, root, dict(stats)
        return db, root, stats

    def _serving_table(self, name: str) -> str:
        """Database holding ``name``; the table is loaded on first use."""
        with _LOCK:
            if self._serve_db is None:
                root = scratch_path(self.spark, "serve")
                db = "mm_" + root.rstrip("/").split("/")[-2][:12]
                ensure_database(self.spark, db, f"{root}/_db")
                self._serve_db, self._serve_root = db, root
            if name not in self._serve_stats:
                self._serve_stats[name] = write_serving(
                    self.spark, self.lake(name), specs.LAKE[name], self._serve_db, self._serve_root,
                    self.buckets, input_bytes=size_bytes(self.spark, self.lake_path(name)))
                record_stats(self.spark, self._serve_db, self._serve_root, {name: self._serve_stats[name]})
                if name == "titles":
                    write_rollup(self.spark, self._serve_db, self._serve_root)
            return self._serve_db

    def serving(self) -> tuple[str, str, dict]:
        """The whole serving layer (all tables loaded): db, root, load stats."""
        for name in LAKE_DATASETS:
            self._serving_table(name)
        return self._serve_db, self._serve_root, {n: self._serve_stats[n] for n in LAKE_DATASETS}

    def serve(self, name: str) -> DataFrame:
        return read_serving(self.spark, self._serving_table(name), name)

    def rollup(self) -> DataFrame:
        """The stored genre rollup beside the serving titles."""
        return read_serving(self.spark, self._serving_table("titles"), ROLLUP_TABLE)

    def stored(self) -> dict[tuple[str, str], tuple[DataFrame, int, int]]:
        """Every lake dataset and serving table with its bytes and files."""
        out = {}
        for name in LAKE_DATASETS:
            db = self._serving_table(name)
            for layer, df, path in (("lake", self.lake(name), self.lake_path(name)),
                                    ("serve", self.serve(name), table_location(self.spark, db, name))):
                out[layer, name] = (df, size_bytes(self.spark, path), data_file_count(self.spark, path))
        return out

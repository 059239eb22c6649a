"""Benchmark: the reference's benchmark queries on our layers.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Steps (each timed): build the Parquet lake from the driver tables (clean +
enrich + partitioned write; cold and warm), load the serving tables, build
the rollup, then run every
headline query warm, three times, and keep the median. Each query runs to
completion through the no-op sink (full execution, nothing collected).

Also timed, to compare layers as the reference's README does: Q1 on raw
TSV files (read, cleaned and joined on the fly), on the raw derivation from
the driver tables, on the lake and on the serving table,
and genre statistics directly vs from the stored pre-aggregated rollup.

Prints one JSON line. ``value`` is the sum of the medians of the six
reference benchmark queries (Q1-Q6) on the serving tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from mediamart import specs  # noqa: E402
from mediamart.operators import rollup  # noqa: E402
from mediamart.jobs import lake_frame  # noqa: E402
from mediamart.plans import marts  # noqa: E402
from mediamart.plans.workbench import Workbench  # noqa: E402
from mediamart.session import build_session, clear_scratch, scratch_path  # noqa: E402
from mediamart.sources.tsv import write_tsv  # noqa: E402

RUNS = 3


def _sf_value(sf_dir: str):
    tag = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(tag)
    except ValueError:
        return tag


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_time(make_df) -> float:
    run(make_df())                      # warm-up: plan caches, file listing
    return statistics.median(timed(lambda: run(make_df())) for _ in range(RUNS))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="mediamart-bench", extra={"spark.driver.memory": "16g"})
    w = Workbench(spark, sf_dir)
    q: dict[str, float] = {}

    # The first job of a fresh JVM also pays for class loading and JIT; the
    # ETL is timed cold (first run) and warm (second run into a new lake).
    q["etl_lake_cold"] = timed(lambda: w.write_lake())
    q["etl_lake"] = timed(lambda: w.write_lake(adopt=True))
    q["serve_load"] = timed(lambda: w.load_serving(adopt=True))

    titles, people = w.serve("titles"), w.serve("people")
    principals, akas = w.serve("principals"), w.serve("akas")
    raw_dir = scratch_path(spark, "raw")
    for name in ("basics", "ratings"):
        write_tsv(w.raw(name), f"{raw_dir}/{specs.SOURCES[name].file_stem}")
    rollup_path = scratch_path(spark, "rollup")
    q["rollup_build"] = timed(lambda: rollup.build_rollup(titles).write.parquet(rollup_path))
    headline = {
        "q1_rating_by_decade": lambda: marts.rating_by_decade(titles),
        "q2_top_genres": lambda: marts.top_genres(titles, 100),
        "q3_credited_actors": lambda: marts.most_credited(principals, people, "actor", "title_count"),
        "q4_rating_trend": lambda: marts.rating_trend(titles),
        "q5_alt_titles_per_region": lambda: marts.alt_titles_per_region(akas),
        "q6_credited_directors": lambda: marts.most_credited(principals, people, "director", "film_count"),
    }
    extra = {
        "v1_top_titles": lambda: marts.top_titles(titles, "movie", 200),
        "v2_role_filmography": lambda: marts.role_filmography(principals, titles, people, "director"),
        "q3_credited_semi_sql": lambda: marts.most_credited_sql(spark, principals, people, "actor"),
        "q1_on_raw_tsv": lambda: marts.rating_by_decade(lake_frame(spark, raw_dir, "titles")),
        "q1_on_raw": lambda: marts.rating_by_decade(w.titles()),
        "q1_on_lake": lambda: marts.rating_by_decade(w.lake("titles")),
        "genre_stats_direct": lambda: titles.groupBy("primaryGenre").agg(
            F.round(F.avg("averageRating"), 2).alias("avg_rating"), F.sum("numVotes").alias("total_votes"),
            F.count(F.lit(1)).alias("title_count")),
        "genre_stats_from_rollup": lambda: rollup.coarsen(spark.read.parquet(rollup_path), ["primaryGenre"]),
    }
    for name, make in {**headline, **extra}.items():
        q[name] = median_time(make)

    total = sum(q[n] for n in headline)
    print(json.dumps({
        "metric": "reference_benchmark_queries_total_median",
        "value": round(total, 4),
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in q.items()},
        "sf": _sf_value(sf_dir),
        "cpus": cpus,
        "runs": RUNS,
    }))
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()

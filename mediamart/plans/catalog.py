"""Registered queries: name -> Spark DataFrame builder and DuckDB oracle.

Every builder takes ``(spark, sf_dir)``, reads the driver's tables (or layers
Spark derived from them) in full, and returns a DataFrame. The oracle is an
independent SQL statement over the same driver tables (``plans.oracle``), or
``None`` where the result is engine-specific (file counts, sizes).

Analog thresholds: the driver's data has ~100 votes per title where the
reference's has thousands, so vote thresholds are scaled (10000 -> 100,
25000 -> 200); everything else is the reference's query as written, with the
group key added as the tie-break of every top-k.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediamart import functions as mf
from mediamart import specs
from mediamart.operators import checks, rollup
from mediamart.operators.clean import clean, derive
from mediamart.plans import marts
from mediamart.plans.analogs import read_table
from mediamart.plans.oracle import _int, with_ctes
from mediamart.plans.workbench import LAKE_DATASETS, Workbench
from mediamart.session import apply_conf, scratch_slot
from mediamart.sinks.lake import overwrite_slice, read_lake, read_lake_own_columns, write_lake
from mediamart.sinks.serve import ROLLUP_TABLE, STATS_TABLE, load_serving, read_serving, require_tables, serve_projection
from mediamart.sinks.split import join_split, write_split
from mediamart.sources.tsv import read_tsv, write_tsv

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    oracle: str | None
    about: str


REGISTRY: dict[str, Query] = {}

SPLIT_BUCKETS = 16     # of the bucketed copies in role_filmography_split


def register(name: str, oracle: str | None, about: str):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, oracle, about)
        return fn
    return deco


def wb(spark: SparkSession, sf_dir: str) -> Workbench:
    return Workbench.get(spark, sf_dir)


MIN_VOTES_GENRES = 100     # reference: 10000
MIN_VOTES_TOP = 200        # reference: 25000

# ---------------------------------------------------------------- oracle SQL
# CTE names ending in _s are the serving form of a table (plans.oracle).


def _top_credited_sql(role: str, count_name: str, table: str = "principals_s", people: str = "people_s") -> str:
    return with_ctes(f"""
        SELECT a.nconst, p.primaryName, a.{count_name}
        FROM (SELECT nconst, count(*) AS {count_name} FROM {table} WHERE category = '{role}'
              GROUP BY nconst ORDER BY {count_name} DESC, nconst LIMIT 20) a
        LEFT JOIN {people} p ON p.nconst = a.nconst
        ORDER BY a.{count_name} DESC, a.nconst""", "principals_s", "people_s")


def _counts_sql(pairs: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{tag}' AS tbl, count(*) AS row_count FROM {t}" for tag, t in pairs)


# ============================================================ Q1-Q6, V1, V2
@register("rating_by_decade", with_ctes("""
    SELECT decade, round(avg(averageRating), 2) AS avg_rating, count(*) AS total_movies
    FROM titles_s WHERE titleType = 'movie' AND decade IS NOT NULL GROUP BY decade ORDER BY decade""",
    "titles_s"), "Q1 (F6/A1/O1) average rating and count by decade for one kind, on the serving table")
def q_rating_by_decade(spark, sf_dir):
    return marts.rating_by_decade(wb(spark, sf_dir).serve("titles"))


@register("top_genres", with_ctes(f"""
    SELECT primaryGenre, round(avg(averageRating), 2) AS avg_rating,
           CAST(sum(numVotes) AS BIGINT) AS total_votes, count(*) AS title_count
    FROM titles_s WHERE numVotes >= {MIN_VOTES_GENRES} AND primaryGenre <> ''
    GROUP BY primaryGenre ORDER BY avg_rating DESC, primaryGenre LIMIT 20""", "titles_s"),
    "Q2 (F5/F7/A2/O2) top genres by average rating above a vote threshold")
def q_top_genres(spark, sf_dir):
    return marts.top_genres(wb(spark, sf_dir).serve("titles"), MIN_VOTES_GENRES)


@register("credited_actors", _top_credited_sql("actor", "title_count"),
          "Q3 (A4/O2/O4) most-credited actors: aggregate, top 20, then name lookup")
def q_credited_actors(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.most_credited(w.serve("principals"), w.serve("people"), "actor", "title_count")


@register("credited_directors", _top_credited_sql("director", "film_count"),
          "Q6 (A4/O2/O4) most-credited directors with names")
def q_credited_directors(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.most_credited(w.serve("principals"), w.serve("people"), "director", "film_count")


@register("credited_semi", _top_credited_sql("actor", "title_count"),
          "Q3/F9 as SQL with a derived table and a nested IN-subquery (semi join)")
def q_credited_semi(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.most_credited_sql(spark, w.serve("principals"), w.serve("people"), "actor", "title_count")


@register("rating_trend", with_ctes("""
    SELECT decade, count(*) AS movies_released, round(avg(averageRating), 2) AS avg_rating,
           round(avg(numVotes), 0) AS avg_votes
    FROM titles_s WHERE titleType = 'movie' AND decade BETWEEN 1950 AND 2020
    GROUP BY decade ORDER BY decade""", "titles_s"), "Q4 (A3/O1) rating trend by decade")
def q_rating_trend(spark, sf_dir):
    return marts.rating_trend(wb(spark, sf_dir).serve("titles"))


@register("alt_titles_per_region", with_ctes("""
    SELECT region, count(*) AS aka_count FROM akas_s GROUP BY region
    ORDER BY aka_count DESC, region LIMIT 10""", "akas_s"), "Q5 (A4/O2) alternate titles per region, top 10")
def q_alt_titles_per_region(spark, sf_dir):
    return marts.alt_titles_per_region(wb(spark, sf_dir).serve("akas"))


@register("top_titles", with_ctes(f"""
    SELECT tconst, primaryTitle, startYear, primaryGenre, averageRating, numVotes, decade
    FROM titles_s WHERE titleType = 'movie' AND numVotes >= {MIN_VOTES_TOP} AND averageRating IS NOT NULL
    ORDER BY averageRating DESC, numVotes DESC""", "titles_s"), "V1 (F5/F6/O3) view of top rated titles of a kind")
def q_top_titles(spark, sf_dir):
    return marts.top_titles(wb(spark, sf_dir).serve("titles"), "movie", MIN_VOTES_TOP)


@register("role_filmography", with_ctes("""
    SELECT p.nconst, p.primaryName, t.tconst, t.primaryTitle, t.startYear, t.primaryGenre,
           t.averageRating, t.numVotes
    FROM principals_s pr JOIN titles_s t ON t.tconst = pr.tconst JOIN people_s p ON p.nconst = pr.nconst
    WHERE pr.category = 'director'""", "principals_s", "titles_s", "people_s"),
    "V2 filmography view: credits of one role joined to titles and people")
def q_role_filmography(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.role_filmography(w.serve("principals"), w.serve("titles"), w.serve("people"), "director")


# ===================================================== cleaners
@register("clean_titles", with_ctes("SELECT * FROM basics", "basics"), "T1/P13 clean titles (basics)")
def q_clean_titles(spark, sf_dir):
    return wb(spark, sf_dir).clean("basics")


@register("clean_ratings", with_ctes("SELECT * FROM ratings", "ratings"), "T2 clean ratings")
def q_clean_ratings(spark, sf_dir):
    return wb(spark, sf_dir).clean("ratings")


@register("titles_mart", with_ctes("SELECT * FROM titles", "titles"),
          "T3/J1 titles LEFT JOIN ratings, 13 columns")
def q_titles_mart(spark, sf_dir):
    return wb(spark, sf_dir).titles()


@register("clean_people", with_ctes("SELECT * FROM people", "people"), "T4 clean people, NULL key dropped")
def q_clean_people(spark, sf_dir):
    return wb(spark, sf_dir).clean("people")


@register("clean_credits", with_ctes("SELECT * FROM principals", "principals"),
          "T5 clean credits, rows with a NULL key dropped")
def q_clean_credits(spark, sf_dir):
    return wb(spark, sf_dir).clean("principals")


@register("clean_alt_titles", with_ctes("SELECT * FROM akas", "akas"), "T6 clean alternate titles")
def q_clean_alt_titles(spark, sf_dir):
    return wb(spark, sf_dir).clean("akas")


# ========================================== single projections
@register("cast_columns", f"""
    SELECT p_partkey, {_int('p_brand')} AS brand_as_int,
           {_int("string_split(p_brand, '#')[2]")} AS brand_number,
           {_int('CAST(p_size AS VARCHAR)')} AS size_int,
           {_int('CAST(p_retailprice AS VARCHAR)')} AS price_as_int,
           TRY_CAST(CAST(p_retailprice AS VARCHAR) AS FLOAT) AS price_float
    FROM part""", "P1/P2 text to int/float, malformed and fractional text to NULL")
def q_cast_columns(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        mf.to_int("p_brand").alias("brand_as_int"),
        mf.to_int(F.get(mf.split_list("p_brand", "#"), 1)).alias("brand_number"),
        mf.to_int(F.col("p_size").cast("string")).alias("size_int"),
        mf.to_int(F.col("p_retailprice").cast("string")).alias("price_as_int"),
        mf.to_float(F.col("p_retailprice").cast("string")).alias("price_float"))


@register("fill_blank", with_ctes("""
    SELECT tconst, titleType AS raw_titleType,
           CASE WHEN titleType IS NULL OR trim(titleType) = '' THEN 'unknown' ELSE titleType END AS titleType
    FROM basics_raw""", "basics_raw"), "P3/F10 NULL or blank-after-trim to a default")
def q_fill_blank(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("basics")
    return raw.select("tconst", F.col("titleType").alias("raw_titleType"),
                      mf.blank_to("titleType", specs.UNKNOWN).alias("titleType"))


@register("fill_null", with_ctes("""
    SELECT tconst, nconst, category AS raw_category, coalesce(category, 'unknown') AS category
    FROM principals_raw""", "principals_raw"), "P4 NULL-only to a default")
def q_fill_null(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("principals")
    return raw.select("tconst", "nconst", F.col("category").alias("raw_category"),
                      mf.null_to("category", specs.UNKNOWN).alias("category"))


@register("fill_empty", with_ctes("""
    SELECT titleId, region AS raw_region, coalesce(nullif(region, ''), 'XX') AS region,
           language AS raw_language, coalesce(nullif(language, ''), '') AS language
    FROM akas_raw""", "akas_raw"), "P5/F10 NULL or exactly empty to a default, no trim")
def q_fill_empty(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("akas")
    return raw.select("titleId", F.col("region").alias("raw_region"),
                      mf.empty_to("region", specs.NO_REGION).alias("region"),
                      F.col("language").alias("raw_language"),
                      mf.empty_to("language", "").alias("language"))


@register("split_array", with_ctes("""
    SELECT tconst, genres AS raw_genres, string_split(genres, ',') AS genres FROM basics_raw""",
    "basics_raw"), "P6 delimited text to array; NULL stays NULL")
def q_split_array(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("basics")
    return raw.select("tconst", F.col("genres").alias("raw_genres"),
                      mf.split_list("genres", specs.LIST_SEP).alias("genres"))


@register("split_array_default", with_ctes("""
    SELECT titleId, string_split(coalesce(types, ''), ',') AS types,
           string_split(coalesce(attributes, ''), ',') AS attributes FROM akas_raw""", "akas_raw"),
    "P7 NULL to '' then split: NULL gives ['']")
def q_split_array_default(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("akas")
    return derive(raw, specs.AKAS, ["types", "attributes"], keep=["titleId"])


@register("first_element", with_ctes("""
    SELECT tconst, nullif(string_split(genres, ',')[1], '') AS primaryGenre FROM basics_raw""",
    "basics_raw"), "P8 first element unless missing or empty")
def q_first_element(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("basics")
    return derive(raw, specs.BASICS, ["primaryGenre"], keep=["tconst"])


@register("first_element_default", with_ctes("""
    SELECT nconst, coalesce(nullif(string_split(primaryProfession, ',')[1], ''), 'unknown')
           AS primaryProfession0 FROM people_raw""", "people_raw"), "P9 first element or 'unknown'")
def q_first_element_default(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("people")
    return derive(raw, specs.PEOPLE, ["primaryProfession0"], keep=["nconst"])


@register("decade_bucket", with_ctes(f"""
    SELECT tconst, {_int('startYear')} AS startYear,
           CAST(trunc({_int('startYear')} / 10) AS INTEGER) * 10 AS decade FROM basics_raw""",
    "basics_raw"), "P9b year to decade, NULL stays NULL")
def q_decade_bucket(spark, sf_dir):
    raw = wb(spark, sf_dir).raw("basics")
    return derive(raw, specs.BASICS, ["startYear", "decade"], keep=["tconst"])


# ================================================================ lake
@register("lake_roundtrip_titles", with_ctes("SELECT * FROM titles", "titles"),
          "K1/S5/S6 titles written partitioned by titleType/decade and read back")
def q_lake_roundtrip_titles(spark, sf_dir):
    return wb(spark, sf_dir).lake("titles")


@register("lake_roundtrip_people", with_ctes("SELECT * FROM people", "people"),
          "K1 people partitioned by first profession, read back")
def q_lake_roundtrip_people(spark, sf_dir):
    return wb(spark, sf_dir).lake("people")


@register("lake_roundtrip_credits", with_ctes("SELECT * FROM principals", "principals"),
          "K1 credits partitioned by category, read back")
def q_lake_roundtrip_credits(spark, sf_dir):
    return wb(spark, sf_dir).lake("principals")


@register("lake_roundtrip_alt_titles", with_ctes("SELECT * FROM akas", "akas"),
          "K1 alternate titles partitioned by region, read back")
def q_lake_roundtrip_alt_titles(spark, sf_dir):
    return wb(spark, sf_dir).lake("akas")


@register("lake_rebuild", with_ctes(_counts_sql(
    [("titles", "titles"), ("people", "people"), ("principals", "principals"), ("akas", "akas")]),
    "titles", "people", "principals", "akas"),
    "K2/K4 full rebuild of all datasets into a fresh lake, counted on read-back")
def q_lake_rebuild(spark, sf_dir):
    w = wb(spark, sf_dir)
    root = w.write_lake(scratch_slot(spark, "lake_rebuild"))
    tables = {n: read_lake(spark, f"{root}/{n}", specs.LAKE[n]) for n in LAKE_DATASETS}
    return checks.tagged_counts(tables).withColumnRenamed("rows", "row_count")


@register("lake_slice_overwrite", with_ctes("SELECT * FROM titles", "titles"),
          "K3 one titleType slice rewritten twice: idempotent, other slices untouched")
def q_lake_slice_overwrite(spark, sf_dir):
    w = wb(spark, sf_dir)
    path = scratch_slot(spark, "slice") + "/titles"
    titles = w.titles()
    write_lake(titles, path, specs.TITLES.partition_by)
    for _ in range(2):
        overwrite_slice(titles, path, "titleType", "movie", ("decade",))
    return read_lake(spark, path, specs.TITLES)


@register("lake_escaped_partition", """
    SELECT concat(o_orderpriority, '/a=b%c ', o_orderstatus) AS code, count(*) AS row_count, max(o_orderkey) AS last_order
    FROM orders GROUP BY 1""", "S6 partition values with characters that directory names escape, read back")
def q_lake_escaped_partition(spark, sf_dir):
    path = scratch_slot(spark, "escaped") + "/orders"
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat("o_orderpriority", F.lit("/a=b%c "), "o_orderstatus").alias("code"))
    write_lake(orders, path, ("code",))
    back = spark.read.schema("o_orderkey long, code string").option("basePath", path).parquet(path)
    return back.groupBy("code").agg(F.count(F.lit(1)).alias("row_count"), F.max("o_orderkey").alias("last_order"))


@register("lake_scan", with_ctes("SELECT * FROM principals", "principals"),
          "S5 discover and read a lake dataset with its declared schema")
def q_lake_scan(spark, sf_dir):
    return read_lake(spark, wb(spark, sf_dir).lake_path("principals"), specs.PRINCIPALS)


@register("lake_partition_columns", with_ctes("""
    SELECT titleType, decade, count(*) AS row_count FROM titles GROUP BY titleType, decade""", "titles"),
    "S6 partition values recovered from directory names (NULL decade included)")
def q_lake_partition_columns(spark, sf_dir):
    return (wb(spark, sf_dir).lake("titles").groupBy("titleType", "decade")
            .agg(F.count(F.lit(1)).alias("row_count")))


@register("prune_equality", with_ctes("""
    SELECT tconst, decade, averageRating, numVotes FROM titles WHERE titleType = 'movie'""", "titles"),
    "F3 equality on a partition column (PartitionFilters)")
def q_prune_equality(spark, sf_dir):
    return marts.of_kind(wb(spark, sf_dir).lake("titles"), "movie")


@register("prune_two_axis", with_ctes("""
    SELECT tconst, startYear, averageRating, numVotes FROM titles
    WHERE titleType = 'movie' AND decade = 1990""", "titles"),
    "F4 equality on both partition columns")
def q_prune_two_axis(spark, sf_dir):
    return marts.of_kind_and_decade(wb(spark, sf_dir).lake("titles"), "movie", 1990)


@register("range_scan", with_ctes("""
    SELECT tconst, titleType, startYear, averageRating FROM titles_s
    WHERE startYear BETWEEN 1990 AND 1999""", "titles_s"),
    "F8 range on the sort key of the serving table")
def q_range_scan(spark, sf_dir):
    return marts.year_range(wb(spark, sf_dir).serve("titles"), 1990, 1999)


# ============================================================== serving
def _range_sql() -> str:
    parts = []
    for name, spec in specs.LAKE.items():
        for c in spec.serve:
            if c.unsigned:
                hi = mf.columns.UNSIGNED_MAX[c.unsigned]
                parts.append(
                    f"SELECT '{name}' AS tbl, '{c.name}' AS column_name, CAST(coalesce(sum(CASE WHEN {c.name} "
                    f"IS NOT NULL AND ({c.name} < 0 OR {c.name} > {hi}) THEN 1 ELSE 0 END), 0) AS BIGINT) "
                    f"AS out_of_range FROM {name}")
    return " UNION ALL ".join(parts)


@register("serve_narrow", with_ctes(_range_sql(), "titles", "people", "principals", "akas"),
          "P10/D2 values outside each column's unsigned serving range, counted not wrapped")
def q_serve_narrow(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([checks.range_violations(w.lake(n), s) for n, s in specs.LAKE.items()])


@register("serve_fill", with_ctes("SELECT * FROM titles_s", "titles_s"),
          "P11 serving projection of titles: NULLs filled in non-nullable columns")
def q_serve_fill(spark, sf_dir):
    return serve_projection(wb(spark, sf_dir).lake("titles"), specs.TITLES)


@register("serve_project", with_ctes("SELECT * FROM people_s", "people_s"),
          "P12 serving column list and order (people drops its partition helper)")
def q_serve_project(spark, sf_dir):
    return serve_projection(wb(spark, sf_dir).lake("people"), specs.PEOPLE)


@register("serve_load", with_ctes("SELECT * FROM titles_s", "titles_s"),
          "K5/C2 titles serving table loaded from the lake (projected, range-partitioned, sorted), read back")
def q_serve_load(spark, sf_dir):
    return wb(spark, sf_dir).serve("titles")


@register("serve_reload_idempotent", with_ctes(_counts_sql(
    [("titles", "titles"), ("people", "people"), ("principals", "principals"), ("akas", "akas")]),
    "titles", "people", "principals", "akas"),
    "K6 loading twice with overwrite leaves one copy")
def q_serve_reload_idempotent(spark, sf_dir):
    w = wb(spark, sf_dir)
    db = "mm_twice_" + uuid.uuid4().hex[:10]
    root = scratch_slot(spark, "serve_twice", db)
    w.load_serving(db=db, root=root)
    w.load_serving(db=db, root=root)
    tables = {n: spark.table(f"`{db}`.`{n}`") for n in LAKE_DATASETS}
    return checks.tagged_counts(tables).withColumnRenamed("rows", "row_count")


def _violations(name: str) -> str:
    return " + ".join(f"(CASE WHEN {c.name} IS NOT NULL AND ({c.name} < 0 OR {c.name} > "
                      f"{mf.columns.UNSIGNED_MAX[c.unsigned]}) THEN 1 ELSE 0 END)" for c in specs.LAKE[name].serve if c.unsigned)


@register("serve_load_stats", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS row_count, CAST(coalesce(sum({_violations(n)}), 0) AS BIGINT) AS out_of_range, "
    f"CAST(0 AS BIGINT) AS files_missed, TRUE AS took_time FROM {n}" for n in LAKE_DATASETS), *LAKE_DATASETS),
    "K8 the stored load statistics: rows and range violations, files that the load counted against those the lake has, time")
def q_serve_load_stats(spark, sf_dir):
    w = wb(spark, sf_dir)
    db, _, _ = w.serving()
    lake_files = checks._union([w.lake(n).select(F.lit(n).alias("dataset"), F.col("_metadata.file_path").alias("file")) for n in LAKE_DATASETS])
    lake_files = lake_files.groupBy("dataset", "file").agg(F.count(F.lit(1))).groupBy("dataset").agg(F.count(F.lit(1)).alias("lake_files"))
    return spark.table(f"`{db}`.`{STATS_TABLE}`").join(lake_files, "dataset").select(
        "dataset", F.col("rows").alias("row_count"), "out_of_range", (F.col("lake_files") - F.col("files")).alias("files_missed"),
        (F.col("elapsed_s") > 0).alias("took_time"))


@register("serve_only", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS tbl, {n == 'people'} AS present, {n != 'people'} AS named_missing, "
    + (f"count(*) AS row_count FROM {n}" if n == "people" else "CAST(0 AS BIGINT) AS row_count") for n in LAKE_DATASETS), "people"),
    "K7/C2 only the chosen dataset is loaded; the check names every table that is not there")
def q_serve_only(spark, sf_dir):
    w = wb(spark, sf_dir)
    db = "mm_only_" + uuid.uuid4().hex[:10]
    root = scratch_slot(spark, "serve_only", db)
    load_serving(spark, {"people": w.lake("people")}, specs.LAKE, db, root, ["people"])
    try:
        require_tables(spark, db, list(LAKE_DATASETS))
        said = ""
    except RuntimeError as e:
        said = str(e)
    frames = []
    for n in LAKE_DATASETS:
        present = spark.catalog.tableExists(f"{db}.{n}")
        rows = spark.table(f"`{db}`.`{n}`") if present else w.lake(n).limit(0)
        frames.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("tbl"), F.lit(present).alias("present"), F.lit(f"'{n}'" in said).alias("named_missing"), "row_count"))
    return checks._union(frames)


def _sorted_by(name: str) -> list[str]:
    return [c for c in specs.LAKE[name].sort_by if c not in specs.LAKE[name].serve_partition_by]


@register("serve_sorted", with_ctes(" UNION ALL ".join(
    f"SELECT '{n}' AS tbl, count(*) AS row_count, CAST(0 AS BIGINT) AS unsorted_pairs FROM {n}_s" for n in LAKE_DATASETS),
    *(f"{n}_s" for n in LAKE_DATASETS)),
    "O6 rows inside every serving file are in sort-key order, all four tables")
def q_serve_sorted(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([checks.unsorted_pairs(w.serve(n), _sorted_by(n), []).select(
        F.lit(n).alias("tbl"), "row_count", "unsorted_pairs") for n in LAKE_DATASETS])


@register("verify_counts", with_ctes(_counts_sql(
    [("titles", "titles_s"), ("people", "people_s"), ("principals", "principals_s"), ("akas", "akas_s")]),
    "titles_s", "people_s", "principals_s", "akas_s"),
    "C1/U1/P15 tagged row counts of all serving tables, UNION ALL")
def q_verify_counts(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks.tagged_counts({n: w.serve(n) for n in LAKE_DATASETS}).withColumnRenamed("rows", "row_count")


# ========================================================== aggregates
@register("genre_rollup", with_ctes("""
    SELECT primaryGenre, titleType, decade, round(sum(CAST(averageRating AS DOUBLE)), 4) AS rating_sum,
           count(averageRating) AS rated, CAST(sum(numVotes) AS BIGINT) AS total_votes, count(*) AS cnt,
           round(avg(averageRating), 2) AS avg_rating
    FROM titles_s GROUP BY primaryGenre, titleType, decade""", "titles_s"),
    "A6 mergeable pre-aggregate by genre, kind and decade, stored beside the serving titles")
def q_genre_rollup(spark, sf_dir):
    r = rollup.with_avg(wb(spark, sf_dir).rollup())
    return r.withColumn("rating_sum", F.round("rating_sum", 4))


@register("genre_rollup_coarse", with_ctes("""
    SELECT primaryGenre, round(avg(averageRating), 2) AS avg_rating,
           CAST(sum(numVotes) AS BIGINT) AS total_votes, count(*) AS title_count
    FROM titles_s GROUP BY primaryGenre""", "titles_s"),
    "A6 coarser grouping re-aggregated from the rollup equals the direct aggregate")
def q_genre_rollup_coarse(spark, sf_dir):
    return rollup.coarsen(wb(spark, sf_dir).rollup(), ["primaryGenre"])


@register("genre_rollup_appended", with_ctes("""
    SELECT primaryGenre, titleType, decade, round(sum(CAST(averageRating AS DOUBLE)), 4) AS rating_sum,
           count(averageRating) AS rated, CAST(sum(numVotes) AS BIGINT) AS total_votes, count(*) AS cnt
    FROM titles_s GROUP BY primaryGenre, titleType, decade""", "titles_s"),
    "A6 upkeep of the stored rollup: one load and two appends, each merged from the appended rows alone")
def q_genre_rollup_appended(spark, sf_dir):
    w = wb(spark, sf_dir)
    db = "mm_grow_" + uuid.uuid4().hex[:10]
    root = scratch_slot(spark, "rollup_appended", db)
    for i in range(3):
        part = w.lake("titles").where(F.crc32(F.coalesce("tconst", F.lit("")).cast("binary")) % 3 == i)
        load_serving(spark, {"titles": part}, specs.LAKE, db, root, mode="append")
    return read_serving(spark, db, ROLLUP_TABLE).withColumn("rating_sum", F.round("rating_sum", 4))


@register("serving_decade_key", with_ctes("""
    SELECT titleType, CAST(trunc(coalesce(startYear, 0) / 10.0) AS INTEGER) AS decade_key, count(*) AS titles
    FROM titles_s GROUP BY ALL""", "titles_s"), "fn intDiv: titles per kind and integer-divided year (NULL as 0)")
def q_serving_decade_key(spark, sf_dir):
    key = mf.int_div(F.coalesce("startYear", F.lit(0)), 10)
    return wb(spark, sf_dir).serve("titles").groupBy("titleType", key.alias("decade_key")).agg(F.count(F.lit(1)).alias("titles"))


@register("distinct_types", with_ctes("SELECT DISTINCT titleType FROM titles ORDER BY titleType", "titles"),
          "A7/O5 ordered distinct kinds")
def q_distinct_types(spark, sf_dir):
    return wb(spark, sf_dir).titles().select("titleType").distinct().orderBy("titleType")


@register("storage_report", with_ctes(" UNION ALL ".join(
    f"SELECT '{layer}' AS layer, '{n}' AS tbl, count(*) AS row_count, CAST(0 AS BIGINT) AS bytes_off, CAST(0 AS BIGINT) AS files_off, "
    f"TRUE AS size_shown FROM {n}" for n in LAKE_DATASETS for layer in ("lake", "serve")), *LAKE_DATASETS),
    "A8 rows, bytes and files per lake dataset and serving table, against the sizes that the rows' own files give")
def q_storage_report(spark, sf_dir):
    stored = wb(spark, sf_dir).stored()
    # the first row of every file stands for it, so only those are grouped
    files = checks._union([df.where(F.col("_metadata.row_index") == 0).select(
        F.lit(layer).alias("layer"), F.lit(n).alias("tbl"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size")) for (layer, n), (df, _, _) in stored.items()])
    files = files.groupBy("layer", "tbl", "file").agg(F.max("size").alias("size")).groupBy("layer", "tbl").agg(
        F.sum("size").alias("real_bytes"), F.count(F.lit(1)).alias("real_files"))
    return checks.storage_report(stored).join(files, ["layer", "tbl"]).select(
        "layer", "tbl", F.col("rows").alias("row_count"), (F.col("bytes") - F.col("real_bytes")).alias("bytes_off"),
        (F.col("files") - F.col("real_files")).alias("files_off"),
        (F.col("disk_size") == mf.readable_size("real_bytes")).alias("size_shown"))


_BYTES = "o_orderkey * CAST(CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 977 WHEN 2 THEN 1048583 WHEN 3 THEN 1073741827 ELSE 10000000019 END AS BIGINT)"


def _size_sql() -> str:
    steps = "".join(f"WHEN b < {1024 ** (i + 1)} THEN {1024 ** i} " for i in range(5))
    units = "".join(f"WHEN {1024 ** i} THEN '{u}' " for i, u in enumerate(["B", "KiB", "MiB", "GiB", "TiB"]))
    return f"""
    SELECT o_orderkey, hundredths // 100 || '.' || lpad((hundredths % 100)::VARCHAR, 2, '0') || ' ' || CASE u {units} ELSE 'PiB' END AS shown FROM (
      SELECT o_orderkey, u, (b::HUGEINT * 200 + u) // (2 * u) AS hundredths FROM (
        SELECT o_orderkey, b, (CASE {steps} ELSE {1024 ** 5} END)::HUGEINT AS u FROM (SELECT o_orderkey, {_BYTES} AS b FROM orders)))"""


@register("readable_sizes", _size_sql(), "fn readable byte sizes from bytes to tebibytes, half up at the second decimal")
def q_readable_sizes(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select("o_orderkey", mf.readable_size(F.expr(_BYTES)).alias("shown"))


# ============================================================== checks
def _loss_sql() -> str:
    def one(name, key_cond):
        return (f"SELECT '{name}' AS dataset, count(*) AS rows_in, "
                f"count(*) FILTER (WHERE {key_cond}) AS rows_out, "
                f"count(*) FILTER (WHERE NOT ({key_cond})) AS null_key_rows FROM {name}_raw")
    return " UNION ALL ".join([
        one("basics", "TRUE"), one("ratings", "TRUE"), one("people", "nconst IS NOT NULL"),
        one("principals", "tconst IS NOT NULL AND nconst IS NOT NULL"), one("akas", "titleId IS NOT NULL")])


@register("no_row_loss", with_ctes(_loss_sql(), "basics_raw", "ratings_raw", "people_raw",
                                   "principals_raw", "akas_raw"),
          "C4 rows in = rows out + rows with a NULL key, per source")
def q_no_row_loss(spark, sf_dir):
    w = wb(spark, sf_dir)
    frames = []
    for name in ("basics", "ratings", "people", "principals", "akas"):
        raw = w.raw(name)
        frames.append(checks.row_loss(raw, clean(raw, specs.SOURCES[name]), specs.SOURCES[name]))
    return checks._union(frames)


def _malformed_sql() -> str:
    parts = []
    for name, spec in specs.SOURCES.items():
        for d in spec.columns:
            if d.name in spec.raw and d.dtype.typeName() in ("integer", "float"):
                typed = _int(d.name) if d.dtype.typeName() == "integer" else f"TRY_CAST({d.name} AS FLOAT)"
                parts.append(f"SELECT '{name}' AS dataset, '{d.name}' AS column_name, "
                             f"CAST(coalesce(sum(CASE WHEN {d.name} IS NOT NULL AND {typed} IS NULL "
                             f"THEN 1 ELSE 0 END), 0) AS BIGINT) AS malformed FROM {name}_raw")
    return " UNION ALL ".join(parts)


@register("malformed_values", with_ctes(_malformed_sql(), "basics_raw", "ratings_raw", "people_raw",
                                        "principals_raw", "akas_raw"),
          "C5 non-NULL text that did not parse as a number, per column")
def q_malformed_values(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([checks.malformed_values(w.raw(n), s) for n, s in specs.SOURCES.items()])


def _reconcile_sql() -> str:
    parts = []
    for name, spec in specs.LAKE.items():
        ranges = " + ".join(
            f"(CASE WHEN {c.name} IS NOT NULL AND ({c.name} < 0 OR {c.name} > "
            f"{mf.columns.UNSIGNED_MAX[c.unsigned]}) THEN 1 ELSE 0 END)" for c in spec.serve if c.unsigned)
        key = ", ".join(spec.unique_key)
        parts.append(f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {name}) AS lake_rows,
            (SELECT count(*) FROM {name}) AS serve_rows, TRUE AS counts_match,
            (SELECT CAST(coalesce(sum({ranges}), 0) AS BIGINT) FROM {name}) AS out_of_range,
            (SELECT count(*) FROM (SELECT {key} FROM {name} GROUP BY {key} HAVING count(*) > 1)) AS duplicate_keys""")
    return " UNION ALL ".join(parts)


@register("reconcile_counts", with_ctes(_reconcile_sql(), "titles", "people", "principals", "akas"),
          "C5 lake vs serving counts, range violations and duplicate keys per table")
def q_reconcile_counts(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([checks.reconcile(w.lake(n), w.serve(n), specs.LAKE[n]) for n in LAKE_DATASETS])


def _content_sql(altered: str | None = None) -> str:
    def one(name):
        parts = specs.LAKE[name].serve_partition_by
        shown = [f"CAST({p} AS VARCHAR)" for p in parts] + ["CAST(NULL AS VARCHAR)"] * (2 - len(parts))
        same = "TRUE" if altered is None else f"NOT bool_or({altered})"
        return (f"SELECT '{name}' AS dataset, {shown[0]} AS part1, {shown[1]} AS part2, count(*) AS lake_rows, count(*) AS serve_rows, "
                f"{same} AS same_content FROM {name}_s GROUP BY ALL")
    return " UNION ALL ".join(one(n) for n in (LAKE_DATASETS if altered is None else ("titles",)))


def _parts_shown(df: DataFrame, name: str) -> DataFrame:
    parts = specs.LAKE[name].serve_partition_by
    shown = [F.col(p).cast("string") for p in parts] + [F.lit(None).cast("string")] * (2 - len(parts))
    return df.select("dataset", shown[0].alias("part1"), shown[1].alias("part2"), "lake_rows", "serve_rows", "same_content")


@register("content_reconciled", with_ctes(_content_sql(), *(f"{n}_s" for n in LAKE_DATASETS)),
          "C5 lake and serving hold the same rows, by an order-free hash of each partition's rows")
def q_content_reconciled(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([_parts_shown(checks.content_match(w.lake(n), w.serve(n), specs.LAKE[n]), n) for n in LAKE_DATASETS])


@register("content_altered", with_ctes(_content_sql("tconst = (SELECT max(tconst) FROM titles_s)"), "titles_s"),
          "C5 one altered title with equal counts: only its partition no longer matches")
def q_content_altered(spark, sf_dir):
    w = wb(spark, sf_dir)
    serve = w.serve("titles")
    last = serve.agg(F.max("tconst").alias("k"))
    other = serve.join(F.broadcast(last), serve["tconst"] == last["k"], "left").withColumn(
        "primaryTitle", F.when(F.col("k").isNotNull(), F.concat("primaryTitle", F.lit("!"))).otherwise(F.col("primaryTitle")))
    return _parts_shown(checks.content_match(w.lake("titles"), other, specs.TITLES), "titles")


# the raw sources of the four lake datasets, with the datasets' partition columns
_FLOWS = {"titles": replace(specs.BASICS, name="titles", partition_by=specs.TITLES.partition_by), "people": specs.PEOPLE,
          "principals": specs.PRINCIPALS, "akas": specs.AKAS}


def _flow_sql() -> str:
    made = {
        "titles": ("basics_raw", ["CASE WHEN titleType IS NULL OR trim(titleType) = '' THEN 'unknown' ELSE titleType END",
                                  f"CAST(trunc({_int('startYear')} / 10.0) * 10 AS INTEGER)"], "TRUE", "titleType IS NULL OR trim(titleType) = ''"),
        "people": ("people_raw", ["coalesce(nullif(string_split(primaryProfession, ',')[1], ''), 'unknown')"], "nconst IS NOT NULL", "FALSE"),
        "principals": ("principals_raw", ["coalesce(category, 'unknown')"], "tconst IS NOT NULL AND nconst IS NOT NULL",
                       "category IS NULL OR trim(category) = ''"),
        "akas": ("akas_raw", ["coalesce(nullif(region, ''), 'XX')"], "titleId IS NOT NULL", "region IS NULL OR trim(region) = ''")}
    out = []
    for name, (source, parts, kept, filled) in made.items():
        names = [f"k{i + 1}" for i in range(len(parts))]
        rows = f"(SELECT {', '.join(f'{e} AS {k}' for e, k in zip(parts, names))}, ({kept}) AS kept, ({filled}) AS filled FROM {source})"
        sets = ", ".join("(" + ", ".join(names[:i]) + ")" for i in range(len(names), -1, -1))
        level = f"{len(names)} - bit_count(grouping({', '.join(names)}))"
        shown = [f"CAST({k} AS VARCHAR)" for k in names] + ["CAST(NULL AS VARCHAR)"] * (2 - len(names))
        out.append(f"""
    SELECT '{name}' AS dataset, CAST({level} AS INTEGER) AS level, {shown[0]} AS part1, {shown[1]} AS part2, count(*) AS raw_rows,
      count(*) FILTER (NOT kept) AS dropped, count(*) FILTER (kept AND filled) AS defaulted, count(*) FILTER (kept) AS lake_rows, TRUE AS balanced
    FROM {rows} GROUP BY GROUPING SETS ({sets})""")
    return " UNION ALL ".join(out)


@register("partition_flow", with_ctes(_flow_sql(), "basics_raw", "people_raw", "principals_raw", "akas_raw"),
          "C4 rows in, dropped, defaulted and out per partition, per first column and per table (grouping sets), raw against lake")
def q_partition_flow(spark, sf_dir):
    w = wb(spark, sf_dir)
    return checks._union([checks.partition_flow(w.raw("basics" if n == "titles" else n), s, w.lake(n)) for n, s in _FLOWS.items()])


@register("lake_own_columns", with_ctes("SELECT * FROM principals", "principals"),
          "S6 files that hold the partition column themselves: their value wins over the directory's, the rest take the directory's")
def q_lake_own_columns(spark, sf_dir):
    credits = wb(spark, sf_dir).clean("principals")
    path = scratch_slot(spark, "own_columns") + "/principals"
    own = F.crc32(F.col("nconst").cast("binary")) % 2 == 0
    write_lake(credits.where(~own), path, ["category"])
    write_lake(credits.where(own), f"{path}/category=misfiled", [])
    return read_lake_own_columns(spark, path, specs.PRINCIPALS)


@register("zorder_range", with_ctes("""
    SELECT tconst, startYear, numVotes, averageRating FROM titles_s WHERE startYear BETWEEN 1993 AND 1995
    UNION ALL SELECT tconst, startYear, numVotes, averageRating FROM titles_s WHERE numVotes BETWEEN 150 AND 170""", "titles_s"),
    "O6/F8 serving titles in Z-order of year and votes: a range on either column alone")
def q_zorder_range(spark, sf_dir):
    w = wb(spark, sf_dir)
    db = "mm_z_" + uuid.uuid4().hex[:10]
    root = scratch_slot(spark, "zorder", db)
    load_serving(spark, {"titles": w.lake("titles")}, specs.LAKE, db, root, layout="zorder")
    titles = spark.table(f"`{db}`.titles").select("tconst", "startYear", "numVotes", "averageRating")
    return titles.where(F.col("startYear").between(1993, 1995)).unionByName(titles.where(F.col("numVotes").between(150, 170)))


@register("credits_of_person", with_ctes("""
    SELECT tconst, ordering, nconst, category FROM principals_s WHERE nconst = (SELECT max(nconst) FROM people_s)""", "principals_s", "people_s"),
    "O6 key lookup that does not lead the sort: one person's credits, row groups skipped by Bloom filters or dictionaries")
def q_credits_of_person(spark, sf_dir):
    w = wb(spark, sf_dir)
    key = w.serve("people").agg(F.max("nconst")).first()[0]
    return w.serve("principals").where(F.col("nconst") == key).select("tconst", "ordering", "nconst", "category")


# ======================================================= access patterns
@register("people_by_role_year", with_ctes("""
    SELECT nconst, primaryName, birthYear FROM people
    WHERE primaryProfession0 = 'director' AND birthYear > 1970""", "people"),
    "F11 people by first profession (partition) and birth year")
def q_people_by_role_year(spark, sf_dir):
    return marts.people_by_role_year(wb(spark, sf_dir).lake("people"), "director", 1970)


@register("localized_title", with_ctes("""
    SELECT titleId, title AS localized_title, language, variants FROM (
      SELECT titleId, title, language, count(*) OVER (PARTITION BY titleId) AS variants,
             row_number() OVER (PARTITION BY titleId ORDER BY ordering NULLS LAST, title NULLS FIRST, language NULLS FIRST) AS nth
      FROM akas WHERE region = 'SRC2') WHERE nth = 1""", "akas"),
    "F11 localized title of every work in one region (partition-pruned; tied and missing orderings)")
def q_localized_title(spark, sf_dir):
    return marts.localized_title(wb(spark, sf_dir).lake("akas"), "SRC2")


@register("role_of_rated_titles", with_ctes("""
    SELECT pr.tconst, pr.nconst, pr.ordering, t.averageRating
    FROM principals_s pr JOIN titles_s t ON t.tconst = pr.tconst
    WHERE pr.category = 'director' AND t.averageRating > 8.0""", "principals_s", "titles_s"),
    "F11 credits of one role on titles rated above 8")
def q_role_of_rated_titles(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.role_of_rated_titles(w.serve("principals"), w.serve("titles"), "director", 8.0)


@register("top_billed", with_ctes("""
    SELECT pr.tconst, pr.nconst, p.primaryName, pr.category
    FROM principals_s pr LEFT JOIN people_s p ON p.nconst = pr.nconst WHERE pr.ordering = 1""",
    "principals_s", "people_s"), "F11 top-billed credit (ordering 1) of every title with the name")
def q_top_billed(spark, sf_dir):
    w = wb(spark, sf_dir)
    return marts.top_billed(w.serve("principals"), w.serve("people"))


@register("role_filmography_split", with_ctes("""
    SELECT p.nconst, p.primaryName, t.tconst, t.primaryTitle, t.startYear, t.primaryGenre, t.averageRating, t.numVotes
    FROM principals_s pr JOIN titles_s t ON t.tconst = pr.tconst JOIN people_s p ON p.nconst = pr.nconst
    WHERE pr.category = 'director'""", "principals_s", "titles_s", "people_s"),
    "J3 credits stored as a bucketed part and a part of heavy keys: the bridge join without exchange or hot bucket")
def q_role_filmography_split(spark, sf_dir):
    w = wb(spark, sf_dir)
    db = "mm_split_" + uuid.uuid4().hex[:10]
    root = scratch_slot(spark, "split", db)
    load_serving(spark, {"titles": w.lake("titles")}, specs.LAKE, db, root, buckets=SPLIT_BUCKETS)
    write_split(spark, w.lake("principals"), specs.PRINCIPALS, db, root, SPLIT_BUCKETS)
    titles = read_serving(spark, db, "titles").select("tconst", "primaryTitle", "startYear", "primaryGenre", "averageRating", "numVotes")
    credits = join_split(spark, db, "principals", titles, "tconst", F.col("category") == "director")
    return credits.join(w.serve("people").select("nconst", "primaryName"), "nconst").select(
        "nconst", "primaryName", "tconst", "primaryTitle", "startYear", "primaryGenre", "averageRating", "numVotes")


# ================================================================= TSV
@register("scan_tsv", with_ctes("SELECT * FROM basics", "basics"),
          "S1/S3/S4 raw basics written as TSV (\\N nulls, header) then read under the declared schema")
def q_scan_tsv(spark, sf_dir):
    base = scratch_slot(spark, "tsv")
    write_tsv(wb(spark, sf_dir).raw("basics"), f"{base}/{specs.BASICS.file_stem}")
    raw = read_tsv(spark, f"{base}/{specs.BASICS.file_stem}", specs.BASICS, check_header=True)
    return clean(raw, specs.BASICS)


@register("scan_tsv_gz", with_ctes("SELECT * FROM principals", "principals"),
          "S2 gzip TSV found through the .gz fallback, one task per file")
def q_scan_tsv_gz(spark, sf_dir):
    base = scratch_slot(spark, "tsvgz")
    write_tsv(wb(spark, sf_dir).raw("principals"), f"{base}/{specs.PRINCIPALS.file_stem}.gz", "gzip")
    raw = read_tsv(spark, f"{base}/{specs.PRINCIPALS.file_stem}", specs.PRINCIPALS)
    return clean(raw, specs.PRINCIPALS)


# ====================================================== views, end to end
@register("top_titles_view", with_ctes(f"""
    SELECT tconst, primaryTitle, startYear, primaryGenre, averageRating, numVotes, decade
    FROM titles_s WHERE titleType = 'movie' AND numVotes >= {MIN_VOTES_TOP} AND averageRating IS NOT NULL""",
    "titles_s"), "V1 as a catalog view over the serving tables, queried in SQL")
def q_top_titles_view(spark, sf_dir):
    db, _, _ = wb(spark, sf_dir).serving()
    marts.create_views(spark, db, "movie", MIN_VOTES_TOP, "director")
    return spark.sql(f"SELECT * FROM `{db}`.top_titles")


@register("filmography_view", with_ctes("""
    SELECT p.nconst, p.primaryName, t.tconst, t.primaryTitle, t.startYear, t.primaryGenre,
           t.averageRating, t.numVotes
    FROM principals_s pr JOIN titles_s t ON t.tconst = pr.tconst JOIN people_s p ON p.nconst = pr.nconst
    WHERE pr.category = 'director'""", "principals_s", "titles_s", "people_s"),
    "V2 as a catalog view over the serving tables, queried in SQL")
def q_filmography_view(spark, sf_dir):
    db, _, _ = wb(spark, sf_dir).serving()
    marts.create_views(spark, db, "movie", MIN_VOTES_TOP, "director")
    return spark.sql(f"SELECT * FROM `{db}`.role_filmography")


@register("tsv_end_to_end", with_ctes("""
    SELECT decade, round(avg(averageRating), 2) AS avg_rating, count(*) AS total_movies
    FROM titles_s WHERE titleType = 'movie' AND decade IS NOT NULL GROUP BY decade""", "titles_s"),
    "All five raw sources as TSV (ratings gzip) -> etl -> load -> Q1")
def q_tsv_end_to_end(spark, sf_dir):
    from mediamart.jobs import etl, load
    w = wb(spark, sf_dir)
    db = "mm_e2e_" + uuid.uuid4().hex[:10]
    base = scratch_slot(spark, "tsv_end_to_end", db)
    raw_dir, lake_dir = f"{base}/raw", f"{base}/lake"
    for name, spec in specs.SOURCES.items():
        gz = name == "ratings"
        write_tsv(w.raw(name), f"{raw_dir}/{spec.file_stem}" + (".gz" if gz else ""), "gzip" if gz else None)
    etl(spark, raw_dir, lake_dir, check_header=True)
    load(spark, lake_dir, f"{base}/serve", db, verify=False)
    return marts.rating_by_decade(spark.table(f"`{db}`.titles"))


def queries() -> dict[str, Builder]:
    """Every build first applies the session settings the plans rely on."""
    def ready(build: Builder) -> Builder:
        def run(spark, sf_dir):
            apply_conf(spark)
            return build(spark, sf_dir)
        return run
    return {name: ready(q.build) for name, q in REGISTRY.items()}


def oracles() -> dict[str, str]:
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}

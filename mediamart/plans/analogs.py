"""Raw inputs derived from the driver's tables.

The driver ships TPC-H-like tables, not media data, so each of the five raw
sources is *derived* from one driver table by a projection (and, for ratings,
an aggregation). The result has the raw source's exact shape - all-string
columns in file order, with NULLs, blanks, empty strings and malformed values
in known places - so the cleaners, lake, serving layer and marts run on it
unchanged and their work grows with the driver's tables.

Each derivation is written once as SQL expressions that mean the same in Spark
SQL and in DuckDB, so the DuckDB oracle starts from exactly the same raw
strings (``raw_sql``) as the Spark query (``raw_frame``). Some rows hold what
real files hold: fractions and words in number columns, values beyond the
serving range, works with several names of equal or no ordering.

Mapping:
  basics     <- orders    (one title per order; status -> kind, priority -> genres)
  ratings    <- lineitem  grouped by order (rating = 2 * avg quantity / 10)
  people     <- supplier  (negative balance -> NULL key, dropped by the cleaner)
  principals <- lineitem  (return flag -> role, supplier -> person)
  akas       <- documents (source -> region, lang -> language, whole text -> title)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RawAnalog:
    name: str
    table: str
    exprs: tuple[tuple[str, str], ...]     # (output column, SQL expression)
    group_by: tuple[str, ...] = ()         # output columns that are grouping keys


BASICS_RAW = RawAnalog("basics", "orders", (
    ("tconst", "concat('tt', cast(o_orderkey AS string))"),
    ("titleType", "CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'tvSeries' "
                  "ELSE CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN '  ' "
                  "ELSE 'short' END END"),
    ("primaryTitle", "concat('Title ', cast(o_orderkey AS string))"),
    ("originalTitle", "concat('Original ', cast(o_custkey AS string))"),
    ("isAdult", "CASE WHEN o_orderkey % 97 = 1 THEN '300' WHEN o_orderkey % 89 = 1 THEN '-1' "
                "WHEN o_orderkey % 83 = 1 THEN 'yes' WHEN o_totalprice >= 400000 THEN '1' ELSE '0' END"),
    ("startYear", "CASE WHEN o_orderkey % 79 = 1 THEN '1994.5' WHEN o_orderkey % 73 = 1 THEN 'n/a' "
                  "WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN NULL "
                  "ELSE cast(year(o_orderdate) AS string) END"),
    ("endYear", "CASE WHEN o_orderkey % 71 = 1 THEN '70000' WHEN o_orderkey % 67 = 1 THEN '' "
                "WHEN o_orderstatus = 'O' THEN cast(year(o_orderdate) + 1 AS string) END"),
    ("runtimeMinutes", "CASE WHEN o_orderkey % 61 = 1 THEN '-5' WHEN o_orderkey % 59 = 1 THEN '90 min' "
                       "WHEN o_orderkey % 53 = 1 THEN '4294967296' ELSE cast(o_custkey AS string) END"),
    ("genres", "CASE o_orderpriority WHEN '1-URGENT' THEN 'Action,Drama' WHEN '2-HIGH' THEN 'Drama' "
               "WHEN '3-MEDIUM' THEN 'Comedy,Romance' WHEN '4-NOT SPECIFIED' THEN NULL "
               "ELSE ',Documentary' END"),
))

# rating in tenths = floor(2 * total quantity / lines): 0.2 .. 10.0, exact in both engines
_R10 = "cast(floor(2 * sum(l_quantity) / count(*)) AS bigint)"
RATINGS_RAW = RawAnalog("ratings", "lineitem", (
    ("tconst", "concat('tt', cast(l_orderkey AS string))"),
    ("averageRating", f"CASE WHEN max(l_orderkey) % 47 = 1 THEN 'good' ELSE concat(cast(cast(floor({_R10} / 10) AS bigint) AS string), '.', "
                      f"cast({_R10} - 10 * cast(floor({_R10} / 10) AS bigint) AS string)) END"),
    ("numVotes", "CASE WHEN max(l_orderkey) % 43 = 1 THEN '-1' WHEN max(l_orderkey) % 41 = 1 THEN '1e3' "
                 "ELSE cast(cast(sum(l_quantity) AS bigint) AS string) END"),
), group_by=("tconst",))

PEOPLE_RAW = RawAnalog("people", "supplier", (
    ("nconst", "CASE WHEN s_acctbal < 0 THEN NULL ELSE concat('nm', cast(s_suppkey AS string)) END"),
    ("primaryName", "s_name"),
    ("birthYear", "CASE WHEN s_suppkey % 13 = 0 THEN '19x0' WHEN s_suppkey % 11 = 0 THEN '-44' "
                  "ELSE cast(1940 + 2 * s_nationkey AS string) END"),
    ("deathYear", "CASE WHEN s_suppkey % 17 = 0 THEN '65536' WHEN s_suppkey % 19 = 0 THEN 'alive' "
                  "WHEN s_nationkey > 20 THEN cast(2000 + s_nationkey AS string) END"),
    ("primaryProfession", "CASE WHEN s_acctbal < 2000 THEN 'actor,producer' "
                          "WHEN s_acctbal < 5000 THEN 'director,writer' "
                          "WHEN s_acctbal < 8000 THEN ',editor' END"),
    ("knownForTitles", "concat('tt', cast(s_suppkey AS string), ',tt', cast(s_suppkey + 1 AS string))"),
))

PRINCIPALS_RAW = RawAnalog("principals", "lineitem", (
    ("tconst", "concat('tt', cast(l_orderkey AS string))"),
    ("ordering", "CASE WHEN l_orderkey % 37 = 1 AND l_linenumber = 2 THEN '300' "
                 "WHEN l_orderkey % 31 = 1 AND l_linenumber = 3 THEN '3rd' ELSE cast(l_linenumber AS string) END"),
    ("nconst", "CASE WHEN l_discount = 0 THEN NULL ELSE concat('nm', cast(l_suppkey AS string)) END"),
    ("category", "CASE l_returnflag WHEN 'A' THEN 'actor' WHEN 'R' THEN 'director' "
                 "ELSE CASE WHEN l_linestatus = 'O' THEN 'writer' END END"),
    ("job", "CASE WHEN l_returnflag = 'R' THEN 'director' END"),
    ("characters", "CASE WHEN l_returnflag = 'A' THEN concat('[\"Part ', cast(l_partkey AS string), '\"]') END"),
))

AKAS_RAW = RawAnalog("akas", "documents", (
    ("titleId", "concat('tt', cast(cast(floor(doc_id / 60) AS bigint) AS string))"),
    ("ordering", "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN '1' WHEN doc_id % 53 = 0 THEN '70000' "
                 "WHEN doc_id % 29 = 0 THEN 'first' ELSE cast(n_chars AS string) END"),
    ("title", "text"),
    ("region", "CASE source WHEN 'src0' THEN NULL WHEN 'src1' THEN '' ELSE upper(source) END"),
    ("language", "CASE lang WHEN 'es' THEN NULL ELSE lang END"),
    ("types", "CASE lang WHEN 'en' THEN 'display' WHEN 'fr' THEN 'alternative,working' END"),
    ("attributes", "CASE lang WHEN 'de' THEN 'literal title' END"),
    ("isOriginalTitle", "CASE WHEN doc_id % 47 = 0 THEN '-1' WHEN doc_id % 43 = 0 THEN 'maybe' WHEN lang = 'en' THEN '1' ELSE '0' END"),
))

RAW = {a.name: a for a in (BASICS_RAW, RATINGS_RAW, PEOPLE_RAW, PRINCIPALS_RAW, AKAS_RAW)}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    a = RAW[name]
    src = read_table(spark, sf_dir, a.table)
    cols = [F.expr(e).alias(n) for n, e in a.exprs]
    if a.group_by:
        # Group by the *output* key (e.g. tconst), so the aggregate's hash
        # partitioning is the one a later join on that key needs: the join
        # then adds no exchange on this side.
        keys = [F.expr(e).alias(n) for n, e in a.exprs if n in a.group_by]
        aggs = [F.expr(e).alias(n) for n, e in a.exprs if n not in a.group_by]
        return src.groupBy(*keys).agg(*aggs).select(*[n for n, _ in a.exprs])
    return src.select(*cols)


def raw_sql(name: str) -> str:
    """The same derivation as a DuckDB SELECT over the driver's views."""
    a = RAW[name]
    body = ", ".join(f"{e} AS {n}" for n, e in a.exprs)
    sql = f"SELECT {body} FROM {a.table}"
    if a.group_by:
        sql += " GROUP BY " + ", ".join(e for n, e in a.exprs if n in a.group_by)
    return sql

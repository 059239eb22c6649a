"""Declarative dataset specs.

A spec says what a dataset looks like at every layer:

* ``raw``      - the delimited source: all-string columns in file order;
* ``columns``  - how each cleaned (lake) column is derived from raw columns;
* ``required`` - raw keys whose NULL drops the row;
* ``partition_by`` - lake directory layout;
* ``serve``    - serving column types, NULL fill for non-nullable columns,
  unsigned range rule and comment; ``sort_by`` / ``bucket_by`` the
  serving layout.

``operators.clean`` compiles ``columns`` + ``required`` into one filter and one
select; ``sinks.serve`` compiles ``serve`` into one select. Nothing here touches
data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediamart import functions as mf


@dataclass(frozen=True)
class Derived:
    """One lake column: its name and a builder over raw columns."""
    name: str
    build: Callable[[], Column]
    dtype: T.DataType = T.StringType()


@dataclass(frozen=True)
class ServeColumn:
    name: str
    dtype: T.DataType
    nullable: bool = True
    fill: object = None            # value used for NULL when not nullable
    unsigned: str | None = None    # uint8 / uint16 / uint32 range rule
    comment: str = ""


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    raw: tuple[str, ...]
    columns: tuple[Derived, ...]
    required: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    serve: tuple[ServeColumn, ...] = ()
    serve_partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()        # looked up by value though they do not lead the sort
    zorder_by: tuple[str, ...] = ()    # numeric columns that the 'zorder' layout serves alike
    unique_key: tuple[str, ...] = ()   # declared (not enforced) row key
    file_stem: str = ""

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.raw])

    @property
    def lake_schema(self) -> T.StructType:
        return T.StructType([T.StructField(d.name, d.dtype, True) for d in self.columns])

    @property
    def serve_schema(self) -> T.StructType:
        return T.StructType([
            T.StructField(c.name, c.dtype, c.nullable, metadata={"comment": c.comment} if c.comment else {})
            for c in self.serve
        ])

    def column_names(self) -> list[str]:
        return [d.name for d in self.columns]


def _keep(name: str) -> Derived:
    return Derived(name, lambda: F.col(name))


def _int(name: str) -> Derived:
    return Derived(name, lambda: mf.to_int(name), T.IntegerType())


ARR = T.ArrayType(T.StringType(), True)

# ---------------------------------------------------------------------------
# Fixed values. They must equal the reference's for identical results: the
# NULL sentinel, the list separator, the defaults for missing values, the
# input file names, the raw column names in file order, and the column list
# of the titles table. (Serving types and the unsigned range of each serving
# column follow in the ServeColumn lists of the specs below.)
NULL_SENTINEL = "\\N"
LIST_SEP = ","
UNKNOWN = "unknown"
NO_REGION = "XX"
FILE_NAMES = {
    "basics": "title.basics.tsv",
    "ratings": "title.ratings.tsv",
    "people": "name.basics.tsv",
    "principals": "title.principals.tsv",
    "akas": "title.akas.tsv",
}
RAW_COLUMNS = {
    "basics": ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
               "startYear", "endYear", "runtimeMinutes", "genres"),
    "ratings": ("tconst", "averageRating", "numVotes"),
    "people": ("nconst", "primaryName", "birthYear", "deathYear", "primaryProfession", "knownForTitles"),
    "principals": ("tconst", "ordering", "nconst", "category", "job", "characters"),
    "akas": ("titleId", "ordering", "title", "region", "language", "types", "attributes", "isOriginalTitle"),
}
TITLES_COLUMNS = ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
                  "startYear", "endYear", "runtimeMinutes", "genres", "primaryGenre",
                  "decade", "averageRating", "numVotes")
# ---------------------------------------------------------------------------

BASICS = DatasetSpec(
    name="basics",
    file_stem=FILE_NAMES["basics"],
    raw=RAW_COLUMNS["basics"],
    columns=(
        _keep("tconst"),
        Derived("titleType", lambda: mf.blank_to("titleType", UNKNOWN)),
        _keep("primaryTitle"),
        _keep("originalTitle"),
        _int("isAdult"),
        _int("startYear"),
        _int("endYear"),
        _int("runtimeMinutes"),
        Derived("genres", lambda: mf.split_list("genres", LIST_SEP), ARR),
        Derived("primaryGenre", lambda: mf.first_or_null(mf.split_list("genres", LIST_SEP))),
        Derived("decade", lambda: mf.decade_of(mf.to_int("startYear")), T.IntegerType()),
    ),
)

RATINGS = DatasetSpec(
    name="ratings",
    file_stem=FILE_NAMES["ratings"],
    raw=RAW_COLUMNS["ratings"],
    columns=(
        _keep("tconst"),
        Derived("averageRating", lambda: mf.to_float("averageRating"), T.FloatType()),
        _int("numVotes"),
    ),
)

# The titles mart = basics LEFT JOIN ratings (operators.enrich), TITLES_COLUMNS.

TITLES = DatasetSpec(
    name="titles",
    raw=(),
    columns=tuple(
        [d for d in BASICS.columns]
        + [d for d in RATINGS.columns if d.name != "tconst"]
    ),
    partition_by=("titleType", "decade"),
    serve=(
        ServeColumn("tconst", T.StringType(), False, "", comment="key of the work"),
        ServeColumn("titleType", T.StringType(), False, UNKNOWN, comment="what sort of work"),
        ServeColumn("primaryTitle", T.StringType(), False, "", comment="name it is shown under"),
        ServeColumn("originalTitle", T.StringType(), False, "", comment="name at first release"),
        ServeColumn("isAdult", T.IntegerType(), False, 0, "uint8", "adult flag, 0 or 1"),
        ServeColumn("startYear", T.IntegerType(), True, None, "uint16", "year it came out or began"),
        ServeColumn("endYear", T.IntegerType(), True, None, "uint16", "end year"),
        ServeColumn("runtimeMinutes", T.IntegerType(), True, None, "uint32", "length, minutes"),
        ServeColumn("genres", ARR, False, "array", comment="genres"),
        ServeColumn("primaryGenre", T.StringType(), False, "", comment="genre listed first"),
        ServeColumn("decade", T.IntegerType(), True, None, "uint16", "first year of startYear's decade"),
        ServeColumn("averageRating", T.FloatType(), True, None, comment="mean of the votes"),
        ServeColumn("numVotes", T.IntegerType(), True, None, "uint32", "votes counted"),
    ),
    serve_partition_by=("titleType", "decade"),
    sort_by=("titleType", "startYear", "tconst"),
    bucket_by=("tconst",),
    bloom=("tconst",),
    zorder_by=("startYear", "numVotes"),
    unique_key=("tconst",),
)

PEOPLE = DatasetSpec(
    name="people",
    file_stem=FILE_NAMES["people"],
    raw=RAW_COLUMNS["people"],
    columns=(
        _keep("nconst"),
        _keep("primaryName"),
        _int("birthYear"),
        _int("deathYear"),
        Derived("primaryProfession", lambda: mf.split_list("primaryProfession", LIST_SEP), ARR),
        Derived("knownForTitles", lambda: mf.split_list("knownForTitles", LIST_SEP), ARR),
        Derived("primaryProfession0",
                lambda: mf.first_or(mf.split_list("primaryProfession", LIST_SEP), UNKNOWN)),
    ),
    required=("nconst",),
    partition_by=("primaryProfession0",),
    serve=(
        ServeColumn("nconst", T.StringType(), False, "", comment="key of the person"),
        ServeColumn("primaryName", T.StringType(), False, "", comment="name as credited"),
        ServeColumn("birthYear", T.IntegerType(), True, None, "uint16", "birth year"),
        ServeColumn("deathYear", T.IntegerType(), True, None, "uint16", "death year"),
        ServeColumn("primaryProfession", ARR, False, "array", comment="professions"),
        ServeColumn("knownForTitles", ARR, False, "array", comment="identifiers of well-known works"),
    ),
    sort_by=("nconst",),
    bucket_by=("nconst",),
    unique_key=("nconst",),
)

PRINCIPALS = DatasetSpec(
    name="principals",
    file_stem=FILE_NAMES["principals"],
    raw=RAW_COLUMNS["principals"],
    columns=(
        _keep("tconst"),
        _int("ordering"),
        _keep("nconst"),
        Derived("category", lambda: mf.null_to("category", UNKNOWN)),
        _keep("job"),
        _keep("characters"),
    ),
    required=("tconst", "nconst"),
    partition_by=("category",),
    serve=(
        ServeColumn("tconst", T.StringType(), False, "", comment="key of the work"),
        ServeColumn("ordering", T.IntegerType(), False, 0, "uint8", "place in the credits"),
        ServeColumn("nconst", T.StringType(), False, "", comment="key of the person"),
        ServeColumn("category", T.StringType(), False, UNKNOWN, comment="role"),
        ServeColumn("job", T.StringType(), True, None, comment="job within the role, if any"),
        ServeColumn("characters", T.StringType(), True, None, comment="parts played, as JSON text"),
    ),
    serve_partition_by=("category",),
    sort_by=("tconst", "ordering"),
    bucket_by=("tconst",),
    bloom=("nconst",),
    unique_key=("tconst", "ordering"),
)

AKAS = DatasetSpec(
    name="akas",
    file_stem=FILE_NAMES["akas"],
    raw=RAW_COLUMNS["akas"],
    columns=(
        _keep("titleId"),
        _int("ordering"),
        _keep("title"),
        Derived("region", lambda: mf.empty_to("region", NO_REGION)),
        Derived("language", lambda: mf.empty_to("language", "")),
        Derived("types", lambda: mf.split_list_or_empty("types", LIST_SEP), ARR),
        Derived("attributes", lambda: mf.split_list_or_empty("attributes", LIST_SEP), ARR),
        _int("isOriginalTitle"),
    ),
    required=("titleId",),
    partition_by=("region",),
    serve=(
        ServeColumn("titleId", T.StringType(), False, "", comment="key of the work"),
        ServeColumn("ordering", T.IntegerType(), False, 0, "uint16", "place among the title's names"),
        ServeColumn("title", T.StringType(), False, "", comment="name used in the region"),
        ServeColumn("region", T.StringType(), False, NO_REGION, comment="region code"),
        ServeColumn("language", T.StringType(), False, "", comment="language code"),
        ServeColumn("types", ARR, False, "array", comment="title types"),
        ServeColumn("attributes", ARR, False, "array", comment="title attributes"),
        ServeColumn("isOriginalTitle", T.IntegerType(), False, 0, "uint8", "flag: this is the original name"),
    ),
    serve_partition_by=("region",),
    sort_by=("titleId", "region", "ordering"),
    bucket_by=("titleId",),
    unique_key=("titleId", "ordering"),
)

SOURCES = {s.name: s for s in (BASICS, RATINGS, PEOPLE, PRINCIPALS, AKAS)}
LAKE = {s.name: s for s in (TITLES, PEOPLE, PRINCIPALS, AKAS)}

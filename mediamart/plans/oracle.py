"""DuckDB SQL for the cleaned analog tables, used by ``oracle_sql()``.

These are independent restatements of the cleaning rules in plain SQL (not
generated from the Spark specs), so the driver's comparison checks the Spark
operators against a second implementation. ``with_ctes(body, *names)``
prefixes a query with the CTEs it needs, in dependency order.
"""

from __future__ import annotations

from mediamart.plans.analogs import raw_sql


def _int(c: str) -> str:
    # Spark's try_cast to int accepts surrounding blanks and an optional sign,
    # and rejects fractions (DuckDB would round '1994.5').
    return f"(CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS INTEGER) END)"


def _split(c: str) -> str:
    return f"string_split({c}, ',')"


CTES: dict[str, str] = {
    "basics_raw": raw_sql("basics"),
    "ratings_raw": raw_sql("ratings"),
    "people_raw": raw_sql("people"),
    "principals_raw": raw_sql("principals"),
    "akas_raw": raw_sql("akas"),
    "basics": f"""
        SELECT tconst,
               CASE WHEN titleType IS NULL OR trim(titleType) = '' THEN 'unknown' ELSE titleType END AS titleType,
               primaryTitle, originalTitle,
               {_int('isAdult')} AS isAdult, {_int('startYear')} AS startYear,
               {_int('endYear')} AS endYear, {_int('runtimeMinutes')} AS runtimeMinutes,
               {_split('genres')} AS genres,
               nullif({_split('genres')}[1], '') AS primaryGenre,
               CAST(trunc({_int('startYear')} / 10) AS INTEGER) * 10 AS decade
        FROM basics_raw""",
    "ratings": f"""
        SELECT tconst, TRY_CAST(averageRating AS FLOAT) AS averageRating, {_int('numVotes')} AS numVotes
        FROM ratings_raw""",
    "titles": """
        SELECT b.tconst, b.titleType, b.primaryTitle, b.originalTitle, b.isAdult, b.startYear, b.endYear,
               b.runtimeMinutes, b.genres, b.primaryGenre, b.decade, r.averageRating, r.numVotes
        FROM basics b LEFT JOIN ratings r ON r.tconst = b.tconst""",
    "people": f"""
        SELECT nconst, primaryName, {_int('birthYear')} AS birthYear, {_int('deathYear')} AS deathYear,
               {_split('primaryProfession')} AS primaryProfession, {_split('knownForTitles')} AS knownForTitles,
               coalesce(nullif({_split('primaryProfession')}[1], ''), 'unknown') AS primaryProfession0
        FROM people_raw WHERE nconst IS NOT NULL""",
    "principals": f"""
        SELECT tconst, {_int('ordering')} AS ordering, nconst, coalesce(category, 'unknown') AS category,
               job, characters
        FROM principals_raw WHERE tconst IS NOT NULL AND nconst IS NOT NULL""",
    "akas": f"""
        SELECT titleId, {_int('ordering')} AS ordering, title,
               coalesce(nullif(region, ''), 'XX') AS region,
               coalesce(nullif(language, ''), '') AS language,
               {_split("coalesce(types, '')")} AS types,
               {_split("coalesce(attributes, '')")} AS attributes,
               {_int('isOriginalTitle')} AS isOriginalTitle
        FROM akas_raw WHERE titleId IS NOT NULL""",
}

# Serving form of the cleaned tables: non-nullable columns filled.
_EMPTY = "CAST([] AS VARCHAR[])"
CTES.update({
    "titles_s": f"""
        SELECT tconst, titleType, coalesce(primaryTitle, '') AS primaryTitle,
               coalesce(originalTitle, '') AS originalTitle, coalesce(isAdult, 0) AS isAdult, startYear, endYear,
               runtimeMinutes, coalesce(genres, {_EMPTY}) AS genres, coalesce(primaryGenre, '') AS primaryGenre,
               decade, averageRating, numVotes
        FROM titles""",
    "people_s": f"""
        SELECT nconst, coalesce(primaryName, '') AS primaryName, birthYear, deathYear,
               coalesce(primaryProfession, {_EMPTY}) AS primaryProfession,
               coalesce(knownForTitles, {_EMPTY}) AS knownForTitles
        FROM people""",
    "principals_s": """
        SELECT tconst, coalesce(ordering, 0) AS ordering, nconst, category, job, characters
        FROM principals""",
    "akas_s": """
        SELECT titleId, coalesce(ordering, 0) AS ordering, coalesce(title, '') AS title, region,
               language, types, attributes, coalesce(isOriginalTitle, 0) AS isOriginalTitle
        FROM akas""",
})

DEPENDS: dict[str, tuple[str, ...]] = {
    "titles_s": ("titles",),
    "people_s": ("people",),
    "principals_s": ("principals",),
    "akas_s": ("akas",),
    "basics": ("basics_raw",),
    "ratings": ("ratings_raw",),
    "titles": ("basics", "ratings"),
    "people": ("people_raw",),
    "principals": ("principals_raw",),
    "akas": ("akas_raw",),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *names: str) -> str:
    order = _closure(names)
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH {ctes}\n{body}"

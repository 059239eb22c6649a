"""Marts (Q1-Q6, V1, V2, F11), rollup (A6) and checks against brute force in
plain Python on small fixtures."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from mediamart import specs
from mediamart.operators import checks, rollup
from mediamart.operators.clean import clean
from mediamart.operators.enrich import lookup_names, titles_mart
from mediamart.plans import marts

random.seed(7)
KINDS = ["movie", "short", "tvSeries"]
GENRES = ["Drama", "Action", "", None]


def make_titles(spark, n=400):
    rows = []
    for i in range(n):
        year = random.choice([None, 1950, 1975, 1994, 2003, 2021])
        rating = random.choice([None, 5.5, 7.25, 8.5, 9.0])
        votes = None if rating is None else random.randint(1, 30000)
        g = random.choice(GENRES)
        rows.append((f"tt{i}", random.choice(KINDS), f"T{i}", f"T{i}", 0, year, None, None,
                     None if g is None else [g], g or None, None if year is None else year // 10 * 10,
                     rating, votes))
    return rows, spark.createDataFrame(rows, specs.TITLES.lake_schema)


def py_round(x, d):
    return None if x is None else round(x + 0.0, d)


def test_rating_by_decade_and_trend(spark):
    rows, df = make_titles(spark)
    got = {r.decade: (r.avg_rating, r.total_movies) for r in marts.rating_by_decade(df).collect()}
    want = defaultdict(list)
    for r in rows:
        if r[1] == "movie" and r[10] is not None:
            want[r[10]].append(r[11])
    assert set(got) == set(want)
    for d, ratings in want.items():
        rated = [x for x in ratings if x is not None]
        assert got[d][1] == len(ratings)
        assert got[d][0] == (py_round(sum(rated) / len(rated), 2) if rated else None)
    trend = {r.decade: r.movies_released for r in marts.rating_trend(df).collect()}
    assert trend == {d: len(v) for d, v in want.items() if 1950 <= d <= 2020}


def test_top_genres_filters_and_ties(spark):
    rows, df = make_titles(spark)
    got = marts.top_genres(df, min_votes=10000).collect()
    groups = defaultdict(list)
    for r in rows:
        if r[12] is not None and r[12] >= 10000 and r[9] not in (None, ""):
            groups[r[9]].append(r)
    assert {r.primaryGenre for r in got} == set(groups)
    for r in got:
        g = groups[r.primaryGenre]
        assert r.title_count == len(g) and r.total_votes == sum(x[12] for x in g)


def test_most_credited_with_names_and_skewed_key(spark):
    # one person holds a third of all credits
    pr = [("tt%d" % i, 1, "nm_hot" if i % 3 == 0 else "nm%d" % (i % 40), "actor", None, None) for i in range(900)]
    people = [("nm%d" % i, "Name %d" % i, None, None, [], [], "actor") for i in range(0, 40, 2)]
    people.append(("nm_hot", "Hot", None, None, [], [], "actor"))
    p_df = spark.createDataFrame(pr, specs.PRINCIPALS.lake_schema)
    pe_df = spark.createDataFrame(people, specs.PEOPLE.lake_schema)
    got = marts.most_credited(p_df, pe_df, "actor", "title_count", k=5).collect()
    counts = defaultdict(int)
    for r in pr:
        counts[r[2]] += 1
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    names = {p[0]: p[1] for p in people}
    assert [(r.nconst, r.primaryName, r.title_count) for r in got] == [(k, names.get(k), v) for k, v in want]
    sql = marts.most_credited_sql(spark, p_df, pe_df, "actor", "title_count", k=5).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in got]


def test_lookup_names_broadcasts_only_the_key_set(spark):
    keys = spark.createDataFrame([("a", 1)], "nconst string, n long").limit(1)
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "nconst string, primaryName string")
    df = lookup_names(keys, dim, "nconst", ["primaryName"], bound=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert df.collect()[0].primaryName == "A"


def test_filmography_and_top_billed(spark):
    _, titles = make_titles(spark, 50)
    pr = spark.createDataFrame([("tt1", 1, "nm1", "director", None, None), ("tt2", 1, "nm9", "director", None, None),
                                ("tt1", 2, "nm1", "actor", None, None)], specs.PRINCIPALS.lake_schema)
    people = spark.createDataFrame([("nm1", "One", 1975, None, ["director"], [], "director")],
                                   specs.PEOPLE.lake_schema)
    film = marts.role_filmography(pr, titles, people, "director").collect()
    assert [(r.nconst, r.tconst) for r in film] == [("nm1", "tt1")]          # inner joins
    billed = sorted((r.tconst, r.primaryName) for r in marts.top_billed(pr, people).collect())
    assert billed == [("tt1", "One"), ("tt2", None)]                        # left join keeps nm9
    assert [r.nconst for r in marts.people_by_role_year(people, "director", 1970).collect()] == ["nm1"]


def test_rollup_coarse_equals_direct(spark):
    _, df = make_titles(spark, 800)
    r = rollup.build_rollup(df)
    coarse = {x.primaryGenre: (x.avg_rating, x.total_votes, x.title_count)
              for x in rollup.coarsen(r, ["primaryGenre"]).collect()}
    direct = {x.primaryGenre: (x.a, x.v, x.c) for x in df.groupBy("primaryGenre").agg(
        F.round(F.avg("averageRating"), 2).alias("a"), F.sum("numVotes").alias("v"),
        F.count(F.lit(1)).alias("c")).collect()}
    assert coarse == direct


def test_titles_mart_keeps_unrated_and_fans_out(spark):
    b = spark.createDataFrame([("tt1", "movie", None, None, None, None, None, None, None),
                               ("tt2", "movie", None, None, None, None, None, None, None)],
                              specs.BASICS.raw_schema)
    r = spark.createDataFrame([("tt1", "7.0", "10"), ("tt1", "8.0", "5")], specs.RATINGS.raw_schema)
    out = titles_mart(clean(b, specs.BASICS), clean(r, specs.RATINGS)).collect()
    assert len(out) == 3 and len(out[0]) == 13
    assert [x.averageRating for x in out if x.tconst == "tt2"] == [None]


def test_row_loss_counts(spark):
    raw = spark.createDataFrame([("nm1", "A", None, None, None, None), (None, "B", None, None, None, None)],
                                specs.PEOPLE.raw_schema)
    r = checks.row_loss(raw, clean(raw, specs.PEOPLE), specs.PEOPLE).first()
    assert (r.rows_in, r.rows_out, r.null_key_rows) == (2, 1, 1)


def test_enrichment_broadcasts_small_ratings_and_shuffles_when_large(spark):
    from mediamart.plans.workbench import Workbench
    from tests.conftest import SF_SMALL
    df = Workbench.get(spark, SF_SMALL).titles()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = Workbench.get(spark, SF_SMALL).titles()
        big.collect()
        plan = big._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64m")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64m")


def test_localized_title_does_not_depend_on_row_order(spark):
    rows = [("t1", 1, "B", "XX", "de"), ("t1", 1, "A", "XX", "fr"), ("t1", None, "0", "XX", "aa"),
            ("t2", None, "only", "XX", None), ("t3", 2, None, "XX", "en"), ("t3", 3, "late", "XX", "en")]
    want = {"t1": ("A", "fr", 3), "t2": ("only", None, 1), "t3": (None, "en", 2)}
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "titleId string, ordering int, title string, region string, language string")
        got = {r.titleId: (r.localized_title, r.language, r.variants) for r in marts.localized_title(df, "XX").collect()}
        assert got == want


def test_lookup_without_a_broadcast_hint_past_the_bound(spark, monkeypatch):
    from mediamart.operators import enrich
    monkeypatch.setattr(enrich, "MAX_BROADCAST_KEYS", 1)
    pr = spark.createDataFrame([("nm1", "actor"), ("nm1", "actor"), ("nm2", "actor")], "nconst string, category string")
    pe = spark.createDataFrame([("nm1", "Ann")], "nconst string, primaryName string")
    assert [tuple(r) for r in marts.most_credited(pr, pe, "actor", k=5).collect()] == [("nm1", "Ann", 2), ("nm2", None, 1)]

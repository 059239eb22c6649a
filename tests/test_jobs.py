"""etl() and load() end to end on TSV fixtures."""

import os
import uuid

import pytest

from mediamart import specs
from mediamart.jobs import etl, load
from mediamart.plans import marts


def write(path, header, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\t".join(header) + "\n" + "\n".join(rows) + "\n")


@pytest.fixture()
def raw_dir(tmp):
    d = os.path.join(tmp, "raw")
    os.makedirs(d)
    write(os.path.join(d, specs.BASICS.file_stem), specs.BASICS.raw, [
        "tt1\tmovie\tA\tA\t0\t1994\t\\N\t90\tDrama",
        "tt2\tmovie\tB\tB\t0\t2003\t\\N\t80\tAction,Drama",
        "tt3\tshort\tC\tC\t0\t\\N\t\\N\t5\t\\N"])
    write(os.path.join(d, specs.RATINGS.file_stem), specs.RATINGS.raw, ["tt1\t8.5\t30000", "tt2\t6.0\t100"])
    write(os.path.join(d, specs.PEOPLE.file_stem), specs.PEOPLE.raw, [
        "nm1\tAnn\t1970\t\\N\tdirector\ttt1", "nm2\tBob\t1980\t\\N\tactor,producer\ttt2"])
    write(os.path.join(d, specs.PRINCIPALS.file_stem), specs.PRINCIPALS.raw, [
        "tt1\t1\tnm1\tdirector\t\\N\t\\N", "tt2\t1\tnm2\tactor\t\\N\t[\"X\"]", "tt2\t2\tnm1\tdirector\t\\N\t\\N"])
    write(os.path.join(d, specs.AKAS.file_stem), specs.AKAS.raw, [
        "tt1\t1\tUn\tFR\tfr\t\\N\t\\N\t0", "tt1\t2\tOne\t\\N\t\\N\t\\N\t\\N\t1"])
    return d


def test_etl_then_load_then_query(spark, raw_dir, tmp):
    lake = os.path.join(tmp, "lake")
    written = etl(spark, raw_dir, lake)
    assert set(written) == {"titles", "people", "principals", "akas"}
    db = "p_" + uuid.uuid4().hex[:8]
    out = load(spark, lake, os.path.join(tmp, "serve"), db)
    assert out["counts"] == {"titles": 3, "people": 2, "principals": 3, "akas": 2}
    assert out["stats"]["titles"]["rows"] == 3 and out["total_elapsed_s"] > 0
    q1 = {r.decade: (r.avg_rating, r.total_movies) for r in marts.rating_by_decade(spark.table(f"{db}.titles")).collect()}
    assert q1 == {1990: (8.5, 1), 2000: (6.0, 1)}
    film = marts.role_filmography(spark.table(f"{db}.principals"), spark.table(f"{db}.titles"),
                                  spark.table(f"{db}.people"), "director").collect()
    assert sorted(r.tconst for r in film) == ["tt1", "tt2"]
    # a re-run with truncate leaves one copy; only= restricts the load
    out = load(spark, lake, os.path.join(tmp, "serve"), db, only=["people"])
    assert out["counts"] == {"people": 2}
    assert spark.table(f"{db}.titles").count() == 3


def test_title_slice_mode(spark, raw_dir, tmp):
    lake = os.path.join(tmp, "lake")
    etl(spark, raw_dir, lake, ["titles"])
    etl(spark, raw_dir, lake, ["titles"], title_type="movie")
    etl(spark, raw_dir, lake, ["titles"], title_type="movie")
    assert spark.read.schema(specs.TITLES.lake_schema).parquet(os.path.join(lake, "titles")).count() == 3


def test_missing_inputs_fail_before_any_job(spark, tmp):
    with pytest.raises(FileNotFoundError) as err:
        etl(spark, os.path.join(tmp, "empty"), os.path.join(tmp, "lake"))
    for spec in specs.SOURCES.values():
        assert spec.file_stem in str(err.value)


def test_load_skips_missing_lake_dataset(spark, raw_dir, tmp):
    lake = os.path.join(tmp, "lake")
    etl(spark, raw_dir, lake, ["people"])
    db = "p_" + uuid.uuid4().hex[:8]
    out = load(spark, lake, os.path.join(tmp, "serve"), db)
    assert out["stats"]["titles"] == {"rows": 0, "files": 0, "elapsed_s": 0.0}
    assert out["counts"] == {"people": 2}

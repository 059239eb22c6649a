"""TSV sources (S1-S4) on small fixture files with the edge rows of FIXTURES.md."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from mediamart import specs
from mediamart.operators.clean import clean
from mediamart.sources.tsv import check_inputs, read_tsv, resolve_path

HEADER = "\t".join(specs.BASICS.raw)
ROWS = [
    # tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtime, genres
    "tt1\tmovie\tA\tA\t0\t1994\t\\N\t90\tAction,Drama",
    "tt2\t\\N\tB\tB\t0\t\\N\t\\N\t\\N\t\\N",
    "tt3\t  \t\"q\tback\\slash\t1\t 1994 \t\\N\tabc\ty,",
    "tt4\t\tta\\\t\t\t1994.5\t\t3000000000\t,z",
    "tt5\tshort",                                   # too few fields
    "tt6\tshort\tC\tC\t0\t2001\t\\N\t5\tDrama\textra",  # too many fields
]


def write(path, lines, gz=False):
    data = "\n".join(lines) + "\n"
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(data)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(data)


@pytest.fixture()
def basics_file(tmp):
    p = os.path.join(tmp, "title.basics.tsv")
    write(p, [HEADER] + ROWS)
    return p


def test_raw_reader_edges(spark, basics_file):
    rows = {r.tconst: r for r in read_tsv(spark, basics_file, specs.BASICS).collect()}
    assert len(rows) == 6
    assert rows["tt2"].titleType is None and rows["tt2"].genres is None       # \N -> NULL
    assert rows["tt4"].titleType is None                                     # empty field -> NULL
    assert rows["tt3"].titleType == "  "                                     # blanks kept
    assert rows["tt3"].primaryTitle == '"q'                                  # unbalanced quote literal
    assert rows["tt3"].originalTitle == "back\\slash"
    assert rows["tt4"].primaryTitle == "ta\\" and rows["tt4"].originalTitle is None
    assert rows["tt5"].primaryTitle is None and rows["tt5"].genres is None  # short row padded
    assert rows["tt6"].genres == "Drama"                                     # extra field dropped


def test_clean_basics_from_tsv(spark, basics_file):
    out = {r.tconst: r for r in clean(read_tsv(spark, basics_file, specs.BASICS), specs.BASICS).collect()}
    assert out["tt1"].genres == ["Action", "Drama"] and out["tt1"].primaryGenre == "Action"
    assert out["tt1"].decade == 1990 and out["tt1"].startYear == 1994
    assert out["tt2"].titleType == "unknown" and out["tt2"].decade is None and out["tt2"].primaryGenre is None
    assert out["tt3"].titleType == "unknown"                    # blank after trim
    assert out["tt3"].startYear == 1994 and out["tt3"].runtimeMinutes is None
    assert out["tt3"].genres == ["y", ""] and out["tt3"].primaryGenre == "y"
    assert out["tt4"].startYear is None and out["tt4"].runtimeMinutes is None   # 1994.5, 3e9
    assert out["tt4"].genres == ["", "z"] and out["tt4"].primaryGenre is None
    assert len(out) == 6                                        # no key filter on titles


def test_gzip_same_rows(spark, tmp):
    write(os.path.join(tmp, "title.basics.tsv.gz"), [HEADER] + ROWS, gz=True)
    base = os.path.join(tmp, "title.basics.tsv")
    assert resolve_path(spark, base).endswith(".gz")
    got = sorted(tuple(r) for r in read_tsv(spark, base, specs.BASICS).collect())
    plain_dir = os.path.join(tmp, "plain")
    os.makedirs(plain_dir)
    write(os.path.join(plain_dir, "title.basics.tsv"), [HEADER] + ROWS)
    want = sorted(tuple(r) for r in read_tsv(spark, os.path.join(plain_dir, "title.basics.tsv"),
                                             specs.BASICS).collect())
    assert got == want


def test_plain_wins_over_gz(spark, tmp):
    base = os.path.join(tmp, "title.ratings.tsv")
    write(base, ["tconst\taverageRating\tnumVotes", "tt1\t7.5\t10"])
    write(base + ".gz", ["tconst\taverageRating\tnumVotes", "tt9\t1.0\t1"], gz=True)
    assert resolve_path(spark, base) == base
    assert [r.tconst for r in read_tsv(spark, base, specs.RATINGS).collect()] == ["tt1"]


def test_missing_inputs_reported_together(spark, tmp):
    write(os.path.join(tmp, "title.ratings.tsv"), ["tconst\taverageRating\tnumVotes"])
    with pytest.raises(FileNotFoundError) as err:
        check_inputs(spark, tmp, [specs.BASICS, specs.RATINGS, specs.PEOPLE])
    msg = str(err.value)
    assert "title.basics.tsv" in msg and "name.basics.tsv" in msg and "title.ratings.tsv" not in msg


def test_neither_present(spark, tmp):
    with pytest.raises(FileNotFoundError):
        resolve_path(spark, os.path.join(tmp, "nothing.tsv"))


def test_header_check(spark, tmp):
    p = os.path.join(tmp, "title.ratings.tsv")
    write(p, ["tconst\tWRONG\tnumVotes", "tt1\t7.5\t10"])
    # accepted silently by default
    assert read_tsv(spark, p, specs.RATINGS).count() == 1
    with pytest.raises(Exception):
        read_tsv(spark, p, specs.RATINGS, check_header=True).collect()


def test_akas_null_types_and_region(spark, tmp):
    p = os.path.join(tmp, "title.akas.tsv")
    write(p, ["\t".join(specs.AKAS.raw),
              "tt1\t1\tT\t\\N\t\\N\t\\N\t\\N\t0",
              "tt1\t2\tT\t  \ten\ta,b\tx\t1",
              "\\N\t3\tT\tUS\ten\t\\N\t\\N\t0"])
    out = clean(read_tsv(spark, p, specs.AKAS), specs.AKAS).orderBy("ordering").collect()
    assert len(out) == 2                                   # NULL titleId dropped
    assert out[0].region == "XX" and out[0].language == "" and out[0].types == [""]
    assert out[1].region == "  " and out[1].types == ["a", "b"]


def test_people_first_profession_and_key_filter(spark, tmp):
    p = os.path.join(tmp, "name.basics.tsv")
    write(p, ["\t".join(specs.PEOPLE.raw),
              "nm1\tA\t1970\t\\N\tdirector,writer\ttt1,tt2",
              "nm2\tB\t\\N\t\\N\t\\N\t\\N",
              "\\N\tC\t1980\t\\N\tactor\ttt3"])
    raw = read_tsv(spark, p, specs.PEOPLE)
    out = {r.nconst: r for r in clean(raw, specs.PEOPLE).collect()}
    assert set(out) == {"nm1", "nm2"}
    assert out["nm1"].primaryProfession0 == "director" and out["nm1"].knownForTitles == ["tt1", "tt2"]
    assert out["nm2"].primaryProfession0 == "unknown" and out["nm2"].primaryProfession is None


def test_credits_filter_and_category(spark, tmp):
    p = os.path.join(tmp, "title.principals.tsv")
    write(p, ["\t".join(specs.PRINCIPALS.raw),
              "tt1\t1\tnm1\tactor\t\\N\t[\"Hero\"]",
              "tt1\t300\tnm2\t\\N\t\\N\t\\N",
              "tt1\t2\t\\N\tactor\t\\N\t\\N",
              "\\N\t3\tnm3\tactor\t\\N\t\\N"])
    out = clean(read_tsv(spark, p, specs.PRINCIPALS), specs.PRINCIPALS).orderBy("ordering").collect()
    assert [(r.ordering, r.category) for r in out] == [(1, "actor"), (300, "unknown")]
    assert out[0].characters == '["Hero"]'


def test_gzip_read_adds_no_shuffle_of_its_own(spark, tmp):
    write(os.path.join(tmp, "title.ratings.tsv.gz"),
          ["tconst\taverageRating\tnumVotes"] + [f"tt{i}\t5.0\t{i}" for i in range(2000)], gz=True)
    df = read_tsv(spark, os.path.join(tmp, "title.ratings.tsv"), specs.RATINGS)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.agg(F.count(F.lit(1))).first()[0] == 2000


def test_write_then_read_keeps_blanks_and_nulls(spark, tmp):
    from mediamart.sources.tsv import write_tsv
    df = spark.createDataFrame([("tt1", "  ", None), ("tt2", "q\"x", "a\\b")], specs.RATINGS.raw_schema)
    path = os.path.join(tmp, "title.ratings.tsv")
    write_tsv(df, path)
    back = sorted(tuple(r) for r in read_tsv(spark, path, specs.RATINGS).collect())
    assert back == [("tt1", "  ", None), ("tt2", "q\"x", "a\\b")]

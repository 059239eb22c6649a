"""Property tests: the Column builders against a plain-Python model of each
rule, on random strings made of the characters that matter (blanks,
separators, signs, dots, digits). One Spark job per generated batch."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from mediamart import functions as mf

ALPHABET = " ,.+-0123456789ab"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=8)), min_size=1, max_size=60)

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


def model_int(s):
    if s is None:
        return None
    t = s.strip()
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    v = int(t)
    return v if INT_MIN <= v <= INT_MAX else None


def model_blank(s):
    return "unknown" if s is None or s.strip(" ") == "" else s


def model_empty(s):
    return "XX" if s is None or s == "" else s


def model_split(s):
    return None if s is None else s.split(",")


def model_first(s):
    parts = model_split(s)
    if not parts or parts[0] == "":
        return None
    return parts[0]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_builders_match_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = df.select(
        "i",
        mf.to_int("v").alias("as_int"),
        mf.blank_to("v", "unknown").alias("blank"),
        mf.empty_to("v", "XX").alias("empty"),
        mf.split_list("v", ",").alias("parts"),
        mf.split_list_or_empty("v", ",").alias("parts0"),
        mf.first_or_null(mf.split_list("v", ",")).alias("first"),
        mf.decade_of(mf.to_int("v")).alias("decade"),
    ).orderBy("i").collect()
    for r, v in zip(out, values):
        assert r.as_int == model_int(v), v
        assert r.blank == model_blank(v), v
        assert r.empty == model_empty(v), v
        assert r.parts == model_split(v), v
        assert r.parts0 == ("" if v is None else v).split(","), v
        assert r.first == model_first(v), v
        i = model_int(v)
        assert r.decade == (None if i is None else int(i / 10) * 10), v


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sizes=st.lists(st.integers(min_value=0, max_value=2 ** 50), min_size=1, max_size=30))
def test_readable_size_round_trips(spark, sizes):
    df = spark.createDataFrame([(s,) for s in sizes], "b long")
    units = {"B": 0, "KiB": 1, "MiB": 2, "GiB": 3, "TiB": 4, "PiB": 5, "EiB": 6}
    for s, (text,) in zip(sizes, df.select(mf.readable_size("b")).collect()):
        num, unit = text.split()
        scaled = s / 1024 ** units[unit]
        assert abs(float(num) - scaled) <= 0.005 + 1e-9 * scaled
        assert scaled < 1024 or unit == "EiB"
        assert unit == "B" or scaled >= 1

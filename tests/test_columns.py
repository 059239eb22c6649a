"""Column builders (P1-P9b, A8) on the edge values of FIXTURES.md section 2."""

from pyspark.sql import functions as F

from mediamart import functions as mf


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_to_int_edges(spark):
    got = one_col(spark, ["1994", " 1994 ", "abc", "", None, "3000000000", "1994.5", "-15", "+7"], mf.to_int)
    assert got == [1994, 1994, None, None, None, None, None, -15, 7]


def test_to_float(spark):
    got = one_col(spark, ["7.3", "x", None], mf.to_float)
    assert abs(got[0] - 7.3) < 1e-6 and got[1] is None and got[2] is None


def test_blank_null_empty_differ(spark):
    vals = [None, "", "  ", "x", " x "]
    assert one_col(spark, vals, lambda c: mf.blank_to(c, "unknown")) == ["unknown", "unknown", "unknown", "x", " x "]
    assert one_col(spark, vals, lambda c: mf.null_to(c, "unknown")) == ["unknown", "", "  ", "x", " x "]
    assert one_col(spark, vals, lambda c: mf.empty_to(c, "XX")) == ["XX", "XX", "  ", "x", " x "]


def test_split_list(spark):
    got = one_col(spark, ["A,B", "y,", ",z", None, "solo"], lambda c: mf.split_list(c, ","))
    assert got == [["A", "B"], ["y", ""], ["", "z"], None, ["solo"]]


def test_split_list_literal_separator(spark):
    # '|' is a regex metacharacter; it must split literally
    assert one_col(spark, ["a|b"], lambda c: mf.split_list(c, "|")) == [["a", "b"]]
    assert one_col(spark, ["a.b"], lambda c: mf.split_list(c, ".")) == [["a", "b"]]


def test_split_or_empty(spark):
    got = one_col(spark, [None, "", "a,b"], lambda c: mf.split_list_or_empty(c, ","))
    assert got == [[""], [""], ["a", "b"]]


def test_first_element(spark):
    got = one_col(spark, ["A,B", "y,", ",z", None], lambda c: mf.first_or_null(mf.split_list(c, ",")))
    assert got == ["A", "y", None, None]
    df = spark.createDataFrame([([],), (None,), (["", "b"],), (["a"],)], "v array<string>")
    assert [r[0] for r in df.select(mf.first_or("v", "unknown")).collect()] == ["unknown", "unknown", "unknown", "a"]


def test_decade(spark):
    assert one_col(spark, [1994, None, 2000, -15, 9], mf.decade_of, "int") == [1990, None, 2000, -10, 0]


def test_out_of_range(spark):
    got = one_col(spark, [0, 255, 256, -1, None], lambda c: mf.out_of_range(c, "uint8"), "int")
    assert got == [False, False, True, True, False]


def test_readable_size(spark):
    got = one_col(spark, [0, 1023, 1024, 1536, 5 * 1024 ** 3], mf.readable_size, "long")
    assert got == ["0.00 B", "1023.00 B", "1.00 KiB", "1.50 KiB", "5.00 GiB"]


def test_integer_division_goes_toward_zero(spark):
    from mediamart.functions import int_div
    df = spark.createDataFrame([(1994,), (-15,), (9,), (-9,), (0,), (None,), (2147483647,), (-2147483648,)], "y int")
    got = df.select(int_div("y", 10).alias("q"), int_div("y", 0).alias("none"))
    assert got.dtypes == [("q", "int"), ("none", "int")]
    assert [r.q for r in got.collect()] == [199, -1, 0, 0, 0, None, 214748364, -214748364]
    assert all(r.none is None for r in got.collect())

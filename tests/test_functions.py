"""Column helpers on hand-made rows (edge cases of FIXTURES.md section 2)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portolan.functions import (clean_label, convert_day_numbers, convert_types, date_difference,
                                date_parts, drop_columns, iso_date, refactor_values, rename_columns,
                                title_case)


def test_convert_types_lenient_and_absent_columns(spark):
    df = spark.createDataFrame([("5.0", 7.9, "x"), ("abc", None, "y"), ("99999999999", -2.5, "z")],
                               "a string, b double, c string")
    out = convert_types(df, {"a": "int", "b": "int", "count": "int"})
    assert out.columns == ["a", "b", "c"]
    assert [tuple(r) for r in out.collect()] == [(5, 7, "x"), (None, None, "y"), (None, -2, "z")]
    assert dict(out.dtypes) == {"a": "int", "b": "int", "c": "string"}


def test_day_numbers_to_iso(spark):
    df = spark.createDataFrame([(20545.0, None), (0.0, 20546.0)], "arrdate double, depdate double")
    out = convert_day_numbers(df, ["arrdate", "depdate", "missing"]).collect()
    assert [tuple(r) for r in out] == [("2016-04-01", None), ("1960-01-01", "2016-04-02")]


def test_date_difference_signed_and_null_safe(spark):
    rows = [("2016-04-01", "2016-04-01"), ("2016-04-06", "2016-04-01"), ("2016-04-01", None),
            (None, "2016-04-02"), ("2016-04-01", "2016-05-01")]
    df = spark.createDataFrame(rows, "arr string, dep string")
    got = [r[0] for r in df.select(date_difference(F.col("arr"), F.col("dep"))).collect()]
    assert got == [0, -5, None, None, 30]


def test_date_parts_sunday_is_one_and_iso_week(spark):
    df = spark.createDataFrame([("2016-04-03",), ("2016-01-01",)], "d string")
    parts = date_parts(iso_date(F.col("d")))
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in parts.items()]).collect()]
    assert got == [(2016, 4, 3, 13, 1), (2016, 1, 1, 53, 6)]


def test_title_case_examples(spark):
    words = ["ANTIGUA-BARBUDA", "PEOPLE'S REP", "1ST STREET", "st. kitts", "", "ÉCOLE d'été", "中a", None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(title_case(F.col("w"))).collect()]
    assert got == [None if w is None else w.title() for w in words]


ALPHABET = st.sampled_from(list("abcXYZ qQ'-.,#1209éÉàÀñÑöÖçÇ()/&") + ["中", "\t"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=20), min_size=50, max_size=120))
def test_title_case_matches_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", title_case(F.col("t"))).collect())
    assert [got[i] for i in range(len(texts))] == [t.title() for t in texts]


def test_clean_label_replaces_no_break_space(spark):
    df = spark.createDataFrame([("NEW\u00a0YORK",)], "s string")
    assert df.select(title_case(clean_label(F.col("s")))).first()[0] == "New York"


def test_refactor_values_sequential_and_ignores_absent(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "v string")
    rules = [("v", "a", "b"), ("v", "b", "c"), ("missing", "x", "y")]
    assert [r[0] for r in refactor_values(df, rules).collect()] == ["c", "c", "c", None]


def test_refactor_values_many_rules_stay_linear(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(40)], "v string")
    rules = [("v", f"k{i}", f"k{i + 1}") for i in range(39)]  # every value chains to k39
    assert {r[0] for r in refactor_values(df, rules).collect()} == {"k39"}


def test_rename_and_drop_ignore_absent_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert rename_columns(df, {"a": "x", "zz": "y"}).columns == ["x", "b", "c"]
    assert drop_columns(df, ["b", "nope"], "zz").columns == ["a", "c"]


def test_iso_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("2016-13-40",), ("nope",), ("2016-02-29",)], "s string")
    assert [r[0] for r in df.select(iso_date(F.col("s"))).collect()] == [None, None, dt.date(2016, 2, 29)]

"""Aggregations, joins and quality reports on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from portolan.operators import (DataQualityError, duplicate_key_report, first_values, null_key_report,
                                orphan_report, pivot_sum, raise_on_failure, row_count_report,
                                sql_check_report, sum_by, two_level_mean)
from portolan.operators.joins import unique_on


def test_first_values_by_order_and_nonnull(spark):
    df = spark.createDataFrame([("x", 3, None, "c"), ("x", 1, None, "a"), ("x", 2, 20, "b"), ("y", 5, 7, None)],
                               "k string, seq int, v int, w string")
    firsts = {r.k: (r.V, r.W) for r in first_values(df, ["k"], {"v": "V", "w": "W"}, F.col("seq")).collect()}
    assert firsts == {"x": (None, "a"), "y": (7, None)}
    nonnull = {r.k: (r.V, r.W) for r in
               first_values(df, ["k"], {"v": "V", "w": "W"}, F.col("seq"), ignore_nulls=True).collect()}
    assert nonnull == {"x": (20, "a"), "y": (7, None)}


def test_pivot_sum_fixed_schema_and_fill(spark):
    df = spark.createDataFrame([("c1", "White", 5), ("c1", "White", 1), ("c2", "Asian", 3)],
                               "city string, race string, n int")
    races = {"White": "White", "Asian": "Asian", "Other": "Other"}
    rows = {r.city: tuple(r)[1:] for r in pivot_sum(df, ["city"], "race", races, "n").collect()}
    assert rows == {"c1": (6, None, None), "c2": (None, 3, None)}
    filled = {r.city: tuple(r)[1:] for r in pivot_sum(df, ["city"], "race", races, "n", fill=0).collect()}
    assert filled == {"c1": (6, 0, 0), "c2": (0, 3, 0)}


def test_sum_by_and_two_level_mean(spark):
    df = spark.createDataFrame([("A", "a1", "1.0"), ("A", "a1", "3.0"), ("A", "a2", "10"), ("B", "b", None)],
                               "country string, city string, t string")
    means = {r.country: (r.mean, r.n_inner) for r in two_level_mean(df, "country", "city", "t").collect()}
    assert means == {"A": (6.0, 2), "B": (None, 1)}
    nums = spark.createDataFrame([("s", 1, 2), ("s", 3, None)], "k string, a int, b int")
    assert [tuple(r) for r in sum_by(nums, ["k"], ["a", "b"]).collect()] == [("s", 4, 2)]


def test_quality_reports_list_every_failure(spark):
    empty = spark.createDataFrame([], "Code int")
    with_null = spark.createDataFrame([(1,), (None,)], "Code int")
    nulls = {r.table: r.passed for r in null_key_report({"a": (with_null, "Code"), "b": (empty, "Code")}).collect()}
    assert nulls == {"a": False, "b": True}
    counts = row_count_report({"a": with_null, "b": empty})
    with pytest.raises(DataQualityError) as err:
        raise_on_failure(counts)
    assert "'b'" in str(err.value)
    with pytest.raises(DataQualityError) as err:
        raise_on_failure(null_key_report({"a": (with_null, "Code"), "c": (with_null, "Code")}))
    assert "'a'" in str(err.value) and "'c'" in str(err.value)


def test_sql_check_report(spark):
    spark.createDataFrame([(1,), (None,)], "Code int").createOrReplaceTempView("qc_country")
    report = sql_check_report(spark, [
        {"check_sql": "SELECT COUNT(*) FROM qc_country WHERE Code is null", "expected_result": 0},
        {"check_sql": "SELECT COUNT(*) FROM qc_country", "expected_result": 2},
    ])
    assert [(r.result, r.passed) for r in report.collect()] == [("1", False), ("2", True)]


def test_sql_checks_compare_as_given(spark):
    checks = [("SELECT 0.5", 0, False), ("SELECT 0.5", 0.5, True), ("SELECT 1 WHERE false", 0, False),
              ("SELECT 1 WHERE false", None, False), ("SELECT CAST(NULL AS INT)", 0, False), ("SELECT CAST(NULL AS INT)", None, True),
              ("SELECT 'x'", 0, False), ("SELECT 'x'", "x", True), ("SELECT 2.0D AS a, 3 AS a", 2, True), ("SELECT true", 1, False),
              ("SELECT true", True, True), ("SELECT 9007199254740993", 9007199254740992, False)]
    report = sql_check_report(spark, [{"check_sql": s, "expected_result": e} for s, e, _ in checks])
    assert [r.passed for r in report.collect()] == [p for _, _, p in checks]


def test_pivot_loss_and_cast_loss(spark):
    from portolan.operators import cast_loss_report, pivot_loss_report
    df = spark.createDataFrame([("White", 5), ("Two or more", 2), (None, 1)], "race string, n int")
    r = pivot_loss_report(df, "race", {"White": "White"}, "n").first()
    assert (r.measure_total, r.pivot_total, r.lost_values, r.passed) == (8, 5, "Two or more, null", False)
    assert pivot_loss_report(df.limit(1), "race", {"White": "White"}, "n").first().passed
    raw = spark.createDataFrame([(3e9, "x"), (None, None), (5.0, "7")], "a double, b string")
    lost = {r.column: (r.lost, r.passed) for r in cast_loss_report(raw, {"a": "int", "b": "int", "zz": "int"}).collect()}
    assert lost == {"a": (1, False), "b": (1, False)}
    assert {r.lost for r in cast_loss_report(raw, {"a": "bigint"}).collect()} == {0}


def test_first_values_without_order_do_not_follow_the_input(spark):
    rows = [("k", None, 7), ("k", 7, None), ("k", 3, 3)]
    got = {tuple(first_values(spark.createDataFrame(r, "k string, a int, b int").coalesce(1), ["k"], {"a": "A", "b": "B"}).first())
           for r in (rows, rows[::-1])}
    assert got == {("k", None, 7)}


def test_duplicates_and_orphans(spark):
    fact = spark.createDataFrame([(1, "AL"), (1, "ZZ"), (2, None), (3, "AL")], "id int, st string")
    dim = spark.createDataFrame([("AL",), ("AL",), ("AK",)], "Code string")
    dups = {r.table: (r.duplicate_keys, r.duplicate_rows)
            for r in duplicate_key_report({"f": (fact, "id"), "d": (dim, "Code")}).collect()}
    assert dups == {"f": (1, 2), "d": (1, 2)}
    orphans = {r.relationship: r.orphans for r in orphan_report(fact, [("state", "st", dim, "Code")]).collect()}
    assert orphans == {"state": 1}


def test_unique_on(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, v string")
    assert sorted(tuple(r) for r in unique_on(df, "k").collect()) == [(1, "a"), (2, "c")]


def test_lookup_join_and_decode_with_spaced_names(spark):
    from portolan.operators.joins import decode, lookup_join
    df = spark.createDataFrame([(1, "AL"), (2, "ZZ")], "id int, `State Code` string")
    lookup = spark.createDataFrame([("AL", "Alabama", 5)], "`Code` string, `State Name` string, n int")
    joined = {r.id: (r["l_State Name"], r.l_n) for r in
              lookup_join(df, lookup, "State Code", "Code", prefix="l_").collect()}
    assert joined == {1: ("Alabama", 5), 2: (None, None)}
    decoded = {r.id: r.name for r in decode(df, "State Code", lookup, "Code", "State Name", "name").collect()}
    assert decoded == {1: "Alabama", 2: None}

"""Property tests: operators against plain-Python definitions on random inputs, and
invariants of the jobs on the test tables."""

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portolan import fixtures as fx
from portolan.functions import refactor_values
from portolan.operators import pivot_sum
from portolan.plans import immigration
from tests.conftest import SF_SMALL

VALUES = st.sampled_from(["a", "b", "c", "d", None])


@settings(max_examples=6, deadline=None)
@given(st.lists(VALUES, min_size=1, max_size=30),
       st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from("abcd")), max_size=8))
def test_refactor_values_equals_rule_by_rule(spark, values, rules):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = dict(refactor_values(df, [("v", old, new) for old, new in rules]).collect())

    def apply(v):
        for old, new in rules:
            v = new if v == old else v
        return v
    assert [got[i] for i in range(len(values))] == [apply(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.sampled_from(["x", "y", "z", "w"]),
                          st.integers(-5, 50) | st.none()), min_size=1, max_size=40))
def test_pivot_sum_equals_python(spark, rows):
    df = spark.createDataFrame(rows, "k string, p string, n int")
    got = {r.k: (r.X, r.Y, r.Z) for r in pivot_sum(df, ["k"], "p", {"x": "X", "y": "Y", "z": "Z"}, "n").collect()}
    want = defaultdict(lambda: [None, None, None])
    for k, p, n in rows:
        want[k]
        if p in "xyz" and n is not None:
            slot = "xyz".index(p)
            want[k][slot] = (want[k][slot] or 0) + n
    assert got == {k: tuple(v) for k, v in want.items()}


def test_fact_keeps_every_row_and_stay_is_signed_days(spark):
    raw = fx.visits_raw(spark, SF_SMALL)
    fact = immigration.immigration_facts(raw)
    assert fact.count() == raw.count()
    days = F.datediff(F.to_date("depdate"), F.to_date("arrdate"))
    bad = fact.where((F.col("depdate").isNotNull() & (F.col("stay") != days))
                     | (F.col("depdate").isNull() & F.col("stay").isNotNull()))
    assert bad.count() == 0
    assert fact.where(F.col("stay") < 0).count() > 0  # departures before arrivals stay signed


def test_date_dimension_key_unique_and_covers_fact(spark):
    fact = immigration.immigration_facts(fx.visits_raw(spark, SF_SMALL))
    dates = immigration.date_dimension(fact)
    assert dates.count() == dates.select("date").distinct().count()
    days = fact.select(F.explode(F.array("arrdate", "depdate")).alias("d")).where("d IS NOT NULL").distinct()
    assert days.join(dates, days.d == dates.date, "left_anti").count() == 0


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(-20000, 40000) | st.none(), st.integers(-20000, 40000) | st.none()),
                min_size=1, max_size=40))
def test_day_numbers_and_differences_match_python(spark, pairs):
    import datetime as dt

    from portolan.functions import date_difference, day_number_to_iso
    epoch = dt.date(1960, 1, 1)
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a int, b int")
    iso = df.select("i", day_number_to_iso(F.col("a")).alias("a"), day_number_to_iso(F.col("b")).alias("b"))
    got = {r.i: (r.a, r.b, r.d) for r in iso.select("i", "a", "b", date_difference(F.col("a"), F.col("b")).alias("d")).collect()}

    def iso_of(n):
        return None if n is None else (epoch + dt.timedelta(days=n)).isoformat()
    want = {i: (iso_of(a), iso_of(b), None if a is None or b is None else b - a) for i, (a, b) in enumerate(pairs)}
    assert got == want

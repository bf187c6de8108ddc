"""Casts without exceptions, rejects in the writing pass, late strings and files in order of a column."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portolan.functions.columns import convert_types, lenient_cast, rejected_values
from portolan.operators import DataQualityError
from portolan.operators.aggregate import mean_and_first
from portolan.plans import countries, immigration, landing
from portolan.plans.build import REJECTS, build_warehouse, rejected_arrivals
from portolan.session import scratch_path
from tests.test_build import _write_sources
from tests.test_jobs import _raw, _row

TEXTS = ["5", "5.0", " 7 ", "\t8\n", "-3.9", "+4", "1e3", "1E-2", ".5", "5.", "", " ", "x", "Brand#12", "12a", "1 2", "1,000", "NaN", "Infinity", "-inf", "0x10", "0x1p3",
         "5d", "5f", "5D", "--5", "+-5", "e5", "1e", "2147483647", "2147483648", "-2147483648", "-2147483649", "2147483647.9", "9223372036854775807",
         "9223372036854775808", "1e400", "١٢", "½", "\x0012", "5 ", "null", "true", "1_000", "127", "128", "-129", "32768"]
NUMBERS = [0.0, -0.0, 2147483647.0, 2147483647.9, 2147483648.0, -2147483648.9, -2147483649.0, 9.223372036854775e18, 9.3e18, -9.3e18, 1e300, float("nan"),
           float("inf"), float("-inf"), 127.5, 128.0, -128.9, -129.0, None]


def _old(column, source, target):
    if isinstance(source, T.StringType):
        return F.coalesce(column.try_cast(target), column.try_cast("double").try_cast(target))
    return column.try_cast(target)


@pytest.mark.parametrize("kind", ["string", "double", "float", "bigint", "int"])
def test_lenient_cast_equals_trying(spark, kind):
    rng = random.Random(3)
    rows = [*TEXTS, None, *["".join(rng.choice("0123456789+-.eExpd \t") for _ in range(rng.randint(1, 6))) for _ in range(600)]] if kind == "string" else \
        NUMBERS if kind in ("double", "float") else [0, 1, -1, 127, 128, -128, -129, 32767, 32768, 2**31 - 1, -2**31, None, *([2**31, 2**63 - 1, -2**63] if kind == "bigint" else [])]
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    source = df.schema["x"].dataType
    for target in (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()):
        bad = df.select("x", lenient_cast(F.col("x"), source, target).alias("a"), _old(F.col("x"), source, target).alias("b")).where("NOT a <=> b").collect()
        assert bad == []


def test_rejects_name_every_lost_value(spark):
    df = spark.createDataFrame([(1, "5", 1.0), (2, "x", 3e9), (3, None, None), (4, "7e11", 2.0)], "k int, a string, b double")
    done = convert_types(df, {"a": "int", "b": "int", "zz": "int"}, rejects="_rejects")
    assert {r.k: (r.a, r.b) for r in done.collect()} == {1: (5, 1), 2: (None, None), 3: (None, None), 4: (None, 2)}
    assert done.where("k = 1 OR k = 3").where("_rejects IS NOT NULL").count() == 0
    assert sorted(map(tuple, rejected_values(done, "k", "_rejects").collect())) == [
        (2, "a", "x", "not a number"), (2, "b", "3.0E9", "out of range"), (4, "a", "7e11", "out of range")]
    assert rejected_values(convert_types(df, {}, rejects="r"), "k", "r").count() == 0


def test_keys_are_counted_while_the_fact_is_written(spark):
    """Every source row is read once, with a partitioned write and the check of the keys."""
    seen = spark.sparkContext.accumulator(0)

    def look(gender):
        seen.add(1)
        return gender

    raw = _raw(spark, [_row(float(i), 20545.0, 20550.0) for i in range(20)] + [_row(30.0, 1e12, None)])
    watched = raw.withColumn("gender", F.udf(look, "string").asNondeterministic()("gender"))
    path = scratch_path(spark, "fact")
    immigration.process_immigration(watched, path, date_output_path=f"{path}-date", rejects="_rejects", must_keep=["cicid"])
    assert seen.value == 21
    lost = rejected_values(spark.read.parquet(path), "cicid", "_rejects").collect()
    assert [tuple(r) for r in lost] == [(30, "arrdate", "1.0E12", "out of range")]
    bad = _raw(spark, [_row(1.0, 20545.0, None), _row(1e30, 20545.0, None)])
    with pytest.raises(DataQualityError, match="'cicid': 1"):
        immigration.process_immigration(bad, path, rejects="_rejects", must_keep=["cicid", "i94yr"])


def test_build_keeps_the_rejects_of_a_delivery(spark, tmp_path):
    sources = _write_sources(spark, tmp_path)
    out = scratch_path(spark, "build-rejects")
    raw = spark.read.parquet(sources.immigration).withColumn("i94bir", F.lit(1e11))
    odd = scratch_path(spark, "odd-arrivals")
    raw.write.parquet(odd)
    report = build_warehouse(spark, type(sources)(**{**sources.__dict__, "immigration": odd}), out, "wh_rejects")
    assert {r.table: r.n_rows for r in report.collect()}["immigration"] == 2
    assert sorted(tuple(r) for r in rejected_arrivals(spark, out).collect()) == [(i, "i94bir", "1.0E11", "out of range") for i in (1, 2)]
    assert REJECTS not in spark.table("wh_rejects.immigration").columns


def test_no_sort_aggregation_of_source_rows(spark):
    path = scratch_path(spark, "temps")
    spark.range(2000).select((F.col("id") % 7).cast("string").alias("Country"), (F.col("id") % 13).cast("string").alias("Latitude"), F.lit("1E").alias("Longitude"),
                             F.col("id").cast("string").alias("AverageTemperature"), F.col("id").alias("seq")).write.parquet(path)
    temps = spark.read.parquet(path)
    for order in (None, F.col("seq")):
        df = countries.country_climate(temps, order_by=order)
        plan = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
        above = [line.strip(" +-:").split("(")[0] for line in plan[:scan]]
        # Upwards from the scan: hash aggregations over text keys first; only their rows meet a sort aggregation.
        kinds = [k for k in reversed(above) if k.endswith("Aggregate")]
        assert kinds[0] == kinds[1] == "HashAggregate" and "SortAggregate" in kinds
        rows = {r.Country: tuple(r)[1:] for r in df.collect()}
        lows = {str(c): min((i for i in range(2000) if i % 7 == c), key=lambda i: (i if order is not None else str(i % 13))) for c in range(7)}
        assert rows == {c: (sum(i for i in range(2000) if i % 7 == int(c)) / len(range(int(c), 2000, 7)), str(i % 13), "1E") for c, i in lows.items()}


def test_mean_and_first_of_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", "1", "x", "p", 1), ("a", "2", None, "q", 1), ("a", "z", "w", None, 2), ("b", None, "x", "y", None), (None, "4", "m", "n", 3)],
                               "k string, v string, f string, g string, o int")
    got = {r.k: tuple(r)[1:] for r in mean_and_first(df, "k", "v", ["f", "g"], F.col("o")).collect()}
    assert got == {"a": (1.5, None, "q"), "b": (None, None, None), None: (4.0, "m", "n")}
    got = {r.k: tuple(r)[1:] for r in mean_and_first(df, "k", "v", ["f", "g"], F.col("o"), ignore_nulls=True).collect()}
    assert got == {"a": (1.5, "x", "q"), "b": (None, None, None), None: (4.0, "m", "n")}
    got = {r.k: tuple(r)[1:] for r in mean_and_first(df, "k", "v", ["f", "g"]).collect()}
    assert got == {"a": (1.5, None, "q"), "b": (None, "x", "y"), None: (4.0, "m", "n")}


def test_a_city_stands_in_few_files(spark, tmp_path):
    """Thousands of rows of 60 cities in 2 countries; one city holds a third of all."""
    rows = [f"2000-{1 + i % 12:02d}-{1 + i % 28:02d},{i}.5,City{0 if i % 3 == 0 else i % 60},{'AB'[i % 2]},1N,2E" for i in range(6000)]
    (tmp_path / "t.csv").write_text("dt,AverageTemperature,City,Country,Latitude,Longitude\n" + "\n".join(rows))
    out = scratch_path(spark, "city")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        landing.process_temperature(spark, str(tmp_path / "t.csv"), out)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    landed = spark.read.parquet(out)
    assert landed.count() == 6000 and len(landed.inputFiles()) >= 20
    where = landed.withColumn("file", F.input_file_name()).groupBy("Country", "City").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))
    files = {(r.Country, r.City): (r.files, r.n) for r in where.collect()}
    assert all(k <= 2 for (_, city), (k, _) in files.items() if city != "City0")
    assert all(2 <= k <= 8 for (_, city), (k, _) in files.items() if city == "City0")  # spread, not in one task

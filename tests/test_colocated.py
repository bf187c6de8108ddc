"""Large dimensions: no exchange of the fact, no null and no hot key in a bucket."""

import uuid

import pytest
from pyspark.sql import functions as F

from portolan.operators.colocated import hot_keys, join_colocated, read_colocated, save_colocated
from portolan.session import scratch_path


@pytest.fixture(scope="module")
def stored(spark):
    database, location = f"colocated_{uuid.uuid4().hex[:8]}", scratch_path(spark, "colocated-test")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 10 == 1, None).when(i % 11 == 2, i + 10**6).otherwise(i % 500)
    fact = spark.range(6000).select(i.alias("row"), key.alias("k"))
    dim = spark.range(450).select(i.alias("code"), F.concat(F.lit("n"), i.cast("string")).alias("name"))
    save_colocated(fact, f"{database}.fact", "k", 4, location)
    save_colocated(dim, f"{database}.dim", "code", 4, location, dimension=True)
    yield f"{database}.fact", f"{database}.dim", fact, dim
    spark.sql(f"DROP DATABASE {database} CASCADE")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_same_rows_as_a_plain_join(spark, stored, how):
    fact_table, dim_table, fact, dim = stored
    columns = [] if how == "left_anti" else ["name"]
    got = join_colocated(spark, fact_table, dim_table, "k", "code", columns, how)
    want = fact.join(dim, fact.k == dim.code, how).drop("code")
    if how == "left_anti":
        want = want.where("k IS NOT NULL")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_no_exchange_beyond_the_broadcast_threshold(spark, stored):
    fact_table, dim_table, _, _ = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = join_colocated(spark, fact_table, dim_table, "k", "code", ["name"])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    # The one broadcast is that of the dimension's rows of hot keys.
    assert plan.count("BroadcastExchange") <= 2 and "Bucketed: true" in plan


def test_hot_and_null_keys_stand_apart(spark, stored):
    fact_table, _, fact, _ = stored
    assert hot_keys(spark, fact_table) == [7]
    cold = spark.table(fact_table)
    assert cold.where("k IS NULL OR k = 7").count() == 0
    assert cold.groupBy("k").count().agg(F.max("count")).first()[0] < 60
    assert sorted(map(repr, read_colocated(spark, fact_table).collect())) == sorted(map(repr, fact.collect()))


def test_a_dimension_has_one_row_a_key(spark, stored):
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "code long, name string")
    with pytest.raises(ValueError, match="occurs 2 times"):
        save_colocated(rows, f"{stored[0].split('.')[0]}.twice", "code", 2, scratch_path(spark, "twice"), dimension=True)
    with pytest.raises(ValueError, match="how"):
        join_colocated(spark, *stored[:2], "k", "code", ["name"], "full")

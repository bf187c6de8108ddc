"""Findings of round 4: shuffles of a large delivery are made and freed in rounds."""

from pyspark.sql import functions as F

from portolan import fixtures, schemas
from portolan.operators.merge import merge_deliveries
from portolan.session import scratch_path
from portolan.sources import versions
from portolan.sources.io import read_partitioned
from portolan.streaming import ingest_deliveries, monthly
from tests.conftest import SF_SMALL
from tests.test_jobs import _raw, _row


def test_months_of_a_large_batch_are_merged_in_rounds_and_published_once(spark, monkeypatch):
    landing, fact = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    year = _raw(spark, [_row(float(10 * m + i), 20545.0, 20550.0, mon=m and float(m)) for m in (1, 2, 3, 4, 5) for i in range(3)]
                + [_row(99.0, 20545.0, None, mon=None), _row(None, 20545.0, None, mon=2.0)])
    monkeypatch.setattr(monthly, "ROUND_ROWS", 4)
    wrote = []
    write = versions.write_version
    monkeypatch.setattr(versions, "write_version", lambda df, *a: wrote.append(1) or write(df, *a))
    year.coalesce(1).write.parquet(f"{landing}/first")
    ingest_deliveries(spark, landing, fact, year.schema)
    assert len(wrote) > 2 and versions.current(spark, fact).number == 1
    year.where("cicid % 10 = 1").withColumn("depdate", F.lit(20555.0)).coalesce(1).write.parquet(f"{landing}/again")
    year.where("i94mon = 3 AND cicid = 30").coalesce(1).write.parquet(f"{landing}/march-complete")
    ingest_deliveries(spark, landing, fact, year.schema)
    rows = sorted(((r.i94mon, r.cicid, r.stay) for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect()), key=str)
    other = [(m, 10 * m + i, 10 if i == 1 else 5) for m in (1, 2, 4, 5) for i in range(3)]
    assert rows == sorted([*other, (3, 30, 5), (2, None, None), (None, 99, None)], key=str)


def test_rounds_hold_every_month_once(monkeypatch):
    monkeypatch.setattr(monthly, "ROUND_ROWS", 10)
    for counts in ([], [1], [50], [9, 1, 1, 30, 2], [3] * 84):
        months = [{"count": n, "month": k} for k, n in enumerate(counts)]
        rounds = [*monthly.rounds_of_months(months)]
        assert [m for r in rounds for m in r] == months and len(rounds) <= 2 * monthly.MOST_ROUNDS


def test_rows_of_a_delivery_are_not_shuffled_to_meet_its_months(spark):
    """The join with the deliveries and the one with the complete months shuffled every row once more."""
    incoming = spark.range(9).selectExpr("id AS k", "id % 2 AS y", "concat('a', id % 3) AS _delivery", "timestamp_seconds(id % 3) AS _arrived",
                                          "id % 3 = 1 AS _complete")
    existing = spark.range(9).selectExpr("id AS k", "id % 2 AS y")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merge_deliveries(existing, incoming, "k", ["y"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") >= 2 and "NestedLoop" not in plan


def test_rounds_of_the_arrivals_make_the_whole(spark):
    whole = fixtures.visits_raw_view(spark, SF_SMALL)
    parts = [fixtures.visits_raw_view(spark, SF_SMALL, turn, 3) for turn in range(3)]
    assert all(p.count() for p in parts) and parts[0].union(parts[1]).union(parts[2]).exceptAll(whole).isEmpty()
    assert sum(p.count() for p in parts) == whole.count()

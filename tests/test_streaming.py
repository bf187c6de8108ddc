"""The delivery stream: each delivery file becomes fact rows exactly once."""

import pytest

from portolan import schemas
from portolan.session import scratch_path
from portolan.sources.io import read_partitioned
from portolan.streaming import ingest_deliveries
from tests.test_jobs import _raw, _row


def test_new_delivery_is_ingested_once(spark):
    landing, fact, ckpt = (scratch_path(spark, n) for n in ("landing", "fact", "ckpt"))
    april = _raw(spark, [_row(1.0, 20545.0, 20550.0), _row(2.0, 20546.0, None)])
    april.coalesce(1).write.mode("append").parquet(landing)
    ingest_deliveries(spark, landing, fact, april.schema, ckpt)
    assert read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).count() == 2
    may = _raw(spark, [_row(3.0, 20577.0, 20580.0, mon=5.0)])
    may.coalesce(1).write.mode("append").parquet(landing)  # a new file next to the old one
    ingest_deliveries(spark, landing, fact, april.schema, ckpt)
    ingest_deliveries(spark, landing, fact, april.schema, ckpt)  # nothing new: no change
    rows = {r.cicid: (r.i94mon, r.stay) for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect()}
    assert rows == {1: (4, 5), 2: (4, None), 3: (5, 3)}


def test_default_call_redelivery_and_several_files(spark):
    landing, fact = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    april = _raw(spark, [_row(float(i), 20545.0, 20550.0) for i in range(8)])
    april.repartition(4).write.mode("append").parquet(landing)  # a month in several files
    ingest_deliveries(spark, landing, fact, april.schema)
    _raw(spark, [_row(9.0, 20577.0, None, mon=5.0)]).coalesce(1).write.mode("append").parquet(landing)
    ingest_deliveries(spark, landing, fact, april.schema)  # no checkpoint given: the second run adds May
    back = lambda: sorted(r.cicid for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect())
    assert back() == [*range(8), 9]
    april.coalesce(1).write.mode("append").parquet(landing)  # April again: replaced, not doubled
    ingest_deliveries(spark, landing, fact, april.schema)
    assert back() == [*range(8), 9]


def test_run_once_refuses_polling(spark):
    with pytest.raises(ValueError):
        ingest_deliveries(spark, "unused", "unused", schemas.IMMIGRATION_TABLE, every="1 minute")


def _deliver(df, landing, name):
    df.coalesce(1).write.parquet(f"{landing}/{name}")


def test_month_in_two_files_over_two_runs_keeps_all_rows(spark):
    landing, fact = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    first = _raw(spark, [_row(float(i), 20545.0, 20550.0) for i in range(5)])
    _deliver(first, landing, "april-1")
    ingest_deliveries(spark, landing, fact, first.schema)
    # The second piece corrects row 4, adds two, and holds a row without a key.
    second = _raw(spark, [_row(4.0, 20545.0, 20547.0), _row(5.0, 20546.0, None), _row(6.0, 20546.0, None), _row(None, 20546.0, None)])
    _deliver(second, landing, "april-2")
    ingest_deliveries(spark, landing, fact, first.schema)
    rows = read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect()
    assert sorted(r.cicid for r in rows if r.cicid is not None) == list(range(7)) and len(rows) == 8
    assert {r.cicid: r.stay for r in rows}[4] == 2
    # The first piece once more is an older state of row 4 that arrives later: the delivery wins.
    _deliver(first.where("cicid = 4"), landing, "april-3")
    ingest_deliveries(spark, landing, fact, first.schema)
    assert {r.cicid: r.stay for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect()}[4] == 5


def test_complete_delivery_replaces_its_month(spark):
    landing, fact = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    april = _raw(spark, [_row(float(i), 20545.0, 20550.0) for i in range(5)])
    may = _raw(spark, [_row(9.0, 20577.0, None, mon=5.0)])
    _deliver(april, landing, "april-1")
    _deliver(may, landing, "may-1")
    ingest_deliveries(spark, landing, fact, april.schema)
    back = lambda: sorted(r.cicid for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).collect())
    assert back() == [0, 1, 2, 3, 4, 9]
    # A corrected April in two files of one marked folder: rows 0 and 1 are withdrawn.
    april.where("cicid >= 2").repartition(2).write.parquet(f"{landing}/april-complete")
    ingest_deliveries(spark, landing, fact, april.schema)
    assert back() == [2, 3, 4, 9]


def test_pieces_and_complete_deliveries_of_one_batch_apply_in_order(spark):
    import time
    landing, fact = scratch_path(spark, "landing"), scratch_path(spark, "fact")
    for name, rows in (("a", [_row(1.0, 20545.0, 20550.0), _row(2.0, 20545.0, None)]), ("b.complete", [_row(2.0, 20545.0, 20546.0), _row(3.0, 20545.0, None)]),
                       ("c", [_row(3.0, 20545.0, 20549.0), _row(4.0, 20545.0, None), _row(4.0, 20545.0, None)])):
        _deliver(_raw(spark, rows), landing, name)
        time.sleep(0.05)
    ingest_deliveries(spark, landing, fact, _raw(spark, []).schema)
    rows = sorted((r.cicid, r.stay) for r in read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).fillna(-1, ["stay"]).collect())
    assert rows == [(2, 1), (3, 4), (4, -1), (4, -1)]  # a key that a delivery repeats is left for the checks


def test_published_batch_is_not_applied_twice(spark):
    from portolan.operators.merge import ARRIVED, COMPLETE, DELIVERY
    from portolan.plans.immigration import immigration_facts
    from portolan.streaming.monthly import apply_batch
    from pyspark.sql import functions as F
    fact = scratch_path(spark, "fact")
    batch = immigration_facts(_raw(spark, [_row(None, 20545.0, 20550.0), _row(1.0, 20545.0, None)])).withColumns(
        {DELIVERY: F.lit("f"), ARRIVED: F.current_timestamp(), COMPLETE: F.lit(False)})
    args = (fact, "cicid", ["i94yr", "i94mon"], schemas.IMMIGRATION_TABLE, "stream")
    assert apply_batch(batch, *args, 0) and not apply_batch(batch, *args, 0)
    assert read_partitioned(spark, fact, schemas.IMMIGRATION_TABLE).count() == 2

"""The warehouse load is all or nothing, reads only what was delivered, and keeps what it needs of other months."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from portolan import schemas
from portolan.operators import DataQualityError
from portolan.plans import analytics, immigration, rollups, warehouse
from portolan.session import scratch_path
from portolan.sources import versions
from tests.test_jobs import _raw, _row

COUNTRY = [(101, "Albania", 12.0, "41N", "20E"), (102, "Austria", 7.5, "48N", "16E")]
STATES = [("NY", "New York", *range(10)), ("CA", "California", *range(10, 20))]


def _fact(spark, *rows):
    return immigration.immigration_facts(_raw(spark, rows))


def _tables(spark, fact):
    return {"immigration": fact, "country": spark.createDataFrame(COUNTRY, schemas.COUNTRY_TABLE),
            "states": spark.createDataFrame(STATES, schemas.STATES_TABLE), "date": lambda load: load.answers().date_dimension()}


def _load(spark, name, location, fact, **kwargs):
    report = warehouse.warehouse_load(spark, name, location, _tables(spark, fact), **kwargs)
    return {r.table: (r.n_rows, r.null_keys) for r in report.collect()}


def _ids(spark, name):
    return sorted((r.cicid for r in spark.table(f"{name}.immigration").collect()), key=repr)


APRIL, MAY = (_row(1.0, 20545.0, 20550.0), _row(2.0, 20546.0, None)), (_row(3.0, 20576.0, 20580.0, mon=5.0),)


def test_failing_check_leaves_the_warehouse_as_it_was(spark):
    location = scratch_path(spark, "wh")
    assert _load(spark, "pub_a", location, _fact(spark, *APRIL)) == {"immigration": (2, 0), "country": (2, 0), "states": (2, 0), "date": (3, 0)}
    files = set(glob.glob(f"{location}/**/*.parquet", recursive=True))
    before = {t: sorted(map(tuple, spark.table(f"pub_a.{t}").collect()), key=repr) for t in schemas.WAREHOUSE_TABLES}
    bad = _fact(spark, *MAY, _row(None, 20577.0, None, mon=5.0))
    broken = {"check_sql": "SELECT COUNT(*) FROM immigration JOIN country ON i94res = Code WHERE i94mon = 4", "expected_result": 3}
    for fact, checks in ((bad, schemas.NULL_KEY_CHECKS), (_fact(spark, *MAY), [*schemas.NULL_KEY_CHECKS, broken])):
        with pytest.raises(DataQualityError):
            _load(spark, "pub_a", location, fact, checks=checks)
        for t, rows in before.items():
            assert sorted(map(tuple, spark.table(f"pub_a.{t}").collect()), key=repr) == rows
        assert set(glob.glob(f"{location}/**/*.parquet", recursive=True)) == files  # nothing is left behind
    assert not [d.name for d in spark.catalog.listDatabases() if d.name.startswith("portolan_candidate")]
    # The same load without its bad row, with the check made right: it sees the candidate tables, not the old ones.
    right = {"check_sql": "SELECT COUNT(*) FROM immigration JOIN country ON i94res = Code", "expected_result": 3}
    assert _load(spark, "pub_a", location, _fact(spark, *MAY), checks=[right])["immigration"] == (3, 0)
    assert _ids(spark, "pub_a") == [1, 2, 3]


def test_write_that_dies_publishes_nothing(spark):
    location = scratch_path(spark, "wh")
    _load(spark, "pub_b", location, _fact(spark, *APRIL))
    tables = _tables(spark, _fact(spark, *MAY))
    tables["states"] = lambda load: 1 / 0
    with pytest.raises(ZeroDivisionError):
        warehouse.warehouse_load(spark, "pub_b", location, tables)
    assert _ids(spark, "pub_b") == [1, 2] and versions.current(spark, location).number == 1


def test_other_months_are_not_read(spark):
    """With the fact files of April and March gone, May still loads, and dates and answers cover them all."""
    location = scratch_path(spark, "wh")
    march = (_row(8.0, 20515.0, 20520.0, mon=3.0),)
    _load(spark, "pub_c", location, _fact(spark, *APRIL, *march))
    for month in (3, 4):
        shutil.rmtree(f"{location}/immigration/i94yr=2016/i94mon={month}")
    report = _load(spark, "pub_c", location, _fact(spark, *MAY), unique_keys=True)
    assert report["immigration"] == (4, 0) and report["date"] == (7, 0)
    answers = rollups.Answers(spark, location, prefix=warehouse.MONTHLY)
    assert answers.average_stay().collect()[0].n_stays == 3
    assert answers.visitors_by_airline().collect()[0].visitors == 4


def test_answers_after_three_months_equal_full_recomputation(spark):
    location = scratch_path(spark, "wh")

    def rows(month, first):
        day = 20454.0 + 31 * month
        return [("NY" if i % 3 else None if i % 2 else "CA", float(month), float(first + i), 2.0, 101.0 + i % 3, day + i, 2016.0, day + 3 * i if i % 4 else None,
                 "AB"[i % 2], "1", 1.0, "X", "B2", "FMX"[i % 3] if i % 5 else None, 101.0 + i % 2, float(20 + i) if i % 6 else None, 1.0) for i in range(12)]
    for month in (1, 2, 3, 2):  # February is delivered twice
        _load(spark, "pub_d", location, immigration.immigration_facts(_raw(spark, rows(month, 100 * month + (7 if month == 2 else 0)))))
    fact, country, states = (spark.table(f"pub_d.{t}") for t in ("immigration", "country", "states"))
    answers = rollups.Answers(spark, location, prefix=warehouse.MONTHLY)
    pairs = [(answers.average_stay(), analytics.average_stay(fact)),
             (answers.visitors_by_nationality(country), analytics.visitors_by_country(fact, country, "i94cit")),
             (answers.visitors_by_origin(country), analytics.visitors_by_country(fact, country, "i94res")),
             (answers.visitors_by_airline(), analytics.visitors_by(fact, "airline")),
             (answers.destination_source_lift(), analytics.destination_source_lift(fact)),
             (answers.visitor_demographics(states), analytics.visitor_demographics(fact, states)),
             (answers.demographics_correlation(states, ["TotalPopulation"]), analytics.demographics_correlation(fact, states, ["TotalPopulation"])),
             (answers.temperature_correlation(country), analytics.temperature_correlation(fact, country)),
             (answers.destination_source_climate(country), analytics.destination_source_climate(fact, country)),
             (answers.date_dimension(), immigration.date_dimension(fact)), (spark.table("pub_d.date"), immigration.date_dimension(fact))]
    key = lambda r: [round(v, 9) if isinstance(v, float) else v for v in r]
    for got, want in pairs:
        assert got.columns == want.columns
        assert sorted(map(repr, map(key, got.collect()))) == sorted(map(repr, map(key, want.collect())))
    assert fact.count() == 36 and "pub_d" not in "".join(answers.date_dimension().inputFiles())


def test_pieces_of_a_month_are_merged(spark):
    location = scratch_path(spark, "wh")
    _load(spark, "pub_e", location, _fact(spark, *APRIL, *MAY))
    piece = _fact(spark, _row(2.0, 20546.0, 20548.0), _row(4.0, 20547.0, None))
    assert _load(spark, "pub_e", location, piece, whole_months=False)["immigration"] == (4, 0)
    assert {r.cicid: r.stay for r in spark.table("pub_e.immigration").collect()} == {1: 5, 2: 2, 3: 4, 4: None}


def test_repeated_keys_are_found_without_the_history(spark):
    location = scratch_path(spark, "wh")
    _load(spark, "pub_f", location, _fact(spark, *APRIL))
    with pytest.raises(DataQualityError, match="seen_elsewhere': 1"):
        _load(spark, "pub_f", location, _fact(spark, *MAY, _row(2.0, 20577.0, None, mon=5.0)), unique_keys=True)
    with pytest.raises(DataQualityError, match="repeated_keys': 1"):
        _load(spark, "pub_f", location, _fact(spark, *MAY, *MAY), unique_keys=True)
    assert _load(spark, "pub_f", location, _fact(spark, *APRIL), unique_keys=True)["immigration"] == (2, 0)  # April replaces itself


def test_roll_back_and_a_session_that_meets_the_warehouse_anew(spark):
    location = scratch_path(spark, "wh")
    _load(spark, "pub_g", location, _fact(spark, *APRIL))
    _load(spark, "pub_g", location, _fact(spark, _row(9.0, 20545.0, None), *MAY))
    warehouse.create_tables(spark, "pub_h", location)  # another catalog's database over the same place
    assert _ids(spark, "pub_h") == _ids(spark, "pub_g") == [3, 9]
    versions.roll_back(spark, location)
    for name in ("pub_g", "pub_h"):
        warehouse.create_tables(spark, name, location)
        assert _ids(spark, name) == [1, 2] and spark.table(f"{name}.date").count() == 3
    assert versions.vacuum(spark, location, keep=1) > 0 and _ids(spark, "pub_g") == [1, 2]


def test_warehouse_of_unversioned_loads_is_taken_over(spark):
    location = scratch_path(spark, "wh")
    warehouse.create_tables(spark, "pub_i", location)
    warehouse.load_table(_fact(spark, *APRIL, _row(None, None, None, mon=None)), "pub_i.immigration")
    with pytest.raises(DataQualityError):  # the null key stands in a month that this load doesn't touch
        _load(spark, "pub_i", location, _fact(spark, *MAY))
    report = _load(spark, "pub_i", location, _fact(spark, *MAY), checks=[])
    assert report["immigration"] == (4, 1) and report["date"] == (5, 0)
    assert _ids(spark, "pub_i") == [1, 2, 3, None]
    assert os.path.isdir(f"{location}/immigration/i94yr=2016/i94mon=4")


def test_table_that_becomes_empty_is_not_the_old_one(spark):
    location = scratch_path(spark, "wh")
    _load(spark, "pub_j", location, _fact(spark, *APRIL))
    tables = {**_tables(spark, _fact(spark, *MAY)), "states": spark.createDataFrame([], schemas.STATES_TABLE)}
    with pytest.raises(DataQualityError, match="states"):
        warehouse.warehouse_load(spark, "pub_j", location, tables)
    assert spark.table("pub_j.states").count() == 2


def test_key_bitmaps_keep_every_kind_of_key(spark):
    from portolan.operators.uniqueness import incremental_key_report, key_bitmaps
    rows = [(1, k) for k in (0, -5, 5, 32768, 32769, 2**62, None, None, 7, 7, 7)] + [(2, k) for k in (-5, 8, 2**62, None)] + [(3, k) for k in (8, 9)]
    df = spark.createDataFrame(rows, "month int, k long")
    maps = key_bitmaps(df, "k", ["month"])
    got = {r.month: tuple(r)[1:] for r in incremental_key_report(maps.where("month > 1"), maps.where("month = 1"), ["month"]).collect()}
    assert got == {2: (3, 3, 0, 0, 2, False), 3: (2, 2, 0, 0, 1, False)}
    got = {r.month: tuple(r)[1:] for r in incremental_key_report(maps.where("month = 1"), maps.limit(0), ["month"]).collect()}
    assert got == {1: (9, 7, 1, 3, 0, False)}

"""End to end with the sources in their delivered layouts: CSVs with header (``;`` for
demographics), code lookups with a no-break space, arrival records as delivered."""

from portolan.plans.build import Sources, build_warehouse
from portolan.session import scratch_path
from tests.test_jobs import _raw, _row

DEMOGRAPHICS = ("City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;"
                "Foreign-born;Average Household Size;State Code;Race;Count\n"
                "Mobile;Alabama;38.1;90;100;190;5;;2.5;AL;White;100\n"
                "Mobile;Alabama;38.1;90;100;190;5;;2.5;AL;Asian;7\n"
                "Albany;New York;32.0;40;50;90;3;10;2.0;NY;White;60\n")


def _write_sources(spark, tmp_path):
    (tmp_path / "temps.csv").write_text(
        "dt,AverageTemperature,City,Country,Latitude,Longitude\n"
        "2000-01-01,10.5,Kabul,Afghanistan,34.56N,70.05E\n2000-02-01,,Kabul,Afghanistan,34.56N,70.05E\n"
        "2000-01-01,20.0,Mexico,Mexico,19.42N,99.13W\n")
    (tmp_path / "demo.csv").write_text(DEMOGRAPHICS)
    (tmp_path / "addr.csv").write_text("Code,State\nAL,ALABAMA\nNY,NEW YORK\n99,All Other Codes\n")
    (tmp_path / "cit.csv").write_text("Code,I94CTRY\n582,MEXICO\n236,AFGHANISTAN\n999,STATELESS\n")
    raw = _raw(spark, [_row(1.0, 20545.0, 20550.0), _row(2.0, 20576.0, None, mon=5.0)])
    raw_path = scratch_path(spark, "raw-arrivals")
    raw.write.parquet(raw_path)
    return Sources(immigration=raw_path, temperature=str(tmp_path / "temps.csv"),
                   demographics=str(tmp_path / "demo.csv"), state_lookup=str(tmp_path / "addr.csv"),
                   country_lookup=str(tmp_path / "cit.csv"))


def test_build_warehouse_end_to_end(spark, tmp_path):
    sources = _write_sources(spark, tmp_path)
    out = scratch_path(spark, "build")
    report = {r.table: (r.n_rows, r.null_keys) for r in build_warehouse(spark, sources, out, "wh_build").collect()}
    assert report == {"immigration": (2, 0), "country": (3, 0), "states": (3, 0), "date": (3, 0)}
    states = {r.Code: (r.State, r.TotalPopulation) for r in spark.table("wh_build.states").collect()}
    assert states == {"AL": ("Alabama", 190), "NY": ("New York", 90), "99": ("All Other Codes", None)}
    country = {r.Code: (r.Country, r.Temperature) for r in spark.table("wh_build.country").collect()}
    assert country == {582: ("Mexico", 20.0), 236: ("Afghanistan", 10.5), 999: ("Stateless", None)}
    # Rerunning the build leaves the warehouse as it was.
    build_warehouse(spark, sources, out, "wh_build")
    assert spark.table("wh_build.immigration").count() == 2


def test_build_from_csv_arrivals(spark, tmp_path):
    s = _write_sources(spark, tmp_path)
    csv = scratch_path(spark, "csv-arrivals")
    raw = spark.read.parquet(s.immigration)
    raw.select(*reversed(raw.columns)).coalesce(1).write.option("header", True).csv(csv)
    sources = Sources(**{**s.__dict__, "immigration": csv, "immigration_format": "csv"})
    report = {r.table: r.n_rows for r in build_warehouse(spark, sources, scratch_path(spark, "b"), "wh_csv").collect()}
    assert report["immigration"] == 2 and report["date"] == 3


MONTH = """
import sys
sys.path.insert(0, {repo!r})
from portolan.plans.build import Sources, build_warehouse
from portolan.session import build_session
from tests.test_jobs import _raw, _row
spark = build_session("local[2]", shuffle_partitions=2, **{{"spark.checkpoint.dir": {ckpt!r}, "spark.sql.warehouse.dir": {ckpt!r}}})
raw = {out!r} + "/raw-{month}"
_raw(spark, [_row({month}.0, {day}, None, mon={month}.0)]).write.parquet(raw)
sources = Sources(immigration=raw, temperature={tmp!r} + "/temps.csv", demographics={tmp!r} + "/demo.csv",
                  state_lookup={tmp!r} + "/addr.csv", country_lookup={tmp!r} + "/cit.csv")
build_warehouse(spark, sources, {out!r}, "wh_two")
print("ROWS", sorted(r.cicid for r in spark.table("wh_two.immigration").collect()),
      sorted(r.date for r in spark.table("wh_two.date").collect()))
"""


def test_two_sessions_accumulate_months(spark, tmp_path):
    """April in one process, May in the next, same location: both months stay."""
    import os
    import subprocess
    import sys
    _write_sources(spark, tmp_path)
    repo, said = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), []
    for month, day in ((4, "20545.0"), (5, "20576.0")):
        code = MONTH.format(repo=repo, ckpt=str(tmp_path / "ck"), out=str(tmp_path / "out"), tmp=str(tmp_path), month=month, day=day)
        run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, timeout=300)
        said.append([line for line in run.stdout.splitlines() if line.startswith("ROWS")] or run.stderr[-2000:])
    assert said == [["ROWS [4] ['2016-04-01']"], ["ROWS [4, 5] ['2016-04-01', '2016-05-02']"]]


def test_lost_keys_stop_the_build(spark, tmp_path):
    import pytest
    from portolan.operators import DataQualityError
    s = _write_sources(spark, tmp_path)
    bad = scratch_path(spark, "bad-arrivals")
    _raw(spark, [_row(1e30, 20545.0, None)]).write.parquet(bad)
    with pytest.raises(DataQualityError):
        build_warehouse(spark, Sources(**{**s.__dict__, "immigration": bad}), scratch_path(spark, "b"), "wh_bad")


def test_command_line_build(spark, tmp_path, capsys):
    from portolan.__main__ import main
    s = _write_sources(spark, tmp_path)
    main(["build", "--immigration", s.immigration, "--temperature", s.temperature,
          "--demographics", s.demographics, "--state-lookup", s.state_lookup,
          "--country-lookup", s.country_lookup, "--out", scratch_path(spark, "cli"), "--database", "wh_cli"])
    assert "immigration" in capsys.readouterr().out
    assert spark.table("wh_cli.date").count() == 3


def test_monthly_builds_accumulate(spark, tmp_path):
    s = _write_sources(spark, tmp_path)
    may = scratch_path(spark, "may-arrivals")
    _raw(spark, [_row(7.0, 20577.0, 20600.0, mon=5.0)]).write.parquet(may)
    out = scratch_path(spark, "monthly")
    build_warehouse(spark, s, out, "wh_monthly")   # April and May (the shared fixture)
    build_warehouse(spark, Sources(**{**s.__dict__, "immigration": may}), out, "wh_monthly")  # May again
    fact = {r.cicid for r in spark.table("wh_monthly.immigration").collect()}
    assert fact == {1, 7}  # April kept, May replaced by the new delivery
    dates = {r.date for r in spark.table("wh_monthly.date").collect()}
    assert dates == {"2016-04-01", "2016-04-06", "2016-05-03", "2016-05-26"}  # 05-02 left with its row

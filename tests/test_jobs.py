"""The jobs on hand-made rows with the delivered column names, and load properties."""

from pyspark.sql import functions as F

from portolan import schemas
from portolan.plans import countries, demographics, immigration, warehouse
from portolan.session import scratch_path
from portolan.sources.io import overwrite_partitions, read_partitioned, save_data
from portolan.sources.labels import extract_pairs, label_entries, lookup_from_entries, number_lines

RAW = ("i94addr string, i94mon double, cicid double, i94visa double, i94res double, arrdate double, "
       "i94yr double, depdate double, airline string, fltno string, i94mode double, i94port string, "
       "visatype string, gender string, i94cit double, i94bir double, admnum double")


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def _row(cicid, arr, dep, mon=4.0):
    return ("NY", mon, cicid, 2.0, 101.0, arr, 2016.0, dep, "AA", "10", 1.0, "NYC", "B2", "F", 101.0, 30.7, 1.0)


def test_immigration_fact_edge_rows(spark):
    raw = _raw(spark, [_row(1.0, 20545.0, None), _row(2.0, None, 20546.0), _row(3.0, 20545.0, 20545.0),
                       _row(4.0, 20550.0, 20545.0)])
    fact = immigration.immigration_facts(raw)
    assert "admnum" not in fact.columns and fact.columns[-1] == "stay"
    got = {r.cicid: (r.arrdate, r.depdate, r.stay, r.i94bir) for r in fact.collect()}
    assert got == {1: ("2016-04-01", None, None, 30), 2: (None, "2016-04-02", None, 30),
                   3: ("2016-04-01", "2016-04-01", 0, 30), 4: ("2016-04-06", "2016-04-01", -5, 30)}
    assert fact.count() == raw.count()


def test_date_dimension_unique_days(spark):
    raw = _raw(spark, [_row(1.0, 20546.0, 20550.0), _row(2.0, 20545.0, 20546.0), _row(3.0, None, None)])
    dates = immigration.date_dimension(immigration.immigration_facts(raw))
    rows = sorted(tuple(r) for r in dates.collect())
    assert [r[0] for r in rows] == ["2016-04-01", "2016-04-02", "2016-04-06"]
    assert rows[0] == ("2016-04-01", 2016, 4, 1, 13, 6)
    assert dates.columns == [f.name for f in schemas.DATE_TABLE.fields]


DEMO = ("City string, State string, `Median Age` string, `Male Population` string, `Female Population` string, "
        "`Total Population` string, `Number of Veterans` string, `Foreign-born` string, "
        "`Average Household Size` string, `State Code` string, Race string, Count string")


def test_city_demographics_and_states(spark):
    rows = [("Mobile", "Alabama", "38.1", "90", "100", "190", "5", None, "2.5", "AL", "White", "100"),
            ("Mobile", "Alabama", "38.1", "90", "100", "190", "5", None, "2.5", "AL", "Asian", "7.0"),
            ("Juneau", "Alaska", "35.0", "15", "16", "31", "2", "3", "2.1", "AK", "White", "20")]
    raw = spark.createDataFrame(rows, DEMO)
    typed = demographics.convert_types(raw, {c: "int" for c in schemas.DEMOGRAPHICS_INTEGER_COLUMNS})
    typed = demographics.convert_types(typed, {c: "double" for c in schemas.DEMOGRAPHICS_DOUBLE_COLUMNS})
    cities = demographics.city_demographics(typed)
    mobile = cities.where("City = 'Mobile'").first().asDict()
    assert mobile["TotalPopulation"] == 190 and mobile["Asian"] == 7 and mobile["HispanicOrLatino"] == 0
    assert mobile["ForeignBorn"] == 0  # missing number filled with 0
    lookup = spark.createDataFrame([("AL", "ALABAMA"), ("AK", "ALASKA"), ("99", "All Other Codes"),
                                    ("NY", "NEW YORK")], "Code string, State string")
    lookup = lookup.withColumn("State", F.regexp_replace("State", " ", " "))
    states = demographics.process_states(lookup, cities)
    got = {r.Code: (r.State, r.TotalPopulation, r.White) for r in states.collect()}
    assert got == {"AL": ("Alabama", 190, 100), "AK": ("Alaska", 31, 20), "99": ("All Other Codes", None, None),
                   "NY": ("New York", None, None)}
    assert states.count() == lookup.count()  # left join keeps every lookup row
    assert sum(r.TotalPopulation for r in cities.collect()) == sum(v[1] or 0 for v in got.values())


def test_country_dimension_renames_and_fallbacks(spark):
    temps = spark.createDataFrame([
        ("2000-01-01", "10.0", "Kinshasa", "Congo (Democratic Republic Of The)", "4S", "15E"),
        ("2000-01-01", "20.0", "Brazzaville", "Congo", "4S", "15E"),
        ("2000-01-01", "5.0", "Beijing", "China", "39N", "116E"),
        ("2000-01-01", "", "Shanghai", "China", "31N", "121E"),
        ("2000-01-01", "15.0", "Chicago", "United States", "41N", "87W"),
    ], schemas.TEMPERATURE_SOURCE)
    lookup = spark.createDataFrame([(385, "CONGO"), (245, "CHINA, PRC"), (583, "INVALID: UNITED STATES"),
                                    (407, "UNITED STATES"), (999, "STATELESS")], schemas.LOOKUP_COUNTRY)
    dim = countries.country_dimension(temps, lookup)
    got = {r.Code: (r.Country, r.Temperature) for r in dim.collect()}
    assert got == {385: ("Congo", 15.0), 245: ("China", 5.0), 583: ("United States", 15.0),
                   407: ("United States", 15.0), 999: ("Stateless", None)}
    assert dim.count() == lookup.count()


def test_warehouse_load_is_idempotent(spark):
    raw = _raw(spark, [_row(1.0, 20545.0, 20546.0), _row(2.0, 20545.0, None, mon=5.0)])
    fact = immigration.immigration_facts(raw)
    dates = immigration.date_dimension(fact)
    database, location = "wh_test_idem", scratch_path(spark, "wh")
    warehouse.create_tables(spark, database, location)
    for _ in range(2):
        warehouse.load_table(fact, f"{database}.immigration")
        warehouse.load_table(dates, f"{database}.date")
    assert spark.table(f"{database}.immigration").count() == 2
    assert spark.table(f"{database}.date").count() == 2
    # A monthly refresh replaces only its month.
    warehouse.load_table(fact.where("i94mon = 5").withColumn("gender", F.lit("M")), f"{database}.immigration")
    rows = {r.cicid: r.gender for r in spark.table(f"{database}.immigration").collect()}
    assert rows == {1: "F", 2: "M"}


def test_overwrite_partitions_keeps_other_months(spark):
    raw = _raw(spark, [_row(1.0, 20545.0, None), _row(2.0, 20576.0, None, mon=5.0)])
    fact = immigration.immigration_facts(raw)
    path = scratch_path(spark, "refresh-test")
    save_data(fact, path, partition_by=schemas.IMMIGRATION_PARTITION_COLUMNS)
    overwrite_partitions(fact.where("i94mon = 5").withColumn("airline", F.lit("ZZ")), path,
                         schemas.IMMIGRATION_PARTITION_COLUMNS)
    back = read_partitioned(spark, path, schemas.IMMIGRATION_TABLE)
    assert back.columns[-2:] == ["i94yr", "i94mon"]
    assert {r.cicid: r.airline for r in back.collect()} == {1: "AA", 2: "ZZ"}


def test_label_entries_sections_and_quotes(spark, tmp_path):
    text = ["/* header */", "  value i94cntyl", "   582 =  'MEXICO Air Sea'", "   236 =  'AFGHANISTAN' ;",
            "", "  value $i94prtl", "   'ALC'\t=\t'ALCAN, AK    '", "   'INT'\t=\t'INT''L FALLS, MN'",
            "   'CP '\t=\t'CALEXICO'", ";", "value i94model", "\t1 = 'Air'", "\t9 = 'Not reported' ;"]
    path = tmp_path / "labels.sas"
    path.write_text("\n".join(text))
    numbered = number_lines(spark.read.text(str(path)))
    got = sorted(tuple(r) for r in label_entries(numbered, chunk_lines=4).collect())
    assert got == sorted([("i94cntyl", "582", "MEXICO Air Sea"), ("i94cntyl", "236", "AFGHANISTAN"),
                          ("$i94prtl", "ALC", "ALCAN, AK    "), ("$i94prtl", "INT", "INT'L FALLS, MN"),
                          ("$i94prtl", "CP ", "CALEXICO"), ("i94model", "1", "Air"),
                          ("i94model", "9", "Not reported")])
    countries = lookup_from_entries(label_entries(numbered), "i94cntyl", code_type="int")
    assert sorted(tuple(r) for r in countries.collect()) == [(236, "AFGHANISTAN"), (582, "MEXICO Air Sea")]
    ports = lookup_from_entries(label_entries(numbered), "$i94prtl")  # keys as published, labels without trailing blanks
    assert {tuple(r) for r in ports.collect()} == {("ALC", "ALCAN, AK"), ("INT", "INT'L FALLS, MN"), ("CP ", "CALEXICO")}


def test_large_keys_are_kept(spark):
    fact = immigration.immigration_facts(_raw(spark, [_row(3e9, 20545.0, None)]))
    assert fact.first().cicid == 3_000_000_000


def test_date_dimension_from_raw_days_equals_the_fact_path(spark):
    raw = _raw(spark, [_row(1.0, 20546.0, 20550.0), _row(2.0, 20545.0, 20546.0), _row(3.0, None, None)])
    a = immigration.date_dimension(immigration.immigration_facts(raw)).collect()
    assert sorted(a) == sorted(immigration.date_dimension_of_days(raw).collect())


def test_csv_is_read_by_header(spark, tmp_path):
    import pytest
    from portolan.sources.lookups import state_lookup
    (tmp_path / "s.csv").write_text("State,extra,Code\nALABAMA,1,AL\n")
    assert [tuple(r) for r in state_lookup(spark, str(tmp_path / "s.csv")).collect()] == [("AL", "ALABAMA")]
    (tmp_path / "t.csv").write_text("State,Kode\nALABAMA,AL\n")
    with pytest.raises(ValueError):
        state_lookup(spark, str(tmp_path / "t.csv"))


def test_debug_size_needs_an_order(spark):
    import pytest
    from portolan.sources.io import load_data
    path = scratch_path(spark, "sample")
    spark.range(5).write.parquet(path)
    with pytest.raises(ValueError):
        load_data(spark, path, debug_size=1)


def test_extract_pairs_whole_text(spark):
    html = '<a href="/x" class="k">t</a>' + "x" * 50000 + '<img src="y.png" alt="">'
    df = spark.createDataFrame([(1, html), (2, "no pairs")], "id int, html string")
    got = [tuple(r) for r in extract_pairs(df, "html", keep=["id"]).collect()]
    assert got == [(1, 0, "href", "/x"), (1, 1, "class", "k"), (1, 2, "src", "y.png"), (1, 3, "alt", "")]


def test_read_immigration_and_copy_into(spark):
    raw = _raw(spark, [_row(1.0, 20545.0, None), _row(2.0, 20576.0, 20580.0, mon=5.0)])
    src = scratch_path(spark, "raw")
    raw.write.parquet(src)
    read = immigration.read_immigration(spark, src, debug_size=1, order_by="cicid")
    assert read.columns == schemas.IMMIGRATION_READ_COLUMNS and [r.cicid for r in read.collect()] == [1.0]
    staged = scratch_path(spark, "staged")
    immigration.process_immigration(immigration.read_immigration(spark, src), output_path=staged)
    database = "wh_test_copy"
    warehouse.create_tables(spark, database, scratch_path(spark, "wh"))
    warehouse.copy_into(spark, staged, f"{database}.immigration")
    assert sorted(r.stay if r.stay is not None else -1 for r in spark.table(f"{database}.immigration").collect()) == [-1, 4]


def test_warehouse_load_raises_with_every_failed_check(spark):
    import pytest
    from portolan.operators import DataQualityError
    raw = _raw(spark, [_row(None, 20545.0, 20546.0), _row(2.0, 20545.0, None)])  # a null key
    fact = immigration.immigration_facts(raw)
    empty_states = spark.createDataFrame([], schemas.STATES_TABLE)
    country = spark.createDataFrame([(101, "Albania", 12.0, "41N", "20E")], schemas.COUNTRY_TABLE)
    tables = {"immigration": fact, "country": country, "states": empty_states,
              "date": immigration.date_dimension(fact)}
    with pytest.raises(DataQualityError) as err:
        warehouse.warehouse_load(spark, "wh_fail", scratch_path(spark, "wh-fail"), tables)
    assert "immigration WHERE cicid is null" in str(err.value)
    tables["immigration"] = fact.where("cicid IS NOT NULL")
    with pytest.raises(DataQualityError) as err:  # null keys fixed; the empty table still fails
        warehouse.warehouse_load(spark, "wh_fail", scratch_path(spark, "wh-fail"), tables)
    assert "'states'" in str(err.value)

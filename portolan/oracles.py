"""DuckDB SQL for every registered query, over the same test tables.

Conventions (DuckDB vs Spark): ``dayofweek`` + 1 (Sunday = 1); calendar parts and
sums cast to the Spark integer types; double -> int truncates (``trunc``); doubles
computed by aggregation rounded to 4 places on both sides.
"""

from __future__ import annotations

from portolan import fixtures as fx
from portolan import schemas
from portolan.checks import SQL_CHECKS

RACES = fx.RACE_VALUES
STATE_COLUMNS = ["TotalPopulation", *RACES]


def TITLE(x: str) -> str:
    """Python-style title case in DuckDB."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, "
            r"'([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)', 1), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def _q(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _renamed(column: str, rules) -> str:
    """Single-pass CASE; equal to applying the rules in order when no new value is also
    a later old value (asserted)."""
    pairs = [(old, new) for col, old, new in rules if col == column]
    olds = [old for old, _ in pairs]
    assert not any(new in olds[i + 1:] for i, (_, new) in enumerate(pairs)), "chained renames"
    if not pairs:
        return column
    whens = " ".join(f"WHEN {_q(old)} THEN {_q(new)}" for old, new in pairs)
    return f"CASE {column} {whens} ELSE {column} END"


def _days(x: str) -> str:
    return f"(CAST({x} AS DATE) - DATE '1960-01-01')"


def _int(x: str) -> str:
    return f"CAST(trunc({x}) AS INTEGER)"


def _iso(x: str) -> str:
    return f"CAST(DATE '1960-01-01' + {_int(x)} AS VARCHAR)"


VIEWS: dict[str, tuple[list[str], str]] = {
    "visits_raw": ([], f"""
  SELECT CAST(l_orderkey*10+l_linenumber AS DOUBLE) AS cicid,
    CAST(year(o_orderdate) AS DOUBLE) AS i94yr, CAST(month(o_orderdate) AS DOUBLE) AS i94mon,
    CAST(c_nationkey AS DOUBLE) AS i94cit, CAST(s_nationkey AS DOUBLE) AS i94res, o_orderpriority AS i94port,
    CAST({_days('o_orderdate')} AS DOUBLE) AS arrdate,
    CAST(CASE WHEN l_linestatus = 'F' THEN {_days('l_shipdate')} END AS DOUBLE) AS depdate,
    CAST(CASE WHEN l_linenumber % 4 = 0 THEN 9 ELSE l_linenumber % 4 END AS DOUBLE) AS i94mode,
    CASE WHEN p_size = 50 THEN 'ZZ' WHEN p_size = 49 THEN NULL ELSE p_brand END AS i94addr,
    l_quantity AS i94bir, CAST(1 + p_size % 3 AS DOUBLE) AS i94visa, l_returnflag AS gender,
    p_type AS airline, CAST(l_partkey AS VARCHAR) AS fltno, c_mktsegment AS visatype
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""),
    "temperature_raw": ([], """
  SELECT s_suppkey AS seq,
    CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE CAST(s_acctbal AS VARCHAR) END AS AverageTemperature,
    s_name AS City, concat('Nation_', CAST(s_nationkey AS VARCHAR)) AS Country,
    concat(CAST(s_suppkey % 90 AS VARCHAR), 'N') AS Latitude,
    concat(CAST(s_suppkey % 180 AS VARCHAR), 'E') AS Longitude
  FROM supplier"""),
    "demographics_raw": ([], """
  SELECT p_partkey AS seq, p_name AS City, concat('State ', p_brand) AS State, p_brand AS State_Code,
    p_type AS Race, p_size AS Count_, CAST(floor(p_retailprice) AS INTEGER) AS Total_Population,
    p_retailprice AS Median_Age
  FROM part"""),
    "lookup_state": ([], """
  SELECT DISTINCT p_brand AS Code, upper(concat('state-', p_brand)) AS State FROM part
  UNION ALL SELECT '99', 'All Other Codes' UNION ALL SELECT 'NO', 'no-one''s land'"""),
    "lookup_country": ([], """
  SELECT CAST(n_nationkey AS INTEGER) AS Code,
    CASE WHEN n_nationkey % 7 = 3 THEN concat('INVALID: ', n_name) ELSE n_name END AS I94CTRY
  FROM nation UNION ALL SELECT 999, 'STATELESS'"""),
    "fact": (["visits_raw"], f"""
  SELECT i94addr, {_int('i94mon')} AS i94mon, CAST(trunc(cicid) AS BIGINT) AS cicid, {_int('i94visa')} AS i94visa,
    {_int('i94res')} AS i94res, {_iso('arrdate')} AS arrdate, {_int('i94yr')} AS i94yr,
    {_iso('depdate')} AS depdate, airline, fltno, {_int('i94mode')} AS i94mode, i94port, visatype, gender,
    {_int('i94cit')} AS i94cit, {_int('i94bir')} AS i94bir,
    {_int('depdate')} - {_int('arrdate')} AS stay
  FROM visits_raw"""),
    "date_dim": (["fact"], """
  SELECT CAST(d AS VARCHAR) AS "date", CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month",
    CAST(day(d) AS INTEGER) AS "day", CAST(weekofyear(d) AS INTEGER) AS weekofyear,
    CAST(dayofweek(d) + 1 AS INTEGER) AS dayofweek
  FROM (SELECT CAST(arrdate AS DATE) AS d FROM fact UNION SELECT CAST(depdate AS DATE) FROM fact) days
  WHERE d IS NOT NULL"""),
    "cities": (["demographics_raw"], """
  SELECT City, State, State_Code,
    coalesce(min_by(Total_Population, seq), 0) AS TotalPopulation,
    coalesce(min_by(Median_Age, seq), 0) AS MedianAge,
    """ + ",\n    ".join(f"CAST(coalesce(sum(CASE WHEN Race = '{r}' THEN Count_ END), 0) AS BIGINT) AS {r}"
                         for r in RACES) + """
  FROM demographics_raw
  WHERE City IS NOT NULL AND State IS NOT NULL AND State_Code IS NOT NULL
  GROUP BY City, State, State_Code"""),
    "rollup": (["cities"], """
  SELECT State_Code, min(State) AS State, """ + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in STATE_COLUMNS) + """
  FROM cities GROUP BY State_Code"""),
    "states": (["lookup_state", "rollup"], f"""
  SELECT l.Code, coalesce(r.State, {TITLE('l.State')}) AS State, """
        + ", ".join(f"r.{c}" for c in STATE_COLUMNS) + """
  FROM lookup_state l LEFT JOIN rollup r ON r.State_Code = l.Code"""),
    "country": (["temperature_raw", "lookup_country"], f"""
  SELECT c.Code, coalesce(t.Country, {TITLE('c.I94CTRY')}) AS Country, t.Temperature, t.Latitude, t.Longitude
  FROM (SELECT Code, regexp_replace({_renamed('I94CTRY', schemas.LOOKUP_COUNTRY_RENAMES)}, '^INVALID: ', '')
          AS I94CTRY FROM lookup_country) c
  LEFT JOIN (SELECT lower(Country) AS k, avg(TRY_CAST(AverageTemperature AS DOUBLE)) AS Temperature,
                    min_by(Country, seq) AS Country, min_by(Latitude, seq) AS Latitude,
                    min_by(Longitude, seq) AS Longitude
             FROM (SELECT seq, AverageTemperature, Latitude, Longitude,
                          {_renamed('Country', schemas.TEMPERATURE_COUNTRY_RENAMES)} AS Country
                   FROM temperature_raw) t0
             GROUP BY lower(Country)) t
    ON lower(c.I94CTRY) = t.k"""),
}


def with_views(body: str, *needed: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH`` the role views ``body`` needs (dependencies first) and ``extra`` named
    queries, then ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        order.append(name)

    for name in needed:
        visit(name)
    ctes = ",\n".join([*(f"{name} AS ({VIEWS[name][1]}\n)" for name in order),
                        *(f"{name} AS ({sql})" for name, sql in extra)])
    return f"WITH {ctes}\n{body}" if ctes else body


FACT_COLUMNS = ("i94addr, cicid, i94visa, i94res, arrdate, depdate, airline, fltno, i94mode, i94port, "
                "visatype, gender, i94cit, i94bir, stay, i94yr, i94mon")
INTEGER_CAST_COLUMNS = set(schemas.IMMIGRATION_INTEGER_COLUMNS)
RAW_COLUMNS = ["cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port", "arrdate", "depdate", "i94mode",
               "i94addr", "i94bir", "i94visa", "gender", "airline", "fltno", "visatype"]


def _dq_tables() -> list[tuple[str, str, str]]:
    return [("immigration", "fact", "cicid"), ("country", "country", "Code"),
            ("states", "states", "Code"), ("date", "date_dim", '"date"')]


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    o["load_project_limit"] = ("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part "
                               "ORDER BY p_partkey LIMIT 1000")
    o["csv_roundtrip"] = with_views("SELECT * FROM demographics_raw", "demographics_raw")
    o["parquet_roundtrip"] = with_views("SELECT seq, City, Country, AverageTemperature FROM temperature_raw",
                                        "temperature_raw")
    o["partitioned_fact_write"] = with_views(f"SELECT {FACT_COLUMNS} FROM fact", "fact")
    o["land_temperature"] = with_views(
        "SELECT seq, AverageTemperature, Latitude, Longitude, Country, City FROM temperature_raw",
        "temperature_raw")
    o["land_temperature_by_city"] = with_views(
        "SELECT seq, AverageTemperature, Latitude, Longitude, Country, City FROM temperature_raw WHERE City LIKE '%7'", "temperature_raw")
    o["land_airport"] = "SELECT s_suppkey, s_name, s_acctbal, s_nationkey FROM supplier"
    o["stage_table_load"] = with_views("SELECT * FROM date_dim", "date_dim")
    o["monthly_refresh"] = with_views(f"SELECT {FACT_COLUMNS} FROM fact", "fact")
    o["monthly_stream_ingest"] = with_views(f"SELECT {FACT_COLUMNS} FROM fact", "fact")
    pattern = r'([A-Za-z-]+)="([^"]*)"'
    o["extract_key_values"] = f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, regexp_extract(m, '{pattern}', 1) AS key,
       regexp_extract(m, '{pattern}', 2) AS value
FROM (SELECT page_id, unnest(ms) AS m, unnest(range(len(ms))) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '{pattern}', 0) AS ms FROM pages) a) b"""
    o["label_text_lookups"] = ("SELECT concat('brand_', replace(p_brand, '#', '_')) AS section, "
                               "CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part")
    o["label_text_sections"] = ("SELECT concat('brand_', replace(p_brand, '#', '_')) AS section, "
                                "CAST(p_partkey AS VARCHAR) || ' ' AS code, rtrim(p_name) AS label FROM part")
    o["convert_types"] = with_views(
        "SELECT " + ", ".join("CAST(trunc(cicid) AS BIGINT) AS cicid" if c == "cicid" else
                              f"{_int(c)} AS {c}" if c in INTEGER_CAST_COLUMNS else c for c in RAW_COLUMNS)
        + " FROM visits_raw", "visits_raw")
    o["drop_columns"] = with_views(
        "SELECT " + ", ".join(c for c in RAW_COLUMNS if c not in ("i94yr", "i94mon")) + " FROM visits_raw",
        "visits_raw")
    o["rename_columns"] = with_views(
        "SELECT seq, City, State, State_Code AS StateCode, Race, Count_ AS \"Count\", "
        "Total_Population AS TotalPopulation, Median_Age AS MedianAge FROM demographics_raw",
        "demographics_raw")
    o["value_refactoring"] = with_views(
        "SELECT cicid, CASE visatype WHEN 'AUTOMOBILE' THEN 'CAR' WHEN 'AUTO' THEN 'CAR' "
        "WHEN 'HOUSEHOLD' THEN 'HOME' ELSE visatype END AS visatype, "
        "CASE WHEN airline = 'PROMO' THEN 'PROMOTION' ELSE airline END AS airline, "
        "CASE WHEN gender = 'N' THEN 'X' ELSE gender END AS gender FROM visits_raw", "visits_raw")
    o["title_case"] = with_views(
        f"SELECT 'state' AS source, Code, State AS label, {TITLE('State')} AS title FROM lookup_state "
        f"UNION ALL SELECT 'country', CAST(Code AS VARCHAR), I94CTRY, {TITLE('I94CTRY')} FROM lookup_country "
        f"UNION ALL SELECT 'city', CAST(seq AS VARCHAR), upper(City), {TITLE('upper(City)')} FROM demographics_raw",
        "lookup_state", "lookup_country", "demographics_raw")
    o["sas_dates"] = with_views(
        f"SELECT cicid, {_iso('arrdate')} AS arrdate, {_iso('depdate')} AS depdate FROM visits_raw", "visits_raw")
    o["stay_length"] = with_views(
        "SELECT cicid, arrdate, depdate, CAST(CAST(depdate AS DATE) - CAST(arrdate AS DATE) AS INTEGER) AS stay "
        "FROM fact", "fact")
    o["immigration_fact"] = with_views("SELECT * FROM fact", "fact")
    o["date_dimension"] = with_views("SELECT * FROM date_dim", "date_dim")
    o["city_first_values"] = with_views(
        "SELECT City, State, State_Code, min_by(Total_Population, seq) AS TotalPopulation, "
        "min_by(Median_Age, seq) AS MedianAge FROM demographics_raw GROUP BY City, State, State_Code",
        "demographics_raw")
    o["first_values_default"] = """
SELECT p_brand, type AS first_type, size AS first_size, price AS first_price FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY type NULLS FIRST, size NULLS FIRST, price NULLS FIRST) AS rn
  FROM (SELECT p_brand, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS size,
          CASE WHEN p_partkey % 2 <> 0 THEN p_type END AS type, p_retailprice AS price FROM part) r) o WHERE rn = 1"""
    o["race_pivot"] = with_views(
        "SELECT City, State, State_Code, "
        + ", ".join(f"CAST(sum(CASE WHEN Race = '{r}' THEN Count_ END) AS BIGINT) AS {r}" for r in RACES)
        + " FROM demographics_raw GROUP BY City, State, State_Code", "demographics_raw")
    o["city_demographics"] = with_views("SELECT * FROM cities", "cities")
    o["state_rollup"] = with_views("SELECT * FROM rollup", "rollup")
    o["states_dimension"] = with_views("SELECT * FROM states", "states")
    climate = ("SELECT Country, round(avg(TRY_CAST(AverageTemperature AS DOUBLE)), 4) AS Temperature, "
               "{lat} AS Latitude, {lon} AS Longitude FROM temperature_raw GROUP BY Country")
    o["country_climate"] = with_views(climate.format(lat="min_by(Latitude, seq)", lon="min_by(Longitude, seq)"),
                                      "temperature_raw")
    o["country_climate_nonnull"] = with_views(
        climate.format(lat="min_by(Latitude, CASE WHEN Latitude IS NOT NULL THEN seq END)",
                       lon="min_by(Longitude, CASE WHEN Longitude IS NOT NULL THEN seq END)"),
        "temperature_raw")
    o["country_climate_two_level"] = with_views(
        "SELECT Country, round(avg(m), 4) AS Temperature, count(*) AS n_cities FROM "
        "(SELECT Country, City, avg(TRY_CAST(AverageTemperature AS DOUBLE)) AS m FROM temperature_raw "
        "GROUP BY Country, City) c GROUP BY Country", "temperature_raw")
    o["country_dimension"] = with_views(
        "SELECT Code, Country, round(Temperature, 4) AS Temperature, Latitude, Longitude FROM country", "country")

    dq = _dq_tables()
    o["dq_null_keys"] = with_views(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{k.strip(chr(34))}' AS key, count_if({k} IS NULL) AS null_keys, "
        f"CAST(0 AS BIGINT) AS expected, count_if({k} IS NULL) = 0 AS passed FROM {v}" for t, v, k in dq),
        "fact", "country", "states", "date_dim")
    o["dq_row_counts"] = with_views(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows, count(*) >= 1 AS passed FROM {v}" for t, v, _ in dq),
        "fact", "country", "states", "date_dim")
    o["dq_duplicate_keys"] = with_views(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT {k}, count(*) AS n FROM {v} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1) d"
        for t, v, k in dq), "fact", "country", "states", "date_dim")
    relations = [("born_country", "i94cit", "country", "Code"), ("residence_country", "i94res", "country", "Code"),
                 ("state", "i94addr", "states", "Code"), ("arrival_date", "arrdate", "date_dim", '"date"'),
                 ("departure_date", "depdate", "date_dim", '"date"')]
    o["dq_orphans"] = with_views(" UNION ALL ".join(
        f"SELECT '{name}' AS relationship, count(*) AS orphans FROM fact f "
        f"WHERE f.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{col})"
        for name, col, dim, key in relations), "fact", "country", "states", "date_dim")
    def check(sql: str, expected: object, passed: str) -> str:
        # The first value of the statement and whether it has a row, by position.
        value = f"(SELECT x FROM ({sql}) t(x) LIMIT 1)" if "half" not in sql else f"(SELECT x FROM ({sql}) t(x, y) LIMIT 1)"
        there = f"(SELECT count(*) > 0 FROM ({sql}) t)"
        shown = "CAST(NULL AS VARCHAR)" if expected is None else _q(expected)
        return (f"SELECT {_q(sql)} AS check_sql, CAST({value} AS VARCHAR) AS result, {shown} AS expected, "
                f"{there} AND coalesce({passed.format(v=value)}, false) AS passed")

    o["dq_sql_checks"] = " UNION ALL ".join(
        check(sql, expected, "{v} IS NULL" if expected is None else
              f"typeof({{v}}) = 'VARCHAR' AND CAST({{v}} AS VARCHAR) = {_q(expected)}" if isinstance(expected, str) else
              f"typeof({{v}}) <> 'VARCHAR' AND TRY_CAST({{v}} AS DOUBLE) = {expected}") for sql, expected in SQL_CHECKS)
    # A value is lost if it is there and no integer of its type: text that isn't a number, or a number out of range.
    typed = {c: ("BIGINT" if c in schemas.IMMIGRATION_LONG_COLUMNS else "INTEGER", c)
             for c in schemas.IMMIGRATION_INTEGER_COLUMNS if c in RAW_COLUMNS}
    typed |= {"big": ("INTEGER", "cicid * 100000"), "fltno": ("INTEGER", "fltno"), "visatype": ("INTEGER", "visatype")}
    lost = {c: f"({x}) IS NOT NULL AND TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS {t}) IS NULL" for c, (t, x) in typed.items()}
    o["dq_cast_loss"] = with_views(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count_if({x}) AS lost, count_if({x}) = 0 AS passed FROM visits_raw" for c, x in lost.items()), "visits_raw")
    values = {**{c: f"CAST({x} AS VARCHAR)" for c, (_, x) in typed.items()}, "big": "CAST(CAST(cicid AS BIGINT) * 100000 AS VARCHAR)"}
    o["dq_rejects"] = with_views(" UNION ALL ".join(
        f"SELECT CAST(trunc(cicid) AS BIGINT) AS cicid, '{c}' AS \"column\", {values[c]} AS value, "
        f"CASE WHEN TRY_CAST({typed[c][1]} AS DOUBLE) IS NULL THEN 'not a number' ELSE 'out of range' END AS reason "
        f"FROM visits_raw WHERE {x}" for c, x in lost.items()), "visits_raw")
    o["warehouse_load"] = with_views(" UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{k.strip(chr(34))}' AS key, count(*) AS n_rows, "
        f"count_if({k} IS NULL) AS null_keys FROM {v}" for t, v, k in dq),
        "fact", "country", "states", "date_dim")

    o["star_join"] = with_views(
        "SELECT f.cicid, f.i94cit, b.Country AS born_country, f.i94res, h.Country AS residence_country, "
        "round(h.Temperature, 4) AS residence_temperature, f.i94addr, s.State AS state, f.arrdate, "
        "a.\"year\" AS arrival_year, a.\"month\" AS arrival_month, a.dayofweek AS arrival_dayofweek, f.depdate, "
        "e.\"year\" AS departure_year, e.\"month\" AS departure_month, f.stay "
        "FROM fact f LEFT JOIN country b ON f.i94cit = b.Code LEFT JOIN country h ON f.i94res = h.Code "
        "LEFT JOIN states s ON f.i94addr = s.Code LEFT JOIN date_dim a ON f.arrdate = a.\"date\" "
        "LEFT JOIN date_dim e ON f.depdate = e.\"date\"", "fact", "country", "states", "date_dim")
    o["decode_codes"] = with_views(
        "SELECT f.cicid, f.i94mode, f.i94visa, f.i94port, m.Mode AS mode, v.Type AS visa_type, p.Port AS port "
        "FROM fact f "
        "LEFT JOIN (VALUES " + ", ".join(f"({i}, {_q(label)})" for i, label in schemas.MODE_LABELS)
        + ") m(ID, Mode) ON f.i94mode = m.ID "
        "LEFT JOIN (VALUES " + ", ".join(f"({i}, {_q(label)})" for i, label in schemas.VISA_LABELS)
        + ") v(ID, Type) ON f.i94visa = v.ID "
        "LEFT JOIN (SELECT DISTINCT CASE o_orderpriority WHEN '5-LOW' THEN '5-LO' ELSE o_orderpriority END AS ID, "
        "concat('PORT ', substr(o_orderpriority, 3)) AS Port FROM orders) p ON f.i94port = p.ID", "fact")
    o["normalize_state_codes"] = with_views(
        "SELECT coalesce(s.Code, '99') AS i94addr, count(*) AS visitors FROM fact f "
        "LEFT JOIN (SELECT DISTINCT Code FROM states) s ON f.i94addr = s.Code GROUP BY 1", "fact", "states")
    o["average_stay"] = with_views(
        "SELECT i94addr, round(avg(stay), 4) AS avg_stay, count(stay) AS n_stays FROM fact GROUP BY i94addr",
        "fact")
    o["visitors_by_nationality"] = with_views(
        "SELECT c.Country, count(*) AS visitors FROM fact f LEFT JOIN country c ON f.i94cit = c.Code "
        "GROUP BY c.Country", "fact", "country")
    share = ", ".join(f"round(CAST(count_if(gender = '{g}') AS DOUBLE) / nullif(count(gender), 0), 4) AS share_{g}" for g in "ANR")
    o["visitor_demographics"] = with_views(
        f"SELECT v.i94addr, s.State AS state, s.TotalPopulation AS population, visitors, avg_age, share_A, share_N, share_R, "
        f"round(visitors * 1000.0::DOUBLE / nullif(s.TotalPopulation, 0), 4) AS visitors_per_1000 FROM "
        f"(SELECT i94addr, count(*) AS visitors, round(avg(i94bir), 4) AS avg_age, {share} FROM fact GROUP BY i94addr) v "
        f"LEFT JOIN states s ON v.i94addr = s.Code", "fact", "states")
    o["visitors_by_airline"] = with_views(
        "SELECT airline, count(*) AS visitors FROM fact GROUP BY airline", "fact")
    o["visitors_by_origin"] = with_views(
        "SELECT c.Country, count(*) AS visitors FROM fact f LEFT JOIN country c ON f.i94res = c.Code "
        "GROUP BY c.Country", "fact", "country")
    o["destination_source_lift"] = with_views(
        "SELECT i94addr, i94res, visitors, round(CAST(visitors AS DOUBLE) * (SELECT sum(visitors) FROM pairs) / "
        "(CAST(sum(visitors) OVER (PARTITION BY i94addr) AS DOUBLE) * sum(visitors) OVER (PARTITION BY i94res)), 4) "
        "AS lift FROM pairs", "fact",
        extra=(("pairs", "SELECT i94addr, i94res, count(*) AS visitors FROM fact WHERE i94addr IS NOT NULL "
                         "GROUP BY i94addr, i94res"),))
    o["demographics_correlation"] = with_views(
        "SELECT count(*) AS states_matched, "
        + ", ".join(f"round(corr(CAST(n AS DOUBLE), CAST(s.{c} AS DOUBLE)), 4) AS corr_{c}" for c in STATE_COLUMNS)
        + " FROM (SELECT i94addr, count(*) AS n FROM fact WHERE i94addr IS NOT NULL GROUP BY i94addr) v "
          "JOIN states s ON v.i94addr = s.Code", "fact", "states")
    o["temperature_correlation"] = with_views(
        "SELECT count(*) AS countries_matched, round(corr(CAST(n AS DOUBLE), c.Temperature), 4) AS corr_temperature "
        "FROM (SELECT i94res, count(*) AS n FROM fact GROUP BY i94res) v JOIN country c ON v.i94res = c.Code",
        "fact", "country")
    o["destination_source_climate"] = with_views(
        "SELECT f.i94addr, round(avg(c.Temperature), 4) AS avg_source_temperature, "
        "count(c.Temperature) AS n_with_temperature FROM fact f LEFT JOIN country c ON f.i94res = c.Code "
        "GROUP BY f.i94addr", "fact", "country")

    arrivals = ("SELECT cicid, CASE WHEN CAST(fltno AS BIGINT) % 17 = 0 THEN NULL WHEN CAST(fltno AS BIGINT) % 19 = 0 THEN CAST(fltno AS BIGINT) + 1000000000 "
                "WHEN CAST(fltno AS BIGINT) % 3 = 1 THEN 1 ELSE CAST(fltno AS BIGINT) END AS part, stay FROM fact")
    o["colocated_join"] = with_views("SELECT a.*, p.p_brand, p.p_type FROM arrivals a LEFT JOIN part p ON a.part = p.p_partkey", "fact",
                                     extra=(("arrivals", arrivals),))
    o["colocated_orphans"] = with_views("SELECT a.* FROM arrivals a WHERE a.part IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = a.part)",
                                        "fact", extra=(("arrivals", arrivals),))

    def new_keys(name: str, key: str) -> str:
        # The last two months; every other month comes before them.
        return (f"SELECT '{name}' AS key, m.i94yr, m.i94mon, CAST(count(f.k) AS BIGINT) AS n_rows, count(DISTINCT f.k) AS n_keys, "
                f"count(DISTINCT CASE WHEN f.n > 1 THEN f.k END) AS repeated_keys, count_if(f.n > 1) AS repeated_rows, "
                f"count(DISTINCT CASE WHEN f.first < (m.i94yr, m.i94mon) THEN f.k END) AS seen_elsewhere, "
                f"count_if(f.n > 1) = 0 AND count_if(f.first < (m.i94yr, m.i94mon)) = 0 AS passed "
                f"FROM (SELECT DISTINCT i94yr, i94mon FROM fact ORDER BY i94yr DESC, i94mon DESC LIMIT 2) m JOIN "
                f"(SELECT i94yr, i94mon, {key} AS k, count(*) OVER (PARTITION BY i94yr, i94mon, {key}) AS n, "
                f"min((i94yr, i94mon)) OVER (PARTITION BY {key}) AS first FROM fact) f "
                f"ON f.i94yr = m.i94yr AND f.i94mon = m.i94mon GROUP BY m.i94yr, m.i94mon")

    o["dq_incremental_keys"] = with_views(f"{new_keys('cicid', 'cicid')} UNION ALL {new_keys('fltno', 'CAST(fltno AS BIGINT)')}", "fact")
    for name in ("date_dimension", "average_stay", "visitors_by_nationality", "visitors_by_airline", "visitors_by_origin", "destination_source_lift",
                 "visitor_demographics", "demographics_correlation", "temperature_correlation", "destination_source_climate"):
        o[f"rolled_{name}"] = o[name]  # the same answer, finished from monthly states
    return o


ORACLES: dict[str, str] = _oracles()

"""Role views over the TPC-H-like test tables, so every job runs on data that grows
with the scale factor (FIXTURES.md section 3 gives the same views as SQL).

visits_raw        arrival records as delivered (numbers as doubles, day numbers)
temperature_raw   city temperature reports (text)
demographics_raw  city x race rows
lookup_state      state codes (+ the catch-all '99')
lookup_country    country codes (some labels carry an ``INVALID: `` prefix)
lookup_port       port codes (text keys; one code of the data has no entry)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from portolan.functions.dates import date_to_day_number
from portolan.session import app_id, files_size, free_shuffles, scratch_path, sized_shuffles

# Fixed values of the role views.
RACE_VALUES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
INVALID_PREFIX = "INVALID: "
# Nation keys whose lookup label carries the INVALID prefix, and the renames that undo it.
INVALID_NATIONS = [k for k in range(25) if k % 7 == 3]
INVALID_RENAMES = [("I94CTRY", f"{INVALID_PREFIX}NATION_{k}", f"NATION_{k}") for k in INVALID_NATIONS]


VISITS_RAW_SCHEMA = StructType([
    StructField(name, DoubleType() if kind == "d" else StringType(), True) for name, kind in [
        ("cicid", "d"), ("i94yr", "d"), ("i94mon", "d"), ("i94cit", "d"), ("i94res", "d"), ("i94port", "s"),
        ("arrdate", "d"), ("depdate", "d"), ("i94mode", "d"), ("i94addr", "s"), ("i94bir", "d"),
        ("i94visa", "d"), ("gender", "s"), ("airline", "s"), ("fltno", "s"), ("visatype", "s")]])

# Schemas of the test tables, read once per path: later reads skip the footer job.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# visits_raw is staged in rounds of so many bytes of its sources, and in so many rounds.
ROUND_BYTES, MOST_ROUNDS = 32 << 20, 8

# visits_raw staged per (application, test folder): written once, then read like the
# delivered arrivals file it stands for.
_STAGED: dict[tuple[str, str], str] = {}


def visits_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals source. It is derived from five test tables by joins, so it is
    staged once per session (parquet under ``spark.checkpoint.dir``) and every query
    then reads it as a delivered arrivals file is read."""
    key = (app_id(spark), sf_dir.rstrip("/"))
    if key not in _STAGED:
        path = scratch_path(spark, "visits_raw")
        with sized_shuffles(spark, sources := [f"{key[1]}/{name}.parquet" for name in ("lineitem", "orders", "customer", "supplier", "part")]):
            # Large sources are joined in rounds, by order, whose shuffles go before the next.
            rounds = max(1, min(MOST_ROUNDS, files_size(spark, sources) // ROUND_BYTES))
            for turn in range(rounds):
                visits_raw_view(spark, sf_dir, turn, rounds).write.mode("append").parquet(path)
                if rounds > 1:
                    free_shuffles(spark)
        _STAGED[key] = path
    return spark.read.schema(VISITS_RAW_SCHEMA).parquet(_STAGED[key])


def visits_raw_view(spark: SparkSession, sf_dir: str, turn: int = 0, rounds: int = 1) -> DataFrame:
    """The arrivals source as a view over lineitem, orders, customer, supplier, part; of ``rounds`` parts, by order, the one numbered ``turn``."""
    t = lambda name: table(spark, sf_dir, name)
    li, o, c, s, p = t("lineitem"), t("orders"), t("customer"), t("supplier"), t("part")
    if rounds > 1:
        li = li.where(F.pmod(F.xxhash64(F.col("l_orderkey").cast("long")), F.lit(rounds)) == turn)
        o = o.where(F.pmod(F.xxhash64(F.col("o_orderkey").cast("long")), F.lit(rounds)) == turn)
    rows = (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(c, o.o_custkey == c.c_custkey)
            .join(s, li.l_suppkey == s.s_suppkey)
            .join(p, li.l_partkey == p.p_partkey))
    dbl = lambda col: col.cast("double")
    mode = F.when(F.col("l_linenumber") % 4 == 0, F.lit(9)).otherwise(F.col("l_linenumber") % 4)
    addr = (F.when(F.col("p_size") == 50, F.lit("ZZ"))
            .when(F.col("p_size") == 49, F.lit(None).cast("string"))
            .otherwise(F.col("p_brand")))
    return rows.select(
        dbl(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cicid"),
        dbl(F.year("o_orderdate")).alias("i94yr"),
        dbl(F.month("o_orderdate")).alias("i94mon"),
        dbl(F.col("c_nationkey")).alias("i94cit"),
        dbl(F.col("s_nationkey")).alias("i94res"),
        F.col("o_orderpriority").alias("i94port"),
        dbl(date_to_day_number(F.col("o_orderdate"))).alias("arrdate"),
        dbl(F.when(F.col("l_linestatus") == "F", date_to_day_number(F.col("l_shipdate")))).alias("depdate"),
        dbl(mode).alias("i94mode"),
        addr.alias("i94addr"),
        F.col("l_quantity").alias("i94bir"),
        dbl(1 + F.col("p_size") % 3).alias("i94visa"),
        F.col("l_returnflag").alias("gender"),
        F.col("p_type").alias("airline"),
        F.col("l_partkey").cast("string").alias("fltno"),
        F.col("c_mktsegment").alias("visatype"),
    )


def temperature_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("seq"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("s_acctbal").cast("string")).alias("AverageTemperature"),
        F.col("s_name").alias("City"),
        F.concat(F.lit("Nation_"), F.col("s_nationkey").cast("string")).alias("Country"),
        F.concat((F.col("s_suppkey") % 90).cast("string"), F.lit("N")).alias("Latitude"),
        F.concat((F.col("s_suppkey") % 180).cast("string"), F.lit("E")).alias("Longitude"),
    )


def demographics_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("seq"),
        F.col("p_name").alias("City"),
        F.concat(F.lit("State "), F.col("p_brand")).alias("State"),
        F.col("p_brand").alias("State_Code"),
        F.col("p_type").alias("Race"),
        F.col("p_size").alias("Count_"),
        F.floor("p_retailprice").cast("int").alias("Total_Population"),
        F.col("p_retailprice").alias("Median_Age"),
    )


def lookup_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("Code"),
        F.upper(F.concat(F.lit("state-"), F.col("p_brand"))).alias("State")).distinct()
    other = spark.sql("SELECT * FROM VALUES ('99', 'All Other Codes'), ('NO', 'no-one''s land') AS t(Code, State)")
    return brands.unionByName(other)


def lookup_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    label = (F.when(F.col("n_nationkey") % 7 == 3, F.concat(F.lit(INVALID_PREFIX), F.col("n_name")))
             .otherwise(F.col("n_name")))
    extra = spark.sql("SELECT CAST(999 AS INT) AS Code, 'STATELESS' AS I94CTRY")
    return n.select(F.col("n_nationkey").cast("int").alias("Code"), label.alias("I94CTRY")).unionByName(extra)


def lookup_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ID, Port) for every order priority; the entry of '5-LOW' is published under the code
    '5-LO', so that code of the data stays undecoded."""
    code = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("5-LO")).otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        code.alias("ID"), F.concat(F.lit("PORT "), F.substring("o_orderpriority", 3, 100)).alias("Port")).distinct()

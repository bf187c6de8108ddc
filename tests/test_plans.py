"""Plan checks: native expressions only, pruned scans, broadcast joins on the fact."""

import pytest

from portolan.registry import QUERIES
from tests.conftest import SF_SMALL

PLAN_QUERIES = ["immigration_fact", "date_dimension", "city_demographics", "country_dimension", "star_join",
                "destination_source_lift", "title_case", "decode_codes", "dq_orphans", "sas_dates", "stay_length"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_python_in_plans(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_star_join_broadcasts_dimensions(spark):
    plan = _plan(QUERIES["star_join"](spark, SF_SMALL))
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan


def test_fact_scan_is_pruned(spark):
    plan = _plan(QUERIES["visitors_by_airline"](spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "visits_raw" in line and "FileScan" in line][0]
    assert "ReadSchema: struct<airline:string>" in scan

"""Every query against its SQL counterpart."""

import pytest
from conftest import SF
from oracle import connect, differences

from wattline.plans.catalog import QUERIES
from wattline.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_multiplies_rows_without_a_key(spark):
    for name in sorted(set(QUERIES) - {"fit_predict", "feature_importance", "streamed_trips", "streamed_trip_states", "incremental_load", "file_fingerprints"}):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_scans_read_what_they_need(spark):
    plan = plan_of(QUERIES["day_slice"](spark, SF))
    assert "GreaterThanOrEqual(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(QUERIES["regression_metrics"](spark, SF))
    assert "l_shipdate" not in plan.split("ReadSchema")[1]

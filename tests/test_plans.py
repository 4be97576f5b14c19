"""Plan properties of the registered queries (what Catalyst must produce)."""

import re

from conftest import SF001
from tidewater.plans import QUERIES


def _plan(spark, name):
    return QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop(spark):
    for name, fn in QUERIES.items():
        if name in ("forest_eval", "logistic_eval", "kmeans_sizes", "pca_embeddings"):
            continue  # these train a model while building the frame
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_filters_reach_the_scan(spark):
    assert "EqualTo(user_id,8)" in _plan(spark, "point_lookup")
    assert "EqualTo(event_type,error)" in _plan(spark, "point_lookup")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,", _plan(spark, "recent_rows"))
    assert "StringStartsWith(url,https://)" in _plan(spark, "url_prefix")
    assert "EqualTo(l_returnflag,R)" in _plan(spark, "update_status")


def test_projection_reaches_the_scan(spark):
    plan = _plan(spark, "cost_rollup")
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan


def test_alarm_reads_events_once(spark):
    """In the plan that ran: the spans of the keys and the rows share one shuffle of the statistics."""
    df = QUERIES["alarm_2x5min"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan and plan.count("FileScan") == 1


def test_usage_summed_before_price_join(spark):
    plan = _plan(spark, "cost_rollup")
    join_at = min(i for i in (plan.find("BroadcastHashJoin"), plan.find("SortMergeJoin")) if i >= 0)
    m = re.search(r"partial_sum\(l_quantity#\d+\)", plan)
    assert m and m.start() > join_at  # deeper in the tree = earlier in execution


def test_latest_per_key_is_partial(spark):
    plan = _plan(spark, "upsert_latest")
    assert "partial_max_by" in plan and "Window" not in plan

"""Physical-plan properties of the batch queries (the shapes the design relies on)."""

import re

import pytest

from inboxlens.plans.catalog import BATCH_QUERIES
from tests.conftest import SF_SMALL


def _plan(spark, name):
    return BATCH_QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan):
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_all_pairs_joins_and_pruned_event_scans(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for cols in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*events\.parquet", plan):
        assert "value" not in cols  # the unused measure column is never read


def test_shuffle_counts(spark):
    # one partial aggregate feeding a top-k; names joined by broadcasting the top-k side
    assert _shuffles(_plan(spark, "campaign_effectiveness")) == 1
    # map-only: geography joins broadcast, decode in the same stage
    assert _shuffles(_plan(spark, "json_roundtrip_events")) == 0
    assert _shuffles(_plan(spark, "events_by_campaign_city")) == 1
    assert _shuffles(_plan(spark, "deliverability")) == 1


def test_top_k_is_taken_before_the_lookup_join(spark):
    plan = _plan(spark, "product_popularity")
    build = plan[plan.index("BroadcastExchange"):]
    assert "TakeOrderedAndProject" in build  # the broadcast side is the k-row result


def test_session_window_runs_over_bucket_summaries(spark):
    plan = _plan(spark, "customer_sessions")
    window_input = plan[plan.index("Window [lag("):]
    # below the ordered window there is an aggregate over (customer, bucket)
    assert "HashAggregate(keys=[customer_id" in window_input


def test_user_agent_rules_run_after_pre_aggregation(spark):
    plan = _plan(spark, "client_mix")
    # the rules are evaluated in the result of the (campaign, agent) aggregate,
    # i.e. once per distinct pair, not once per event
    assert re.search(r"HashAggregate\(keys=\[campaign_id#\d+L?, user_agent#\d+L?\], "
                     r"functions=\[count\(1\)\], output=\[[^\]]*browser_name", plan)

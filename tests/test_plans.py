"""Shapes of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

from ringledger.operators.callbacks import callback_pairs, repeat_flags
from ringledger.operators.skew import rows_of_keys
from ringledger.plans.models import MODELS, LazyTables
from ringledger.sources.stand_in import inputs


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return LazyTables(inputs(spark, sf_dir))


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [model.name for model in MODELS])
def test_no_join_compares_every_row_with_every_other(lazy, name):
    plan = planned(lazy[name])
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("name", [model.name for model in MODELS])
def test_no_python_in_the_plans(lazy, name):
    assert "Python" not in planned(lazy[name]) and "Pandas" not in planned(lazy[name])


def test_scan_reads_only_the_columns_needed(lazy):
    plan = planned(lazy["daily_agent_call_metrics_source"])
    (events,) = [line for line in plan.splitlines() if "events.parquet" in line]
    assert "value" not in events.split("ReadSchema:")[1]


def test_tickets_are_merged_however_small_their_files(spark, sf_dir, tmp_path):
    """Only the chunks of full cells are sent to the tickets."""
    LazyTables(inputs(spark, sf_dir))["mart_crm"].write.parquet(str(tmp_path / "tickets"))
    tickets = spark.read.parquet(str(tmp_path / "tickets"))
    pairs, flags = planned(callback_pairs(tickets)), planned(repeat_flags(tickets))
    assert "SortMergeJoin" in pairs and pairs.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" in flags and "BroadcastHashJoin" not in flags


def test_pair_join_has_both_bounds_and_no_gathering(lazy):
    plan = planned(lazy["mart_crm_callbacks"])
    assert "grid_row" in plan and "grid_column" in plan
    assert "SinglePartition" not in plan.split("SortMergeJoin")[0]


def final_plan(df) -> str:
    """The plan that ran, without the first one that adaptive execution replaced."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


def test_pairs_read_their_input_twice_at_most(lazy, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = final_plan(lazy["mart_crm_callbacks"])
    assert plan.count("events.parquet") <= 2 and "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["mart_crm_callbacks", "mart_first_call_resolution"])
def test_no_cap_on_hot_keys(lazy, name):
    plan = planned(lazy[name])
    assert not any(cap in plan for cap in ("LocalLimit", "GlobalLimit", "TakeOrdered"))


@pytest.fixture
def small_partitions(conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "20")


def test_hot_topics_are_split(spark, small_partitions):
    tickets = spark.range(0, 20_000, 1, 8).selectExpr(
        "id AS crm_id", "id % 7 AS agent_id", "'a' AS agent_name",
        "TIMESTAMP_NTZ'2024-01-16 00:00:00' + make_dt_interval(0, 0, 0, id) AS created_ts",
        "true AS previous_issue_flag", "IF(id % 3 = 0, id, 0) AS customer_id", "'r' AS reason_code", "'s' AS sub_reason_code",
    )
    assert "skew=true" in final_plan(repeat_flags(tickets))


def test_rows_of_a_hot_key_are_split(spark, small_partitions):
    facts = spark.range(0, 20_000, 1, 8).selectExpr("IF(id % 3 = 0, id, 0) AS key", "id AS value")
    repeated = facts.groupBy("key").count().where("count > 1")
    found = rows_of_keys(facts, repeated, ["key"])
    assert "skew=true" in final_plan(found)
    assert found.count() == facts.where("key = 0").count()


def test_tickets_are_not_shuffled_to_find_full_cells(lazy, conf):
    """Pairs are dealt once for their join; what is known of full cells, mostly nothing, comes to the tickets."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    plan = planned(callback_pairs(lazy["mart_crm"]))
    assert "BroadcastHashJoin" in plan and "LeftOuter" not in [line.split()[-1] for line in plan.splitlines() if "SortMergeJoin" in line]
    assert plan.count("_mixed_keys") == 0

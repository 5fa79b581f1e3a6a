from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ringledger.functions.columns import OPEN_END, days_crossed, recommendation_class
from ringledger.operators.assignments import segments_from_changes, with_manager
from ringledger.operators.enrich import enrich_calls, enrich_surveys
from ringledger.operators.scorecard import daily_calls, daily_surveys, scorecard
from ringledger.schemas import AGENT_ASSIGNMENTS, AGENTS, DATASETS, MANAGERS
from tests.conftest import at, rows

DAY = date(2024, 1, 30)
NEXT = date(2024, 1, 31)


def calls_daily(spark, *entries):
    return spark.createDataFrame(
        list(entries),
        "agent_id bigint, agent_name string, call_date date, duration_sum bigint, agent_hold_time_sum bigint, "
        "transfer_sum bigint, call_count bigint, manager_id bigint, manager_name string",
    )


def tickets_daily(spark, *entries):
    return spark.createDataFrame(
        list(entries),
        "agent_id bigint, agent_name string, call_date date, fcr_sum bigint, fcr_denom bigint, "
        "manager_id bigint, manager_name string",
    )


def surveys_daily(spark, *entries):
    return spark.createDataFrame(
        list(entries),
        "agent_id bigint, agent_name string, survey_date date, csat_sum bigint, nps_calc_sum bigint, "
        "survey_count bigint, manager_id bigint, manager_name string",
    )


def test_recommendation_class(spark):
    scores = spark.createDataFrame([(n,) for n in (0, 6, 7, 8, 9, 10, None)], "nps bigint")
    found = {r["nps"]: r["c"] for r in scores.selectExpr("nps", f"{recommendation_class('nps')} AS c").collect()}
    assert found == {0: -1, 6: -1, 7: 0, 8: 0, 9: 1, 10: 1, None: None}


def test_days_crossed_counts_midnights(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(
            [("2024-01-16 23:00:00", "2024-01-17 01:00:00"), ("2024-01-16 00:00:00", "2024-01-16 23:59:00")],
            "a string, b string",
        )
        gap = df.selectExpr(f"CAST(a AS {kind}) AS a", f"CAST(b AS {kind}) AS b").selectExpr(
            f"{days_crossed('a', 'b')} AS d"
        )
        assert [r["d"] for r in gap.collect()] == [1, 0]


def test_manager_changes_the_day_after_the_segment_ends(spark):
    daily = spark.createDataFrame([(1, DAY, 5), (1, NEXT, 6), (2, DAY, 7)], "agent_id bigint, call_date date, n int")
    segments = spark.createDataFrame(
        [
            (1, 10, date(2024, 1, 1), DAY),
            (1, 20, NEXT, OPEN_END),
            (2, 10, NEXT, DAY),  # empty: ends before it starts
        ],
        AGENT_ASSIGNMENTS,
    )
    managers = spark.createDataFrame([(10, "Old"), (20, "New")], MANAGERS)
    found = with_manager(daily, "call_date", segments, managers)
    assert rows(found) == [(1, DAY, 5, 10, "Old"), (1, NEXT, 6, 20, "New")]


def test_segments_from_changes(spark):
    changes = spark.createDataFrame(
        [
            (1, "a", at("01-05 09:00")),
            (1, "b", at("01-10 09:00")),
            (1, "c", at("01-10 17:00")),
            (2, "a", at("01-07 00:00")),
        ],
        "agent bigint, manager string, ts timestamp_ntz",
    )
    assert rows(segments_from_changes(changes, "agent", "manager", "ts")) == [
        (1, "a", date(2024, 1, 5), date(2024, 1, 9)),
        (1, "c", date(2024, 1, 10), OPEN_END),
        (2, "a", date(2024, 1, 7), OPEN_END),
    ]


def test_facts_without_agent_or_customer_are_dropped(spark):
    calls = spark.createDataFrame(
        [(n, agent, customer, 0, at("01-16 09:00"), at("01-16 09:05"), 300, 0, False)
         for n, agent, customer in [(1, 1, 1), (2, 9, 1), (3, 1, 9), (4, None, 1)]],
        DATASETS["calls"].columns,
    )
    agents = spark.createDataFrame([(1, "Ann")], AGENTS)
    customers = spark.createDataFrame([(1, "gold")], "customer_id bigint, program string")
    kept = enrich_calls(calls, agents, customers)
    assert [(r["call_id"], r["agent_name"], r["customer_program"]) for r in kept.collect()] == [(1, "Ann", "gold")]


def test_hot_customer_is_split_in_the_dimension_join(spark, conf):
    """A third of the facts of one customer: AQE splits that partition."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50KB")
    conf("spark.sql.shuffle.partitions", "16")
    surveys = spark.range(120_000, numPartitions=8).select(
        F.col("id").alias("survey_id"),
        F.col("id").alias("call_id"),
        (F.col("id") % 40).alias("agent_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("customer_id"),
        F.lit(at("01-16 23:00")).cast("timestamp_ntz").alias("sent_ts"),
        F.lit(at("01-17 01:00")).cast("timestamp_ntz").alias("response_ts"),
        F.lit(5).cast("bigint").alias("csat"),
        F.lit(9).cast("bigint").alias("nps"),
    )
    agents = spark.range(40).select(F.col("id").alias("agent_id"), F.col("id").cast("string").alias("agent_name"))
    customers = spark.range(5000).select(F.col("id").alias("customer_id"), F.lit("p").alias("program"))
    joined = enrich_surveys(surveys, agents, customers)
    assert joined.count() == 120_000
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined.groupBy("days_to_respond", "nps_calc").count()) == [(1, 1, 120_000)]


def test_daily_sums(spark):
    segments = spark.createDataFrame([(1, 10, date(2024, 1, 1), OPEN_END)], AGENT_ASSIGNMENTS)
    managers = spark.createDataFrame([(10, "Max")], MANAGERS)
    calls = spark.createDataFrame(
        [(1, "Ann", at("01-30 09:00"), 100, 10, True), (1, "Ann", at("01-30 23:59"), 50, 0, None)],
        "agent_id bigint, agent_name string, start_ts timestamp_ntz, duration_s bigint, "
        "hold_time_during_call_s bigint, transfer_flag boolean",
    )
    assert rows(daily_calls(calls, segments, managers)) == [(1, "Ann", DAY, 150, 10, 1, 2, 10, "Max")]
    surveys = spark.createDataFrame(
        [(1, "Ann", at("01-30 09:00"), 4, 1), (1, "Ann", at("01-30 10:00"), None, None)],
        "agent_id bigint, agent_name string, sent_ts timestamp_ntz, csat bigint, nps_calc int",
    )
    # An answer without a score counts as an answer.
    assert rows(daily_surveys(surveys, segments, managers)) == [(1, "Ann", DAY, 4, 1, 2, 10, "Max")]


def test_calls_are_the_base_of_a_scorecard(spark):
    card = scorecard(
        calls_daily(spark, (1, "Ann", DAY, 300, 30, 1, 4, 10, "Max")),
        tickets_daily(spark, (1, "Ann", DAY, 3, 4, 10, "Max"), (1, "Ann", NEXT, 1, 1, 10, "Max")),
        surveys_daily(spark, (1, "Ann", NEXT, 5, 1, 1, 10, "Max")),
    )
    assert card.columns == [
        "agent_id", "agent_name", "call_date", "call_count", "customer_resolution_time", "avg_hold_time",
        "transfer_rate", "first_call_resolution", "survey_count", "csat", "nps",
    ]
    assert rows(card) == [(1, "Ann", DAY, 4, 75.0, 7.5, 0.25, 0.75, 0, None, None)]


def test_manager_change_within_a_month(spark):
    sources = (
        calls_daily(spark, (1, "Ann", DAY, 100, 0, 0, 1, 10, "Max"), (1, "Ann", NEXT, 500, 30, 3, 3, 20, "Mia")),
        tickets_daily(spark, (1, "Ann", DAY, 1, 1, 10, "Max"), (1, "Ann", NEXT, 0, 3, 20, "Mia")),
        surveys_daily(spark, (1, "Ann", DAY, 5, 1, 1, 10, "Max"), (1, "Ann", NEXT, 2, -2, 2, 20, "Mia")),
    )
    month = date(2024, 1, 1)
    by_agent = scorecard(*sources, monthly=True)
    # Ratios of sums: the average of daily averages would be (100 + 166.7) / 2.
    assert rows(by_agent) == [(1, "Ann", month, 150.0, 7.5, 0.75, 0.25, 3, 7 / 3, -100 / 3)]
    by_both = scorecard(*sources, by_manager=True, monthly=True)
    assert rows(by_both.select("agent_id", "manager_id", "manager_name", "call_month", "nps")) == [
        (1, 10, "Max", month, 100.0),
        (1, 20, "Mia", month, -100.0),
    ]
    by_manager = scorecard(*sources, by_agent=False, by_manager=True, monthly=True)
    assert "agent_id" not in by_manager.columns and by_manager.count() == 2


def test_scorecard_needs_one_exchange(spark):
    card = scorecard(
        calls_daily(spark, (1, "Ann", DAY, 300, 30, 1, 4, 10, "Max")),
        tickets_daily(spark, (1, "Ann", DAY, 3, 4, 10, "Max")),
        surveys_daily(spark, (1, "Ann", NEXT, 5, 1, 1, 10, "Max")),
    )
    plan = card._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

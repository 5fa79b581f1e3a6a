from __future__ import annotations

from datetime import date

import pytest

from ringledger.operators import insights
from tests.conftest import rows

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_extremes_break_ties_by_agent(spark):
    daily = spark.createDataFrame(
        [(3, "C", 0.9), (2, "B", 0.9), (1, "A", 0.2), (1, "A", 0.4), (4, "D", None)],
        "agent_id bigint, agent_name string, first_call_resolution double",
    )
    assert rows(insights.resolution_extremes(daily)) == [("highest", 2, "B", 0.9), ("lowest", 1, "A", 0.3)]


def test_extremes_are_ranked_before_they_are_rounded(spark):
    daily = spark.createDataFrame(
        [(1, "A", 0.5000001), (2, "B", 0.5000004), (3, "C", 0.5000002)],
        "agent_id bigint, agent_name string, first_call_resolution double",
    )
    assert rows(insights.resolution_extremes(daily)) == [("highest", 2, "B", 0.5), ("lowest", 1, "A", 0.5)]


def test_extremes_do_not_depend_on_the_order_of_rows(spark):
    third = [(1, "A", 1 / 3), (1, "A", 1 / 3), (1, "A", 1 / 3)]
    other = [(2, "B", 0.1), (2, "B", 0.7), (2, "B", 0.2)]
    layout = "agent_id bigint, agent_name string, first_call_resolution double"
    for order in (third + other, other[::-1] + third):
        found = rows(insights.resolution_extremes(spark.createDataFrame(order, layout)))
        assert [r[1] for r in found] == [1, 1]  # equal averages, so the lower id


def test_no_best_manager_in_a_latest_month_without_scores(spark):
    monthly = spark.createDataFrame(
        [(1, "Max", JAN, 5.0), (1, "Max", FEB, None)],
        "manager_id bigint, manager_name string, call_month date, csat double",
    )
    assert rows(insights.best_manager_of_latest_month(monthly)) == []


def test_best_manager_is_from_the_latest_month_with_answers(spark):
    monthly = spark.createDataFrame(
        [(1, "Max", JAN, 5.0), (1, "Max", FEB, 4.0), (2, "Mia", FEB, 4.5), (3, "Moe", FEB, None)],
        "manager_id bigint, manager_name string, call_month date, csat double",
    )
    assert rows(insights.best_manager_of_latest_month(monthly)) == [(2, "Mia", FEB, 4.5)]


def test_correlation(spark):
    daily = spark.createDataFrame(
        [(1, "A", 1.0, 0.1), (1, "A", 2.0, 0.2), (1, "A", 3.0, 0.3), (2, "B", 1.0, 0.1), (2, "B", 1.0, 0.3)],
        "agent_id bigint, agent_name string, avg_hold_time double, transfer_rate double",
    )
    assert rows(insights.hold_transfer_correlation(daily)) == [(1, "A", 3, 1.0), (2, "B", 2, None)]
    # Covariance 0.04 over deviations 0.8 and sqrt(0.008).
    (overall,) = insights.hold_transfer_correlation_overall(daily).collect()
    assert overall["agent_months"] == 5 and overall["hold_transfer_correlation"] == pytest.approx(0.559017)


def test_drilldown(spark):
    figures = (
        "customer_resolution_time double, transfer_rate double, first_call_resolution double, "
        "survey_count bigint, csat double, nps double"
    )
    team = spark.createDataFrame(
        [(1, "Max", JAN, 10.0, 0.5, 0.5, 3, 4.0, 10.0), (2, "Mia", JAN, 20.0, 0.1, 0.9, 1, 5.0, 100.0)],
        f"manager_id bigint, manager_name string, call_month date, {figures}",
    )
    members = spark.createDataFrame(
        [
            (7, "Ann", 1, "Max", JAN, 12.0, 0.5, 0.5, 1, 4.0, 0.0),
            (8, "Bob", 1, "Max", JAN, 8.0, 0.5, 0.5, 2, 4.0, 15.0),
            (8, "Bob", 2, "Mia", JAN, 20.0, 0.1, 0.9, 1, 5.0, 100.0),
        ],
        f"agent_id bigint, agent_name string, manager_id bigint, manager_name string, call_month date, {figures}",
    )
    everyone = insights.manager_drilldown(team, members)
    assert everyone.count() == 3
    max_team = insights.manager_drilldown(team, members, manager_id=1)
    found = max_team.select("manager_name", "agent_name", "team_nps", "agent_nps")
    assert rows(found) == [("Max", "Ann", 10.0, 0.0), ("Max", "Bob", 10.0, 15.0)]

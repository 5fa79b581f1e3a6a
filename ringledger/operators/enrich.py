"""Facts joined to their agent and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ringledger.functions.columns import days_crossed, recommendation_class


def _with_names(facts: DataFrame, agents: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the agent's name and the customer's program; facts without either are dropped.

    No broadcast hint: Spark broadcasts a dimension it measures as small and
    otherwise sort-merge joins, splitting the partition of a hot customer. A stored
    seed that is large in memory asks for the latter itself.
    """
    names = agents.selectExpr("agent_id", "agent_name")
    programs = customers.selectExpr("customer_id", "program AS customer_program")
    return facts.join(names, "agent_id").join(programs, "customer_id")


def enrich_calls(staged: DataFrame, agents: DataFrame, customers: DataFrame) -> DataFrame:
    return _with_names(staged, agents, customers).selectExpr(
        "call_id", "agent_id", "agent_name", "customer_id", "customer_program", "queue_hold_time",
        "start_ts", "end_ts", "duration_s", "hold_time_during_call_s", "transfer_flag",
    )


def enrich_tickets(staged: DataFrame, agents: DataFrame, customers: DataFrame) -> DataFrame:
    return _with_names(staged, agents, customers).selectExpr(
        "crm_id", "agent_id", "agent_name", "call_id", "customer_id", "customer_program",
        "reason_code", "sub_reason_code", "previous_issue_flag", "created_ts",
    )


def enrich_surveys(staged: DataFrame, agents: DataFrame, customers: DataFrame) -> DataFrame:
    return _with_names(staged, agents, customers).selectExpr(
        "survey_id", "call_id", "agent_id", "agent_name", "customer_id", "customer_program",
        "sent_ts", "response_ts", f"{days_crossed('sent_ts', 'response_ts')} AS days_to_respond",
        "csat", "nps", f"{recommendation_class('nps')} AS nps_calc",
    )

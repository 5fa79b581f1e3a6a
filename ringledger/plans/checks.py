"""The 116 expectations on seeds and tables."""

from __future__ import annotations

from dataclasses import replace

from ringledger.operators.quality import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    UNIQUE_COMBINATION,
    Check,
)


def _unique(table: str, *columns: str) -> Check:
    return Check(table, UNIQUE if len(columns) == 1 else UNIQUE_COMBINATION, columns)


def _not_null(table: str, column: str) -> Check:
    return Check(table, NOT_NULL, (column,))


def _one_of(table: str, column: str, *values: int) -> Check:
    return Check(table, ACCEPTED_VALUES, (column,), values=values)


def _refers(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(table, RELATIONSHIPS, (column,), parent=(parent, parent_column))


def _true(table: str, expression: str) -> Check:
    return Check(table, EXPRESSION, expression=expression)


def _record_key(table: str, column: str) -> list[Check]:
    return [_unique(table, column), _not_null(table, column)]


# What a scorecard's figures may be. The last three can be missing.
SCORECARD_RULES = (
    "customer_resolution_time >= 0",
    "avg_hold_time >= 0",
    "transfer_rate between 0 and 1",
    "first_call_resolution is null or (first_call_resolution >= 0 and first_call_resolution <= 1)",
    "csat is null or (csat >= 1 and csat <= 5)",
    "nps is null or (nps >= -100 and nps <= 100)",
)


def _daily_sums(table: str, day: str, *required: str) -> list[Check]:
    columns = ("agent_id", day, *required)
    return [*[_not_null(table, c) for c in columns], _unique(table, "agent_id", day)]


def _scorecard(table: str, keys: tuple[str, ...], counts: tuple[str, ...]) -> list[Check]:
    return [
        *[_not_null(table, c) for c in (*keys, *counts)],
        _unique(table, *keys),
        *[_true(table, rule) for rule in SCORECARD_RULES],
    ]


# The expectations, table by table.
CHECKS: tuple[Check, ...] = (
    _refers("agent_assignments", "agent_id", "agents", "agent_id"),
    _refers("agent_assignments", "manager_id", "managers", "manager_id"),
    *_record_key("agents", "agent_id"),
    *_record_key("managers", "manager_id"),
    *_record_key("customers", "customer_id"),
    *_record_key("stg_calls", "call_id"),
    _true("stg_calls", "end_ts > start_ts"),
    _true("stg_calls", "duration_s > 0"),
    *_record_key("stg_crm", "crm_id"),
    *_record_key("stg_surveys", "survey_id"),
    _one_of("stg_surveys", "csat", 1, 2, 3, 4, 5),
    _one_of("stg_surveys", "nps", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10),
    *_record_key("mart_calls", "call_id"),
    _true("mart_calls", "end_ts > start_ts"),
    _true("mart_calls", "duration_s > 0"),
    *_record_key("mart_crm", "crm_id"),
    _not_null("mart_crm_callbacks", "original_crm_id"),
    _refers("mart_crm_callbacks", "original_crm_id", "mart_crm", "crm_id"),
    _not_null("mart_crm_callbacks", "callback_crm_id"),
    _refers("mart_crm_callbacks", "callback_crm_id", "mart_crm", "crm_id"),
    _not_null("mart_crm_callbacks", "same_reason_flag"),
    _not_null("mart_crm_callbacks", "same_sub_reason_flag"),
    _not_null("mart_crm_callbacks", "callback_previous_issue_flag"),
    _unique("mart_crm_callbacks", "original_crm_id", "callback_crm_id"),
    _true("mart_crm_callbacks", "original_crm_id <> callback_crm_id"),
    _true("mart_crm_callbacks", "callback_created_ts > original_created_ts"),
    *_record_key("mart_first_call_resolution", "crm_id"),
    _not_null("mart_first_call_resolution", "agent_id"),
    _not_null("mart_first_call_resolution", "fcr_date"),
    _not_null("mart_first_call_resolution", "fcr_denom"),
    _one_of("mart_first_call_resolution", "fcr_denom", 1),
    _not_null("mart_first_call_resolution", "fcr_num"),
    _one_of("mart_first_call_resolution", "fcr_num", 0, 1),
    *_record_key("mart_surveys", "survey_id"),
    _one_of("mart_surveys", "csat", 1, 2, 3, 4, 5),
    _one_of("mart_surveys", "nps", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10),
    _one_of("mart_surveys", "nps_calc", -1, 0, 1),
    _true("mart_surveys", "response_ts >= sent_ts"),
    *_daily_sums("daily_agent_call_metrics_source", "call_date", "call_count", "manager_id"),
    *_daily_sums("daily_agent_crm_metrics_source", "call_date", "manager_id"),
    *_daily_sums("daily_agent_survey_metrics_source", "survey_date", "survey_count", "manager_id"),
    *_scorecard("daily_agent_metrics", ("agent_id", "call_date"), ("call_count", "survey_count")),
    *_scorecard(
        "daily_agent_manager_metrics",
        ("agent_id", "manager_id", "call_date"),
        ("call_count", "survey_count"),
    ),
    *_scorecard("monthly_agent_metrics", ("agent_id", "call_month"), ("survey_count",)),
    *_scorecard(
        "monthly_agent_manager_metrics", ("agent_id", "manager_id", "call_month"), ("survey_count",)
    ),
    *_scorecard("monthly_manager_metrics", ("manager_id", "call_month"), ("survey_count",)),
)

# The staging expectations asked of the raw feeds: records that were loaded more
# than once fail uniqueness there, and only there.
RAW_CHECKS: tuple[Check, ...] = tuple(
    replace(check, table=check.table.replace("stg_", "raw_", 1))
    for check in CHECKS
    if check.table.startswith("stg_")
)

"""Daily additive sums per agent, and the scorecards computed from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.operators.assignments import with_manager
from ringledger.window import Span

MONTH = "call_month"
_MONTH_OF = "CAST(trunc(day, 'month') AS DATE)"
AGENT = ("agent_id", "agent_name")
MANAGER = ("manager_id", "manager_name")


def _per_day(facts: DataFrame, day: str, *sums: str) -> DataFrame:
    """``facts`` summed per agent and day; ``day`` and ``sums`` are SQL with aliases."""
    return facts.groupBy(*AGENT, F.expr(day)).agg(*map(F.expr, sums))


def daily_calls(calls: DataFrame, assignments: DataFrame, managers: DataFrame) -> DataFrame:
    per_day = _per_day(
        calls,
        "to_date(start_ts) AS call_date",
        "sum(duration_s) AS duration_sum",
        "sum(hold_time_during_call_s) AS agent_hold_time_sum",
        "count_if(transfer_flag) AS transfer_sum",
        "count(1) AS call_count",
    )
    return with_manager(per_day, "call_date", assignments, managers)


def daily_resolution(resolution: DataFrame, assignments: DataFrame, managers: DataFrame) -> DataFrame:
    per_day = _per_day(
        resolution,
        "fcr_date AS call_date",
        "sum(fcr_num) AS fcr_sum",
        "sum(fcr_denom) AS fcr_denom",
    )
    return with_manager(per_day, "call_date", assignments, managers)


def daily_surveys(surveys: DataFrame, assignments: DataFrame, managers: DataFrame) -> DataFrame:
    """By the day a survey was sent, so an answer counts for the day of its call.

    ``survey_count`` counts answers without a score too.
    """
    per_day = _per_day(
        surveys,
        "to_date(sent_ts) AS survey_date",
        "sum(csat) AS csat_sum",
        "sum(nps_calc) AS nps_calc_sum",
        "count(1) AS survey_count",
    )
    return with_manager(per_day, "survey_date", assignments, managers)


# Scorecard figures as ratios of sums. A group always has a row, but NULL rather
# than an error is the answer for one without tickets or surveys.
FIGURES = {
    "customer_resolution_time": "try_divide(sum(duration_sum), sum(call_count))",
    "avg_hold_time": "try_divide(sum(agent_hold_time_sum), sum(call_count))",
    "transfer_rate": "try_divide(sum(transfer_sum), sum(call_count))",
    "first_call_resolution": "try_divide(sum(fcr_sum), sum(fcr_denom))",
    "survey_count": "coalesce(sum(survey_count), 0)",
    "csat": "try_divide(sum(csat_sum), sum(survey_count))",
    # Promoters minus detractors in percent of all answers: -100 to 100.
    "nps": "try_divide(CAST(sum(nps_calc_sum) AS DOUBLE) * 100, sum(survey_count))",
}


def _stacked(calls: DataFrame, tickets: DataFrame, surveys: DataFrame) -> DataFrame:
    """The rows of the three daily tables one below the other. Only calls name their agent and manager."""
    named = calls.selectExpr(
        *AGENT, *MANAGER, "call_date AS day", "call_date AS named_on",
        "call_count", "duration_sum", "agent_hold_time_sum", "transfer_sum",
    )
    solved = tickets.selectExpr("agent_id", "manager_id", "call_date AS day", "fcr_sum", "fcr_denom")
    rated = surveys.selectExpr(
        "agent_id", "manager_id", "survey_date AS day", "csat_sum", "nps_calc_sum", "survey_count"
    )
    return named.unionByName(solved, allowMissingColumns=True).unionByName(rated, allowMissingColumns=True)


def _rates(stacked: DataFrame, period: str, by_agent: bool, by_manager: bool) -> DataFrame:
    """Ratios of summed parts per agent and/or manager and period. A key without calls has no row."""
    dimensions = (AGENT if by_agent else ()) + (MANAGER if by_manager else ())
    ids = [name for name in dimensions if name.endswith("_id")]
    names = [name for name in dimensions if name.endswith("_name")]
    totals = [
        *[f"max_by({name}, struct(named_on, {name})) AS {name}" for name in names],
        "sum(call_count) AS call_count",
        *[f"{figure} AS {name}" for name, figure in FIGURES.items()],
    ]
    # Monthly scorecards do not show the number of calls.
    shown = FIGURES if period == MONTH else ("call_count", *FIGURES)
    return (
        stacked.groupBy(*ids, period)
        .agg(*map(F.expr, totals))
        .where("call_count IS NOT NULL")
        .selectExpr(*dimensions, period, *shown)
    )


def scorecard(
    calls: DataFrame,
    tickets: DataFrame,
    surveys: DataFrame,
    *,
    by_agent: bool = True,
    by_manager: bool = False,
    monthly: bool = False,
) -> DataFrame:
    """Rates per agent and/or manager and day or month, as ratios of summed parts.

    The three daily tables are stacked and summed in one grouping instead of
    being grouped apart and joined: one exchange on the reporting key rather
    than three plus the joins. Calls are the base: a key without calls has no row.
    """
    stacked = _stacked(calls, tickets, surveys)
    period = F.expr(_MONTH_OF).alias(MONTH) if monthly else F.col("day").alias("call_date")
    return _rates(stacked.select("*", period), MONTH if monthly else "call_date", by_agent, by_manager)


def month_parts(calls: DataFrame, tickets: DataFrame, surveys: DataFrame) -> DataFrame:
    """What the months of an agent under a manager are made of: the daily sums, listed in one row per month.

    Three entries a day at most, so a row has a fixed bound.
    """
    stacked = _stacked(calls, tickets, surveys)
    entry = F.struct(*[name for name in stacked.columns if name not in ("agent_id", "manager_id")])
    month = F.expr(_MONTH_OF).alias(MONTH)
    return stacked.groupBy("agent_id", "manager_id", month).agg(F.sort_array(F.collect_list(entry)).alias("days"))


def with_days_replaced(stored: DataFrame, fresh: DataFrame, touched: Span) -> DataFrame:
    """``stored`` month parts whose entries of the ``touched`` days are taken out and replaced by ``fresh`` ones.

    What was counted for a touched day is told by its entries, not by a difference, so doing this again changes
    nothing and days that are not touched need not be read.
    """
    rest = stored.withColumn("days", F.filter("days", lambda entry: ~touched.holds(entry["day"])))
    both = rest.unionByName(fresh).groupBy("agent_id", "manager_id", MONTH)
    return both.agg(F.sort_array(F.flatten(F.collect_list("days"))).alias("days")).where(F.size("days") > 0)


def monthly_scorecard(parts: DataFrame, *, by_agent: bool = True, by_manager: bool = False) -> DataFrame:
    """``scorecard`` by month, from month parts."""
    return _rates(parts.selectExpr("agent_id", "manager_id", MONTH, "inline(days)"), MONTH, by_agent, by_manager)

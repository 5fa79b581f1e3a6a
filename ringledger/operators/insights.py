"""Questions asked of the scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Figures are shown with this many digits.
DIGITS = 6
# Averages that differ by less are the same number: a double holds no more.
SAME_DIGITS = 14


def resolution_extremes(daily_agent: DataFrame) -> DataFrame:
    """The agents with the highest and the lowest average daily resolution rate.

    Rates are summed as decimals, so the order of rows does not matter, and ranked
    before they are rounded for display. Ties break by id.
    """
    rate = "CAST(first_call_resolution AS DECIMAL(30, 18))"
    by_agent = daily_agent.groupBy("agent_id", "agent_name").agg(
        F.expr(f"round(CAST(sum({rate}) AS DOUBLE) / count(first_call_resolution), {SAME_DIGITS}) AS exact")
    )
    rated = by_agent.where("exact IS NOT NULL")

    def first(place: str, order: Column) -> DataFrame:
        return (
            rated.orderBy(order, "agent_id")
            .limit(1)
            .select(
                F.lit(place).alias("place"),
                "agent_id",
                "agent_name",
                F.round("exact", DIGITS).alias("avg_first_call_resolution"),
            )
        )

    return first("highest", F.desc("exact")).unionByName(first("lowest", F.asc("exact")))


def best_manager_of_latest_month(monthly_manager: DataFrame) -> DataFrame:
    """The manager whose team has the highest satisfaction in the most recent month.

    The most recent month is that of all rows; if nobody has a score in it, there is no such manager.
    """
    latest = monthly_manager.agg(F.max("call_month").alias("call_month"))
    return (
        monthly_manager.join(latest, "call_month", "left_semi")
        .where(F.col("csat").isNotNull())
        .orderBy(F.desc("csat"), "manager_id")
        .limit(1)
        .select("manager_id", "manager_name", "call_month", F.round("csat", DIGITS).alias("csat"))
    )


# NULL where one of the two never changes; corr() itself would divide by zero there.
HOLD_TRANSFER_CORRELATION = f"""
    IF(min(avg_hold_time) < max(avg_hold_time) AND min(transfer_rate) < max(transfer_rate),
       round(try_divide(covar_pop(avg_hold_time, transfer_rate),
                        stddev_pop(avg_hold_time) * stddev_pop(transfer_rate)), {DIGITS}),
       NULL) AS hold_transfer_correlation"""


def hold_transfer_correlation(daily_agent: DataFrame) -> DataFrame:
    """Per agent: do days with longer holds also have more transfers?"""
    return daily_agent.groupBy("agent_id", "agent_name").agg(
        F.expr("count(1) AS days"), F.expr(HOLD_TRANSFER_CORRELATION)
    )


def hold_transfer_correlation_overall(monthly_agent: DataFrame) -> DataFrame:
    """Across agents and months: do agents with longer holds also transfer more?"""
    return monthly_agent.agg(F.expr("count(1) AS agent_months"), F.expr(HOLD_TRANSFER_CORRELATION))


def manager_drilldown(
    monthly_manager: DataFrame, monthly_agent_manager: DataFrame, manager_id: int | None = None
) -> DataFrame:
    """A team's monthly figures beside those of each of its agents.

    One manager, or every manager's team when ``manager_id`` is left out.
    """
    if manager_id is not None:
        monthly_manager = monthly_manager.where(F.col("manager_id") == manager_id)
        monthly_agent_manager = monthly_agent_manager.where(F.col("manager_id") == manager_id)
    figures = ["customer_resolution_time", "transfer_rate", "first_call_resolution", "survey_count", "csat", "nps"]
    team = monthly_manager.select(
        "manager_id", "manager_name", "call_month", *[F.col(f).alias(f"team_{f}") for f in figures]
    )
    members = monthly_agent_manager.select(
        "manager_id", "call_month", "agent_id", "agent_name",
        *[F.col(f).alias(f"agent_{f}") for f in figures],
    )
    return team.join(members, ["manager_id", "call_month"])

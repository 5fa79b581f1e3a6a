"""First-call resolution: was a ticket settled without a matching callback?"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _resolution(checked: DataFrame, missed: str) -> DataFrame:
    return checked.selectExpr(
        "crm_id",
        "agent_id",
        "agent_name",
        "to_date(created_ts) AS fcr_date",
        "1 AS fcr_denom",
        f"IF({missed}, 0, 1) AS fcr_num",
    )


def resolved_unless_flagged(checked: DataFrame) -> DataFrame:
    """Definition in force: the callback must also be marked as a previous issue."""
    return _resolution(checked, "repeated_flagged")


def resolved_unless_repeated(checked: DataFrame) -> DataFrame:
    """Earlier definition: the same reason and sub-reason are enough."""
    return _resolution(checked, "repeated")


def resolved_with_cutover(checked: DataFrame, cutover: date) -> DataFrame:
    """Earlier definition for tickets before ``cutover``, the one in force from then on."""
    return _resolution(checked, f"IF(created_ts < DATE'{cutover}', repeated, repeated_flagged)")


def compare_definitions(checked: DataFrame) -> DataFrame:
    """Resolution under both definitions per day, in one pass over the tickets."""
    return (
        checked.groupBy(F.expr("to_date(created_ts) AS fcr_date"))
        .agg(
            F.expr("count(1) AS tickets"),
            F.expr("count_if(NOT repeated) AS resolved_before"),
            F.expr("count_if(NOT repeated_flagged) AS resolved_after"),
        )
        .selectExpr("*", "resolved_before / tickets AS rate_before", "resolved_after / tickets AS rate_after")
    )

"""Expressions shared by the tables, as SQL over column names.

All of them stay inside whole-stage code generation.
"""

from __future__ import annotations

from datetime import date

# Recommendation scores up to 6 detract, 7 and 8 are passive, 9 and up promote.
DETRACTOR_MAX = 6
PASSIVE_MAX = 8

# Fixed value: end date of a segment that is still open.
OPEN_END = date(2262, 4, 11)


def recommendation_class(score: str) -> str:
    """-1 detractor, 0 passive, 1 promoter; NULL for no answer."""
    return f"""CASE WHEN {score} <= {DETRACTOR_MAX} THEN -1
                    WHEN {score} <= {PASSIVE_MAX} THEN 0
                    WHEN {score} > {PASSIVE_MAX} THEN 1 END"""


def days_crossed(begin: str, finish: str) -> str:
    """Midnights between two moments (not elapsed 24-hour days)."""
    return f"CAST(date_diff(to_date({finish}), to_date({begin})) AS BIGINT)"


def day_number(moment: str) -> str:
    """Days since 1970-01-01, by the calendar, for both timestamp types."""
    return f"unix_date(to_date({moment}))"

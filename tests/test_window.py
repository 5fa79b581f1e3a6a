from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from ringledger.window import EVERYTHING, RunWindow, Span, within_inclusive
from tests.conftest import at


def moments(spark):
    stamps = [at("01-16 00:00"), at("01-16 23:59:59"), at("01-17 00:00"), at("01-17 00:00:01")]
    return spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")


def test_window_is_half_open(spark):
    window = RunWindow.for_day(date(2024, 1, 16))
    assert window.days.keep(moments(spark), "ts").count() == 2
    following = RunWindow.for_day(date(2024, 1, 17))
    assert following.days.keep(moments(spark), "ts").count() == 2


def test_closed_window_takes_midnight_of_the_end_day(spark):
    closed = within_inclusive(F.col("ts"), date(2024, 1, 16), date(2024, 1, 17))
    assert moments(spark).where(closed).count() == 3


def test_range_run():
    assert RunWindow.for_days(date(2024, 1, 16), date(2024, 1, 18)) == RunWindow(date(2024, 1, 16), date(2024, 1, 19))


def test_settled_spans():
    window = RunWindow(date(2024, 2, 3), date(2024, 2, 4))
    assert window.revisable == Span(date(2024, 1, 27), date(2024, 2, 4))
    assert window.callbacks.end >= date(2024, 2, 7)
    assert window.scorecard_days == window.revisable
    assert window.scorecard_months == Span(date(2024, 1, 1), date(2024, 3, 1))


def test_month_span_of_a_window_that_ends_with_the_month():
    window = RunWindow(date(2024, 1, 20), date(2024, 2, 1))
    assert window.scorecard_months == Span(date(2024, 1, 1), date(2024, 2, 1))
    december = RunWindow(date(2024, 12, 20), date(2024, 12, 31))
    assert december.scorecard_months == Span(date(2024, 12, 1), date(2025, 1, 1))


def test_narrow_spans():
    window = RunWindow(date(2024, 2, 3), date(2024, 2, 4), narrow=True)
    assert window.scorecard_days == window.scorecard_months == Span(date(2024, 2, 3), date(2024, 2, 5))
    assert window.callbacks.end == window.end


def test_rejects_windows_that_cannot_work():
    with pytest.raises(ValueError):
        RunWindow(date(2024, 1, 2), date(2024, 1, 2))
    with pytest.raises(ValueError):
        RunWindow(date(2024, 1, 2), date(2024, 1, 3), lookback_days=2)


def test_undated_rows_only_in_the_open_span():
    assert EVERYTHING.holds_day(None)
    assert not Span(date(2024, 1, 1), None).holds_day(None)


def test_span_is_pushed_to_the_scan(spark, tmp_path):
    moments(spark).write.parquet(str(tmp_path / "m"))
    kept = Span(date(2024, 1, 16), date(2024, 1, 17)).keep(spark.read.parquet(str(tmp_path / "m")), "ts")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan

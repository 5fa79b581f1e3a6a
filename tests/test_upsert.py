from __future__ import annotations

import os
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ringledger.operators.upsert import UPDATED, StoredTable
from ringledger.plans.runs import StoredTables
from ringledger.sources.inputs import Inputs
from ringledger.window import Span
from tests.conftest import at, rows

SCHEMA = "id bigint, ts timestamp_ntz, v string"


def batch(spark, *entries):
    return spark.createDataFrame([(n, at(when) if when else None, v) for n, when, v in entries], SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, str(tmp_path / "t"), ["id"], "ts")


def values(table, span=None):
    df = table.read(span) if span else table.read()
    return sorted(((r["id"], r["v"]) for r in df.collect()), key=repr)


def test_rows_are_replaced_by_key_and_others_stay(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (2, "01-16 10:00", "b"), (3, "01-17 10:00", "c")))
    info = table.upsert(batch(spark, (2, "01-16 10:00", "B"), (4, "01-16 11:00", "d")))
    assert values(table) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    assert info.rows_written == 2 and info.days == (date(2024, 1, 16),)
    assert table.read().count() == 4
    assert [name for name, _ in info.columns] == ["id", "ts", "v", UPDATED]


def files(table, day):
    return sorted(Path(table.path, f"day={day}").glob("*.parquet"))


def jobs_of(spark, work):
    """How many Spark jobs a piece of work takes."""
    context, group = spark.sparkContext, f"count-{os.urandom(4).hex()}"
    context.setJobGroup(group, "")
    try:
        work()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_untouched_days_are_not_rewritten(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (3, "01-17 10:00", "c")))
    before = files(table, "2024-01-16"), files(table, "2024-01-17")
    table.upsert(batch(spark, (1, "01-16 09:00", "A")))
    assert files(table, "2024-01-17") == before[1] and not set(files(table, "2024-01-16")) & set(before[0])


def test_a_table_is_a_folder_per_day_and_nothing_else(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a")))
    table.upsert(batch(spark, (1, "01-17 09:00", "A"), (2, "01-17 09:00", "b")))
    assert {p.name for p in Path(table.path).iterdir() if p.is_dir()} == {
        "day=2024-01-16", "day=2024-01-17", "day=__HIVE_DEFAULT_PARTITION__",
    }
    assert rows(spark.read.parquet(table.path).where("warehouse_updated_ts IS NOT NULL").select("id", "v")) == [(1, "A"), (2, "b")]


def test_key_that_moves_to_another_day(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 10:00", "b")))
    table.upsert(batch(spark, (1, "01-18 09:00", "A")))
    assert values(table) == [(1, "A"), (2, "b")]
    assert values(table, Span(date(2024, 1, 16), date(2024, 1, 17))) == []


def test_composite_key(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ["id", "v"], "ts")
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (1, "01-16 09:00", "b")))
    table.upsert(batch(spark, (1, "01-16 12:00", "b")))
    assert rows(table.read().select("id", "v", "ts")) == [
        (1, "a", at("01-16 09:00")),
        (1, "b", at("01-16 12:00")),
    ]


def test_another_reader_sees_the_same_rows(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a")))
    table.upsert(batch(spark, (1, "01-16 09:00", "A"), (2, "01-17 09:00", "b")))
    fresh = StoredTable(spark, table.path, ["id"], "ts")
    assert values(fresh) == [(1, "A"), (2, "b")]
    fresh.upsert(batch(spark, (2, "01-17 09:00", "B")))
    assert values(fresh) == values(table) == [(1, "A"), (2, "B")]


def test_the_search_for_moved_keys_is_pushed_to_the_files(spark, table, monkeypatch):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (5, "01-16 10:00", "b"), (8, "01-17 09:00", "c")))
    seen = []
    select = type(table._rows()).distinct
    monkeypatch.setattr(type(table._rows()), "distinct", lambda df: seen.append(df) or select(df))
    table.upsert(batch(spark, (5, "01-18 11:00", "B"), (7, "01-18 09:00", "d")))
    (search,) = seen
    plan = search._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and table.path in line)
    assert "GreaterThanOrEqual(id,5)" in scan and "LessThanOrEqual(id,7)" in scan
    assert re.search(r"ReadSchema: struct<id:bigint,warehouse_updated_ts:timestamp>", scan)
    assert values(table) == [(1, "a"), (5, "B"), (7, "d"), (8, "c")]


def test_survivors_come_from_touched_days_only(spark, table, monkeypatch):
    table.replace(batch(spark, *[(n, f"01-{n:02d} 09:00", "x") for n in range(10, 20)], (30, "01-12 10:00", "y")))
    written = []
    write = StoredTable._write
    monkeypatch.setattr(StoredTable, "_write", lambda self, df, *args: written.append(df) or write(self, df, *args))
    table.upsert(batch(spark, (12, "01-14 09:00", "X")))
    plan = written[-1]._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and f"{table.path}]" in line)
    assert re.search(r"PartitionFilters: \[.*day#\d+ IN \(2024-01-1[24],2024-01-1[24]\)", scan)
    assert values(table) == [(n, "X" if n == 12 else "x") for n in range(10, 20)] + [(30, "y")]


def test_text_keys(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ["v"], "ts")
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 09:00", "b")))
    table.upsert(batch(spark, (3, "01-18 09:00", "a"), (4, "01-18 09:00", None)))
    fresh = StoredTable(spark, table.path, ["v"], "ts")
    assert values(fresh) == [(2, "b"), (3, "a"), (4, None)]


def test_a_run_that_died_before_its_days_were_swapped_changes_nothing(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a")))
    broken = batch(spark, (1, "01-16 09:00", "A"), (2, "01-17 09:00", "b")).withColumn(
        "v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert values(table) == values(StoredTable(spark, table.path, ["id"], "ts")) == [(1, "a")]


def test_a_run_that_died_between_two_days_is_run_again(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 09:00", "b"), (3, "01-17 09:30", "c")))
    moved = batch(spark, (2, "01-16 10:00", "B"), (4, "01-18 09:00", "d"))
    table.upsert(moved)
    wanted = values(table)
    # As if only the first day had been swapped: the others are as before.
    spark.read.parquet(table.path).where("day = DATE'2024-01-16'").write.mode("overwrite").parquet(f"{table.path}-first")
    table.replace(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 09:00", "b"), (3, "01-17 09:30", "c")))
    half = spark.read.parquet(f"{table.path}-first")
    half.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(table.path)
    table.upsert(moved)
    assert values(table) == wanted == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_newer_rows_stay(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"), ["id"], "ts", version=["v"])
    table.upsert(batch(spark, (1, "01-16 09:00", "b"), (2, "01-16 09:00", "b"), (3, "01-16 09:00", "b")))
    info = table.upsert(batch(spark, (1, "01-17 09:00", "a"), (2, "01-18 09:00", "c"), (4, "01-16 09:00", "a")))
    assert rows(table.read().select("id", "ts", "v")) == [
        (1, at("01-16 09:00"), "b"),
        (2, at("01-18 09:00"), "c"),
        (3, at("01-16 09:00"), "b"),
        (4, at("01-16 09:00"), "a"),
    ]
    assert info.rows_written == 2 and table.read().count() == 4


def test_keys_that_are_gone(spark, table):
    table.upsert(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 10:00", "b"), (3, "01-17 11:00", "c"), (9, "01-18 11:00", "d")))
    info = table.upsert(batch(spark, (3, "01-17 11:00", "C")), gone=batch(spark, (1, None, None), (3, None, None), (77, None, None)))
    assert values(table) == [(2, "b"), (3, "C"), (9, "d")]
    assert info.days == (date(2024, 1, 16), date(2024, 1, 17))
    table.upsert(batch(spark), gone=batch(spark, (9, None, None)))
    assert values(table) == [(2, "b"), (3, "C")]


def test_rows_outside_the_replaced_days_are_refused(spark, table):
    table.replace(batch(spark, (1, "01-16 09:00", "a")))
    for stray in ((2, "01-18 09:00", "b"), (2, None, "b")):
        with pytest.raises(Exception, match="outside the replaced days|raise_error|USER_RAISED"):
            table.replace_days(batch(spark, (1, "01-16 09:00", "A"), stray), Span(date(2024, 1, 16), date(2024, 1, 18)))
    assert values(table) == [(1, "a")]


def test_facts_come_from_the_job_that_writes(spark, table):
    frame = batch(spark, (4, "01-16 09:00", "a"), (2, "01-17 09:00", None), (3, None, None))
    infos = []
    jobs = jobs_of(spark, lambda: infos.append(table.replace(frame)))
    (info,) = infos
    assert (info.rows_written, info.nulls, info.key_ranges) == (3, {"id": 0, "ts": 1, "v": 2, UPDATED: 0}, {"id": (2, 4)})
    assert info.days == (None, date(2024, 1, 16), date(2024, 1, 17))
    # The same rows, written plainly, take as many jobs.
    plain = frame.withColumn("day", F.to_date("ts")).hint("rebalance", "day").write.partitionBy("day")
    assert jobs <= jobs_of(spark, lambda: plain.parquet(f"{table.path}-plain")) + 1


def test_upsert_takes_three_passes(spark, table, monkeypatch):
    """The batch, the search for its keys, and the days it touches."""
    table.replace(batch(spark, *[(n, f"01-{n:02d} 09:00", "x") for n in range(10, 20)]))
    frame, passes = batch(spark, (12, "01-14 09:00", "X")), []
    for owner, name in ((type(frame.write), "parquet"), (type(frame), "collect")):
        call = getattr(owner, name)
        monkeypatch.setattr(owner, name, lambda self, *a, call=call, name=name, **k: passes.append(name) or call(self, *a, **k))
    table.upsert(frame)
    assert passes == ["parquet", "collect", "parquet"]


def test_empty_batch_changes_nothing(spark, table):
    table.upsert(batch(spark))
    assert values(table) == []
    table.upsert(batch(spark, (1, "01-16 09:00", "a")))
    table.upsert(batch(spark))
    assert values(table) == [(1, "a")]


def test_replace_drops_rows_that_are_gone(spark, table):
    table.replace(batch(spark, (1, "01-16 09:00", "a"), (2, "01-17 09:00", "b")))
    table.replace(batch(spark, (2, "01-18 09:00", "B")))
    assert values(table) == [(2, "B")]
    assert values(StoredTable(spark, table.path, ["id"], "ts")) == [(2, "B")]


def test_rows_without_a_day_are_kept(spark, table):
    table.replace(batch(spark, (1, None, "a"), (2, "01-17 09:00", "b")))
    table.upsert(batch(spark, (3, None, "c"), (1, "01-17 09:00", "A")))
    assert values(table) == [(1, "A"), (2, "b"), (3, "c")]
    assert values(table, Span(date(2024, 1, 1), None)) == [(1, "A"), (2, "b")]
    assert values(StoredTable(spark, table.path, ["id"], "ts")) == [(1, "A"), (2, "b"), (3, "c")]


def test_only_days_of_the_span_are_read(spark, table):
    table.replace(batch(spark, *[(n, f"01-{n:02d} 09:00", "x") for n in range(10, 20)]))
    span = Span(date(2024, 1, 12), date(2024, 1, 14))
    assert values(table, span) == [(12, "x"), (13, "x")]
    plan = table.read(span)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-12\), \(day#\d+ < 2024-01-14\)\]", plan)


def test_never_written_table_cannot_be_read(table):
    with pytest.raises(LookupError):
        table.read()


def test_layers_map_to_folders(spark, tmp_path):
    tables = StoredTables(spark, str(tmp_path), Inputs({}, {}, {}), layers={"core": "gold"})
    assert tables.stored("daily_agent_metrics").path == f"{tmp_path}/gold/daily_agent_metrics"
    assert tables.stored("mart_crm").path == f"{tmp_path}/mart/mart_crm"


def versioned(spark, tmp_path, *versions):
    """Batches of (id, ts, a, b, c), ordered by a, b, c, merged one after another."""
    table = StoredTable(spark, str(tmp_path / "v"), ["id"], "ts", version=["a", "b", "c"])
    for entries in versions:
        table.upsert(spark.createDataFrame([(n, at(t), *v) for n, t, *v in entries], "id bigint, ts timestamp_ntz, a int, b int, c string"))
    return [(r["id"], r["ts"].day, r["c"]) for r in sorted(table.read().collect(), key=lambda r: r["id"])]


def test_versions_that_only_differ_in_later_columns(spark, tmp_path):
    first = [(1, "01-16 09:00", 1, None, "b"), (2, "01-16 09:00", 1, None, "b"), (3, "01-16 09:00", 1, 2, None), (4, "01-16 09:00", 1, 2, "x")]
    second = [(1, "01-17 09:00", 1, None, "a"), (2, "01-17 09:00", 1, None, "c"), (3, "01-17 09:00", 1, 2, "a"), (4, "01-18 09:00", 1, 2, "x")]
    assert versioned(spark, tmp_path, first, second) == [(1, 16, "b"), (2, 17, "c"), (3, 17, "a"), (4, 18, "x")]


def test_rows_of_a_day_that_only_loses_some_stay_where_they_are(spark, tmp_path, monkeypatch):
    """They are neither shuffled to find those that go nor to be written again."""
    in_place, write = [], StoredTable._write

    def spy(self, rows, also, *facts, **more):
        kept = more.get("placed")
        in_place.append([] if kept is None else sorted(r["id"] for r in kept.collect()))
        return write(self, rows, also, *facts, **more)

    monkeypatch.setattr(StoredTable, "_write", spy)
    first = [(n, "01-16 09:00", 1, n, "a") for n in range(4)]
    assert versioned(spark, tmp_path, first, [(2, "01-20 09:00", 2, 0, "b")]) == [(0, 16, "a"), (1, 16, "a"), (2, 20, "b"), (3, 16, "a")]
    assert in_place == [[], [0, 1, 3]]

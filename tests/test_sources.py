from __future__ import annotations

import os
import shutil
import time
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ringledger.operators.latest import latest_version, repeated_origins
from ringledger.plans.models import MODELS
from ringledger.plans.runs import StoredTables, lineage
from ringledger.schemas import DATASETS
from ringledger.sources.coverage import dataset_coverage
from ringledger.sources.inputs import Inputs
from ringledger.sources.landing import append_days, scan_days
from ringledger.sources.seeds import read_seed, write_seed
from ringledger.streaming.ingest import ingest_new_files, load_details, load_log, raw_feed, raw_table
from ringledger.window import RunWindow, Span
from tests.conftest import at, rows

CALLS = DATASETS["calls"]


def calls(spark, *entries, kind="timestamp_ntz"):
    df = spark.createDataFrame(
        [(n, 1, 1, 0, at(when), at(when), 10 + n, 0, False) for n, when in entries], CALLS.columns
    )
    return df.withColumns({c: F.col(c).cast(kind) for c in ("start_ts", "end_ts")})


def test_scan_prunes_days(spark, tmp_path):
    base = str(tmp_path)
    append_days(calls(spark, (1, "01-16 09:00"), (2, "01-17 09:00"), (3, "01-18 09:00")), base, CALLS)
    scan = scan_days(spark, base, CALLS, Span(date(2024, 1, 16), date(2024, 1, 18)))
    assert sorted(r["call_id"] for r in scan.collect()) == [1, 2]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day#" in plan
    assert scan_days(spark, base, CALLS, Span(date(2024, 1, 16), date(2024, 1, 17))).count() == 1


def test_sink_appends_files_to_a_day(spark, tmp_path):
    base = str(tmp_path)
    append_days(calls(spark, (1, "01-16 09:00")), base, CALLS)
    append_days(calls(spark, (2, "01-16 10:00")), base, CALLS)
    files = list((tmp_path / "calls" / "day=2024-01-16").glob("part-*.parquet"))
    assert len(files) == 2 and scan_days(spark, base, CALLS).count() == 2


def ingested(spark, raw):
    return sorted((r["call_id"], r["load_id"]) for r in raw_table(spark, raw, CALLS).collect())


def test_ingestion_takes_every_new_file_once(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00"), (2, "01-17 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    first, second = "000000000", "000000001"
    assert ingested(spark, raw) == [(1, first), (2, first)]
    ingest_new_files(spark, CALLS, base, raw)
    assert ingested(spark, raw) == [(1, first), (2, first)]

    # The file of the 17th turns up again, renamed, in an earlier day's folder.
    (source,) = Path(base, "calls", "day=2024-01-17").glob("part-*.parquet")
    shutil.copy(source, Path(base, "calls", "day=2024-01-16", "part-9999-dup.parquet"))
    ingest_new_files(spark, CALLS, base, raw)
    assert ingested(spark, raw) == [(1, first), (2, first), (2, second)]
    log = load_log(spark, raw, CALLS)
    stamps = [r["inserted_at"] for r in log.orderBy("load_id").collect()]
    assert len(stamps) == 2 and stamps[0] < stamps[1]
    # Filed by event time, not by the folder the copy was put into.
    assert {r["event_day"] for r in raw_table(spark, raw, CALLS).where("call_id = 2").collect()} == {
        date(2024, 1, 17)
    }
    assert latest_version(raw_table(spark, raw, CALLS), log, CALLS).count() == 2


def test_an_old_file_that_arrives_late_is_ingested(spark, tmp_path):
    """Copied with its old modification time, weeks before files that were seen already."""
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    append_days(calls(spark, (2, "01-02 09:00")), base, CALLS)
    (late,) = Path(base, "calls", "day=2024-01-02").glob("part-*.parquet")
    month_ago = time.time() - 30 * 86_400
    os.utime(late, (month_ago, month_ago))
    ingest_new_files(spark, CALLS, base, raw)
    assert [n for n, _ in ingested(spark, raw)] == [1, 2]
    ingest_new_files(spark, CALLS, base, raw)
    assert [n for n, _ in ingested(spark, raw)] == [1, 2]


def test_a_backlog_can_be_cut_into_loads(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00"), (2, "01-17 09:00"), (3, "01-18 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw, files_per_load=1)
    assert [n for n, _ in ingested(spark, raw)] == [1, 2, 3]
    assert len({load for _, load in ingested(spark, raw)}) == 3 == load_log(spark, raw, CALLS).count()


def test_a_load_that_is_repeated_is_stored_once(spark, tmp_path):
    """The stream's state is lost after the rows were written: the load is written again."""
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    (Path(raw) / "calls" / "checkpoint" / "commits" / "0").unlink()
    (Path(raw) / "calls" / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    ingest_new_files(spark, CALLS, base, raw)
    assert ingested(spark, raw) == [(1, "000000000")]
    assert load_log(spark, raw, CALLS).count() == 1


def test_files_with_zoned_timestamps_are_ingested(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 23:30"), kind="timestamp"), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    (row,) = raw_table(spark, raw, CALLS).collect()
    assert row["start_ts"] == at("01-16 23:30") and row["event_day"] == date(2024, 1, 16)


def drifted(spark, base, *expressions, number=2, drop=()):
    """One more file of calls, with other columns."""
    df = calls(spark, (number, f"01-{15 + number} 09:00")).drop(*drop).selectExpr("*", *expressions)
    names = [name for name in df.columns if df.columns.count(name) == 1]
    df.select(*names, F.to_date("start_ts").alias("day")).write.mode("append").partitionBy("day").parquet(f"{base}/calls")


def test_added_and_missing_columns_are_noticed(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    drifted(spark, base, "'web' AS channel", "named_struct('a', 1, 'b', array(2.5D)) AS more", "CAST(NULL AS INT) AS none", drop=["transfer_flag", "agent_id"])
    drifted(spark, base, "7L AS `odd name`", "'x' AS load_id", "'y' AS extra", number=3)
    ingest_new_files(spark, CALLS, base, raw)
    found = {r["call_id"]: r for r in raw_table(spark, raw, CALLS, origin=True).collect()}
    assert found[1]["extra"] is None and found[1]["agent_id"] is not None
    assert found[2]["extra"] == {"channel": "web", "more": "{1, [2.5]}"}
    assert found[2]["agent_id"] is None and found[2]["transfer_flag"] is None
    assert found[3]["extra"] == {"odd name": "7", "load_id": "x", "extra": "y"} and found[3]["agent_id"] is not None
    assert {n: r["load_id"] for n, r in found.items()} == {1: "000000000", 2: "000000001", 3: "000000001"}
    details = {r["load_id"]: r for r in load_details(spark, raw, CALLS).collect()}
    assert (details["000000000"]["files"], details["000000000"]["added"], details["000000000"]["missing"]) == (1, [], [])
    # Both files make one load: a column is missing if no file of it has one.
    assert details["000000001"]["files"] == 2 and details["000000001"]["missing"] == []
    assert sorted(details["000000001"]["added"]) == ["channel", "extra", "load_id", "more", "none", "odd name"]
    assert set(raw_table(spark, raw, CALLS).columns) == {*CALLS.column_names, "load_id", "event_day"}


def test_a_load_without_a_column(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    drifted(spark, base, drop=["transfer_flag", "agent_id"])
    ingest_new_files(spark, CALLS, base, raw)
    (load,) = load_details(spark, raw, CALLS).collect()
    assert load["missing"] == ["agent_id", "transfer_flag"]


@pytest.mark.parametrize("changed", ["CAST(duration_s AS STRING) AS duration_s", "CAST(start_ts AS STRING) AS start_ts", "CAST(agent_id AS DOUBLE) AS agent_id"])
def test_a_changed_type_is_refused_before_anything_is_written(spark, tmp_path, changed):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    name = changed.rsplit(" ", 1)[1]
    other = calls(spark, (2, "01-17 09:00")).withColumn("day", F.to_date("start_ts")).withColumn(name, F.expr(changed))
    other.write.mode("append").partitionBy("day").parquet(f"{base}/calls")
    append_days(calls(spark, (3, "01-18 09:00")), base, CALLS)
    with pytest.raises(Exception, match="ChangedType|different types"):
        ingest_new_files(spark, CALLS, base, raw)
    assert ingested(spark, raw) == [(1, "000000000")] and load_log(spark, raw, CALLS).count() == 1


def test_narrower_whole_numbers_are_read(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    narrow = calls(spark, (2, "01-17 09:00")).withColumn("duration_s", F.expr("CAST(duration_s AS INT)"))
    narrow.withColumn("day", F.to_date("start_ts")).write.partitionBy("day").parquet(f"{base}/calls")
    ingest_new_files(spark, CALLS, base, raw)
    wanted = calls(spark, (2, "01-17 09:00")).first()["duration_s"]
    assert [r["duration_s"] for r in raw_table(spark, raw, CALLS).collect()] == [wanted]


def test_a_repeated_key_is_told_with_its_files(spark, tmp_path):
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00"), (2, "01-17 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    (source,) = Path(base, "calls", "day=2024-01-17").glob("part-*.parquet")
    shutil.copy(source, Path(base, "calls", "day=2024-01-16", "part-9999-dup.parquet"))
    ingest_new_files(spark, CALLS, base, raw)
    (row,) = repeated_origins(raw_table(spark, raw, CALLS, origin=True), CALLS).collect()
    assert (row["record_id"], row["copies"], row["loads"]) == (2, 2, ["000000000", "000000001"])
    assert [Path(f).name for f in row["files"]] == ["part-9999-dup.parquet", source.name]
    assert row["folders"] == ["2024-01-16", "2024-01-17"]


def test_tables_over_ingested_files(spark, tmp_path):
    """Files to staging to mart, with the scan pruned to the days of the window."""
    base, raw = str(tmp_path / "files"), str(tmp_path / "raw")
    append_days(calls(spark, (1, "01-16 09:00"), (2, "01-17 09:00")), base, CALLS)
    ingest_new_files(spark, CALLS, base, raw)
    source = Inputs(
        raw={"calls": raw_feed(spark, raw, CALLS)},
        loads={"calls": load_log(spark, raw, CALLS)},
        seeds={
            "agents": spark.createDataFrame([(1, "Ann")], "agent_id bigint, agent_name string"),
            "customers": spark.createDataFrame([(1, "gold")], "customer_id bigint, program string"),
        },
    )
    store = StoredTables(spark, str(tmp_path / "tables"), source)
    window = RunWindow.for_day(date(2024, 1, 17))
    store.run(window, only=lineage("mart_calls"))
    assert [(r["call_id"], r["agent_name"]) for r in store["mart_calls"].collect()] == [(2, "Ann")]
    files = store.raw("calls", window.days).inputFiles()
    assert files and all("event_day=2024-01-17" in f for f in files)
    assert store.raw("calls", RunWindow.for_day(date(2023, 1, 1)).days).count() == 0
    assert {model.layer for model in MODELS} == {"staging", "mart", "core"}


def test_seed_keeps_leading_zeros(spark, tmp_path):
    people = spark.createDataFrame(
        [(1, "Ann", "Lee", date(1980, 2, 1), "NY", "01234", "gold"), (2, None, "Ray", None, "MA", "00501", "gold")],
        "customer_id bigint, first_name string, last_name string, birth_date date, state string, "
        "zip_code string, program string",
    )
    write_seed(people, str(tmp_path), "customers")
    assert rows(read_seed(spark, str(tmp_path), "customers")) == rows(people)


def test_seed_with_swapped_columns_is_refused(spark, tmp_path):
    (tmp_path / "agents").mkdir()
    (tmp_path / "agents" / "agents.csv").write_text("agent_name,agent_id\nAnn,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_seed(spark, str(tmp_path), "agents").collect()


def test_coverage(spark):
    raw = {
        "calls": calls(spark, (1, "01-16 09:00"), (2, "01-16 10:00"), (3, "01-17 09:00")),
        "crm": spark.createDataFrame([(at("01-16 09:00"),)], "created_ts timestamp_ntz"),
        "surveys": spark.createDataFrame([(at("01-16 09:00"),)], "response_ts timestamp_ntz"),
    }
    found = dataset_coverage(spark, raw, date(2024, 1, 16), date(2024, 1, 18))
    assert rows(found) == [
        (date(2024, 1, 16), 2, 1, 1, "complete"),
        (date(2024, 1, 17), 1, 0, 0, "partial"),
        (date(2024, 1, 18), 0, 0, 0, "missing"),
    ]

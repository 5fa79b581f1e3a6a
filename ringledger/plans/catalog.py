"""Every named query: a function of the session and the folder of input tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.operators import insights
from ringledger.operators.assignments import segments_from_changes, with_manager
from ringledger.operators.callbacks import repeat_flags
from ringledger.operators.latest import latest_version, repeated_origins, repeated_records
from ringledger.operators.quality import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    UNIQUE_COMBINATION,
    Check,
    check_report,
    failing_rows,
)
from ringledger.operators.resolution import (
    compare_definitions,
    resolved_unless_repeated,
    resolved_with_cutover,
)
from ringledger.operators.segments import SegmentStore
from ringledger.operators.upsert import UPDATED, StoredTable
from ringledger.plans.checks import RAW_CHECKS
from ringledger.plans.models import BY_NAME, MODELS, LazyTables
from ringledger.plans.runs import StoredTables, lineage
from ringledger.schemas import DATASETS
from ringledger.session import scratch_dir
from ringledger.sources import stand_in
from ringledger.sources.coverage import dataset_coverage
from ringledger.sources.landing import append_days, scan_days
from ringledger.sources.seeds import read_seed, write_seed
from ringledger.streaming.ingest import EVENT_DAY, ingest_all, ingest_new_files, load_details, load_log, raw_table
from ringledger.window import RunWindow, Span, within_inclusive

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_DAYS = 10
CUTOVER = date(2024, 2, 1)

SCORECARDS = (
    "daily_agent_metrics",
    "daily_agent_manager_metrics",
    "monthly_agent_metrics",
    "monthly_agent_manager_metrics",
    "monthly_manager_metrics",
)
# How tables are called as queries, where that is not their own name.
QUERY_NAMES = {
    "daily_agent_call_metrics_source": "daily_agent_call_source",
    "daily_agent_crm_metrics_source": "daily_agent_crm_source",
    "daily_agent_survey_metrics_source": "daily_agent_survey_source",
}


def windows(first: date, last: date, **options) -> list[RunWindow]:
    """Windows of ten days that take in all days from first to last."""
    count = (last - first).days // WINDOW_DAYS + 1
    starts = [first + timedelta(days=WINDOW_DAYS * n) for n in range(count)]
    return [RunWindow(start, start + timedelta(days=WINDOW_DAYS), **options) for start in starts]


def run_windows(spark: SparkSession, sf_dir: str, **options) -> list[RunWindow]:
    """Windows over every day on which a raw record happened."""
    source = stand_in.inputs(spark, sf_dir)
    days = [source.raw(n).select(F.to_date(feed.event_ts).alias("day")) for n, feed in DATASETS.items()]
    first, last = reduce(DataFrame.unionByName, days).agg(F.min("day"), F.max("day")).first()
    return windows(first, last, **options) if first else []


def _lazy(spark: SparkSession, sf_dir: str) -> LazyTables:
    return LazyTables(stand_in.inputs(spark, sf_dir))


def _fresh_store(spark: SparkSession, sf_dir: str, label: str) -> StoredTables:
    return StoredTables(spark, scratch_dir(spark, label), stand_in.inputs(spark, sf_dir))


def _table(name: str) -> Query:
    return lambda spark, sf_dir: _lazy(spark, sf_dir)[name]


# -- sources and sinks -----------------------------------------------------------


def scan_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week of filed calls, both end days included."""
    base = scratch_dir(spark, "landing")
    append_days(stand_in.raw_calls(spark, sf_dir), base, DATASETS["calls"])
    return scan_days(spark, base, DATASETS["calls"], Span(date(2024, 1, 20), date(2024, 1, 27)))


def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to the same day folders, read back."""
    base, feed = scratch_dir(spark, "sink"), DATASETS["crm"]
    tickets = stand_in.raw_crm(spark, sf_dir)
    for load in (stand_in.FIRST_LOAD, stand_in.SECOND_LOAD):
        append_days(tickets.where(F.col("load_id") == load), base, feed)
    return scan_days(spark, base, feed)


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Files arrive, are ingested, more files arrive, are ingested."""
    base, raw = scratch_dir(spark, "files"), scratch_dir(spark, "raw")
    source = stand_in.inputs(spark, sf_dir)
    for load in (stand_in.FIRST_LOAD, stand_in.SECOND_LOAD):
        for name, feed in DATASETS.items():
            append_days(source.raw(name).where(F.col("load_id") == load), base, feed)
        ingest_all(spark, DATASETS.values(), base, raw)
    return raw


def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row that was ingested, with its load and whether that load was logged."""
    raw = _ingested(spark, sf_dir)

    def stacked(name: str) -> DataFrame:
        feed = DATASETS[name]
        logged = load_log(spark, raw, feed).select("load_id", F.col("inserted_at").isNotNull().alias("logged"))
        return (
            raw_table(spark, raw, feed)
            .join(logged, "load_id", "left")
            .select(
                F.lit(name).alias("dataset"), F.col(feed.key).alias("record_id"), EVENT_DAY, "load_id", "logged"
            )
        )

    return reduce(DataFrame.unionByName, [stacked(name) for name in DATASETS])


def duplicate_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that were loaded more than once, and how many files of which loads and day folders hold them."""
    raw = _ingested(spark, sf_dir)
    found = [repeated_origins(raw_table(spark, raw, feed, origin=True), feed) for feed in DATASETS.values()]
    return reduce(DataFrame.unionByName, found).select(
        "dataset",
        "record_id",
        "copies",
        F.array_join("loads", ",").alias("loads"),
        F.size("files").alias("files"),
        F.array_join("folders", ",").alias("folders"),
    )


def ingest_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a second load have two columns more and lack one: every raw row, and what the log says of its load."""
    base, raw, feed = scratch_dir(spark, "files"), scratch_dir(spark, "raw"), DATASETS["calls"]
    calls = stand_in.raw_calls(spark, sf_dir)
    append_days(calls.where(F.col("load_id") == stand_in.FIRST_LOAD), base, feed)
    ingest_new_files(spark, feed, base, raw)
    later = calls.where(F.col("load_id") == stand_in.SECOND_LOAD).drop("load_id", "hold_time_during_call_s")
    later = later.selectExpr(
        "*", "IF(call_id % 3 = 0, NULL, concat('channel ', call_id % 3)) AS channel", "call_id % 7 AS desk", "to_date(start_ts) AS day"
    )
    later.write.mode("append").partitionBy("day").parquet(f"{base}/{feed.name}")
    ingest_new_files(spark, feed, base, raw)
    log = load_details(spark, raw, feed).select(
        "load_id", F.array_join("added", ",").alias("added"), F.array_join("missing", ",").alias("missing")
    )
    rows = raw_table(spark, raw, feed, origin=True).join(log, "load_id")
    return rows.select(
        "call_id", "load_id", "duration_s", "hold_time_during_call_s",
        F.col("extra")["channel"].alias("channel"), F.col("extra")["desk"].alias("desk"), "added", "missing",
    )


def _customer_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = stand_in.read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.select(
        key.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.date_add(F.lit(date(1950, 1, 1)), (key % 18000).cast("int")).alias("birth_date"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.col("c_mktsegment").alias("program"),
    )


def seed_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CSV and back, leading zeros of the zip code kept."""
    folder = scratch_dir(spark, "seeds")
    write_seed(_customer_seed(spark, sf_dir), folder, "customers")
    return read_seed(spark, folder, "customers")


def seed_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three more seeds as CSV and back, used to name the manager in charge of every call."""
    folder = scratch_dir(spark, "seeds")
    source = stand_in.inputs(spark, sf_dir)
    for name in ("agents", "managers", "agent_assignments"):
        write_seed(source.seed(name), folder, name)
    calls = latest_version(source.raw("calls"), source.loads("calls"), DATASETS["calls"])
    dated = calls.join(read_seed(spark, folder, "agents"), "agent_id").selectExpr(
        "call_id", "agent_id", "agent_name", "to_date(start_ts) AS call_date"
    )
    return with_manager(
        dated,
        "call_date",
        read_seed(spark, folder, "agent_assignments"),
        read_seed(spark, folder, "managers"),
    )


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = stand_in.inputs(spark, sf_dir)
    raw = {name: source.raw(name) for name in DATASETS}
    return dataset_coverage(spark, raw, date(2024, 1, 10), date(2024, 2, 25))


def raw_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = stand_in.inputs(spark, sf_dir)
    return reduce(
        DataFrame.unionByName, [repeated_records(source.raw(n), feed) for n, feed in DATASETS.items()]
    )


# -- resolution definitions --------------------------------------------------------


def fcr_reason_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved_unless_repeated(repeat_flags(_lazy(spark, sf_dir)["mart_crm"]))


def fcr_definition_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_definitions(repeat_flags(_lazy(spark, sf_dir)["mart_crm"]))


def fcr_cutover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolved_with_cutover(repeat_flags(_lazy(spark, sf_dir)["mart_crm"]), CUTOVER)


def scd2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's current kind of event as effective-dated segments."""
    events = stand_in.read_table(spark, sf_dir, "events")
    changes = events.select(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("value"), F.col("ts").alias("changed_at")
    )
    return segments_from_changes(changes, "entity_id", "value", "changed_at")


def segments_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same segments, from two batches: the first has changes that never were and lacks some that come late."""
    events = stand_in.read_table(spark, sf_dir, "events")
    changes = events.selectExpr("event_id", "user_id AS entity_id", "event_type AS value", "ts AS changed_at")
    mistaken = changes.where("event_id % 11 = 0").selectExpr(
        "event_id", "entity_id", "'mistaken' AS value", "changed_at + INTERVAL '20' HOUR * (1 + event_id % 5) AS changed_at"
    )
    late = F.col("event_id") % 7 == 0
    columns = ("entity_id", "value", "changed_at")
    store = SegmentStore(spark, scratch_dir(spark, "segments"), *columns)
    first = changes.where(~late).unionByName(mistaken).select(*columns, F.lit(False).alias("withdrawn"))
    second = changes.where(late).withColumn("withdrawn", F.lit(False)).unionByName(mistaken.withColumn("withdrawn", F.lit(True)))
    store.merge(first)
    store.merge(second.select(*columns, "withdrawn"))
    return store.read()


# -- incremental runs ----------------------------------------------------------------


def _after_windows(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _fresh_store(spark, sf_dir, table)
    for window in run_windows(spark, sf_dir):
        store.run(window, only=lineage(table))
    return store[table]


def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_windows("stg_calls", spark, sf_dir)


def incremental_rows_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest calls of a closed window: midnight of the end day counts in.

    A correction may move a call out of the window, so the latest version is found first.
    """
    source = stand_in.inputs(spark, sf_dir)
    closed = within_inclusive(F.col("start_ts"), date(2024, 1, 20), date(2024, 1, 25))
    return latest_version(source.raw("calls"), source.loads("calls"), DATASETS["calls"]).where(closed)


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_windows("daily_agent_metrics", spark, sf_dir)


def incremental_callbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs one narrow window recomputes: callbacks before its end, originals
    no older than the lookback."""
    window, model = RunWindow(date(2024, 1, 26), date(2024, 2, 5), narrow=True), BY_NAME["mart_crm_callbacks"]
    return model.build(_lazy(spark, sf_dir), model.span(window, frozenset()), window)


def incremental_late_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_windows("daily_agent_survey_metrics_source", spark, sf_dir)


def _stack_scorecards(tables: StoredTables) -> DataFrame:
    def shaped(name: str) -> DataFrame:
        card = tables[name]
        period = "call_month" if "call_month" in card.columns else "call_date"
        return card.withColumnRenamed(period, "period").withColumn("scorecard", F.lit(name))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [shaped(n) for n in SCORECARDS])


def incremental_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows one after another: the scorecards must equal a full build."""
    store = _fresh_store(spark, sf_dir, "replay")
    for window in run_windows(spark, sf_dir):
        store.run(window, only=lineage(*SCORECARDS))
    return _stack_scorecards(store)


def _content_term(name: str, kind: str) -> str:
    """A whole number that depends on one value."""
    value = {
        "boolean": f"CAST({name} AS INT)",
        "double": f"CAST(round({name} * 1000000) AS BIGINT)",
        "date": f"datediff({name}, DATE'1970-01-01')",
        "timestamp_ntz": f"unix_micros(CAST({name} AS TIMESTAMP))",
        "string": f"CAST(conv(substr(md5({name}), 1, 8), 16, 10) AS BIGINT)",
    }.get(kind, name)
    return f"coalesce(CAST({value} AS DECIMAL(38, 0)), 7)"


def _contents(store: StoredTables) -> DataFrame:
    """Rows of every table and a sum over all their values, each column weighted by its place."""

    def of_table(name: str) -> DataFrame:
        terms = [f"{n} * {_content_term(*column)}" for n, column in enumerate(store[name].dtypes, start=1)]
        row = store[name].selectExpr(f"CAST({' + '.join(terms)} AS DECIMAL(38, 0)) AS value")
        return row.selectExpr(
            f"'{name}' AS table_name", "count(1) AS rows", "CAST(CAST(sum(value) AS DECIMAL(38, 0)) AS STRING) AS contents"
        )

    return reduce(DataFrame.unionByName, [of_table(model.name) for model in MODELS])


def incremental_replay_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows out of order, and the first ones once more: all sixteen tables must equal a full build."""
    store, runs = _fresh_store(spark, sf_dir, "shuffled"), run_windows(spark, sf_dir)
    for window in [*runs[2:], *runs[:2][::-1], *runs[:1]]:
        store.run(window)
    return _contents(store)


def _upserted(
    spark: SparkSession, keys: list[str], day: str, rows: DataFrame, load_column: str
) -> DataFrame:
    """First load in, second load merged over it, by two writers in turn; read by a third."""
    path = scratch_dir(spark, "upsert")

    def table() -> StoredTable:
        return StoredTable(spark, path, keys, day)

    one, two = table(), table()
    first, second = (
        rows.where(F.col(load_column) == load).drop(load_column) for load in (stand_in.FIRST_LOAD, stand_in.SECOND_LOAD)
    )
    part = F.pmod(F.col(keys[0]), F.lit(2))
    one.replace(first.where(part == 0))
    two.upsert(first.where(part == 1))
    one.upsert(second.where(part == 0))
    two.upsert(second.where(part == 1))
    one.upsert(second.where("false"))
    reader = table()
    nothing = reader.read(Span(date(1990, 1, 1), date(1990, 1, 2)))
    return reader.read().unionByName(nothing).drop(UPDATED)


def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, ["call_id"], "start_ts", stand_in.raw_calls(spark, sf_dir), "load_id")


def upsert_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, ["call_id", "customer_id"], "created_ts", stand_in.raw_crm(spark, sf_dir), "load_id")


# -- full builds -----------------------------------------------------------------------


def full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and store all tables; rows per table, counted by reading them back."""
    store = _fresh_store(spark, sf_dir, "build")
    store.refresh()
    counted = [
        store[model.name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(model.name).alias("table_name"), "rows")
        for model in MODELS
    ]
    return reduce(DataFrame.unionByName, counted)


def pipeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build and store all tables in dependency order: rows and contents of each."""
    store = _fresh_store(spark, sf_dir, "pipeline")
    store.refresh()
    return _contents(store)


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was stored: rows per table, and its columns in order."""
    tables = {model.name for model in MODELS}
    written = [info for info in _fresh_store(spark, sf_dir, "profile").refresh() if info.table in tables]
    rows = [
        (info.table, position, name, kind, info.rows_written)
        for info in written
        for position, (name, kind) in enumerate(info.columns, start=1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string, row_count bigint"
    )


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over the seeds and the stored tables."""
    store = _fresh_store(spark, sf_dir, "checked")
    store.refresh()
    return store.check()


def dq_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check of every kind over the calls, with a known number of violations planted among them."""
    lazy = _lazy(spark, sf_dir)
    sound = lazy["stg_calls"].selectExpr("call_id", "agent_id", "1 AS queue", "duration_s")
    # Keys below zero are not among the calls. A NULL passes all kinds but not_null and the expression.
    planted = spark.sql(
        """SELECT * FROM VALUES
            (-1L, 1L, 1, 5L), (-1L, 1L, 1, 5L),
            (-2L, NULL, 1, 5L), (-3L, NULL, NULL, 5L),
            (-4L, 1L, 8, 5L), (-5L, 1L, 9, 5L), (-6L, 1L, 7, 5L),
            (-7L, 901L, 1, 5L), (-8L, 902L, 1, 5L), (-9L, 903L, 1, 5L), (-10L, 903L, 1, 5L),
            (-11L, 1L, 1, -1L), (-12L, 1L, 1, -2L), (-13L, 1L, 1, -3L), (-14L, 1L, 1, -4L), (-15L, 1L, 1, NULL)
            AS t(call_id, agent_id, queue, duration_s)"""
    )
    tables = {"calls": sound.unionByName(planted), "agents": lazy.seed("agents")}
    checks = [
        Check("calls", UNIQUE, ("call_id",)),
        Check("calls", NOT_NULL, ("agent_id",)),
        Check("calls", ACCEPTED_VALUES, ("queue",), values=(1, 2)),
        Check("calls", RELATIONSHIPS, ("agent_id",), parent=("agents", "agent_id")),
        Check("calls", UNIQUE_COMBINATION, ("call_id", "agent_id")),
        Check("calls", EXPRESSION, expression="duration_s >= 0"),
    ]
    return check_report(checks, tables.__getitem__)


def dq_raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging checks over the raw feeds, where repeated loads show up."""
    source = stand_in.inputs(spark, sf_dir)
    return check_report(RAW_CHECKS, lambda name: source.raw(name.removeprefix("raw_")))


def dq_failing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw calls that were loaded twice: the rows behind a failing uniqueness check."""
    raw = stand_in.raw_calls(spark, sf_dir)
    return failing_rows(Check("raw_calls", UNIQUE, ("call_id",)), lambda name: raw)


# -- questions ---------------------------------------------------------------------------


def agent_fcr_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.resolution_extremes(_lazy(spark, sf_dir)["daily_agent_metrics"])


def manager_csat_latest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.best_manager_of_latest_month(_lazy(spark, sf_dir)["monthly_manager_metrics"])


def hold_transfer_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.hold_transfer_correlation(_lazy(spark, sf_dir)["daily_agent_metrics"])


def hold_transfer_correlation_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.hold_transfer_correlation_overall(_lazy(spark, sf_dir)["monthly_agent_metrics"])


def manager_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _lazy(spark, sf_dir)
    return insights.manager_drilldown(
        tables["monthly_manager_metrics"], tables["monthly_agent_manager_metrics"]
    )


QUERIES: dict[str, Query] = {
    **{QUERY_NAMES.get(model.name, model.name): _table(model.name) for model in MODELS},
    "scan_day_range": scan_day_range,
    "partitioned_sink": partitioned_sink,
    "ingest_files": ingest_files,
    "duplicate_origins": duplicate_origins,
    "ingest_schema_drift": ingest_schema_drift,
    "seed_dimensions": seed_dimensions,
    "seed_assignments": seed_assignments,
    "dataset_coverage": coverage,
    "raw_duplicates": raw_duplicates,
    "fcr_reason_only": fcr_reason_only,
    "fcr_definition_compare": fcr_definition_compare,
    "fcr_cutover": fcr_cutover,
    "scd2_segments": scd2_segments,
    "segments_after_changes": segments_after_changes,
    "incremental_rows": incremental_rows,
    "incremental_rows_inclusive": incremental_rows_inclusive,
    "incremental_daily": incremental_daily,
    "incremental_callbacks": incremental_callbacks,
    "incremental_late_surveys": incremental_late_surveys,
    "incremental_replay": incremental_replay,
    "incremental_replay_shuffled": incremental_replay_shuffled,
    "upsert_rows": upsert_rows,
    "upsert_composite_key": upsert_composite_key,
    "full_build": full_build,
    "pipeline_full": pipeline_full,
    "table_profile": table_profile,
    "dq_report": dq_report,
    "dq_violations": dq_violations,
    "dq_raw_report": dq_raw_report,
    "dq_failing_rows": dq_failing_rows,
    "agent_fcr_extremes": agent_fcr_extremes,
    "manager_csat_latest_month": manager_csat_latest_month,
    "hold_transfer_correlation": hold_transfer_correlation,
    "hold_transfer_correlation_overall": hold_transfer_correlation_overall,
    "manager_drilldown": manager_drilldown,
}

"""Contact-centre inputs derived from the generic event and customer tables.

Every event becomes one call and one ticket, every third event also a survey
answer. A share of the records is loaded a second time with corrected values,
so that keeping the latest version matters. Some corrections move a record
eleven days on, and one agent loses a whole day of calls that way. Some customers
and reasons are NULL. All arithmetic is on integers.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ringledger.functions.columns import OPEN_END
from ringledger.sources.inputs import Inputs

FIRST_LOAD, SECOND_LOAD = "L1", "L2"

# Declared, so that building a plan does not open files to infer them.
_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_id % 25 AS agent_id",
        "IF(event_id % 100 = 7, NULL, user_id) AS customer_id",
        "event_type",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k",
        "ts + INTERVAL 15 DAYS AS start_ts",
        "20 + (event_id * 37) % 1800 AS base_s",
    )


def _with_corrections(base: DataFrame, corrected: str) -> DataFrame:
    """One row per load of a record: the first, and a second one if it was corrected."""
    first, second = f"'{FIRST_LOAD}'", f"'{SECOND_LOAD}'"
    return base.selectExpr(
        "*", f"explode(IF({corrected}, array({first}, {second}), array({first}))) AS load_id"
    ).selectExpr("*", f"load_id = {second} AS is_correction")


# The day that agent 7 loses.
_EMPTIED = "event_id % 25 = 7 AND to_date(start_ts) = DATE'2024-01-20'"


def _moved(rule: str) -> str:
    """How far a record of the second load is moved."""
    return f"IF(is_correction AND ({rule}), INTERVAL 11 DAYS, INTERVAL 0 DAYS)"


def raw_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _with_corrections(_event_base(spark, sf_dir), f"event_id % 20 = 0 OR ({_EMPTIED})")
    base = base.selectExpr(
        "* EXCEPT (start_ts)",
        "base_s + IF(is_correction, 60, 0) AS seconds",
        f"start_ts + {_moved(f'event_id % 60 = 0 OR ({_EMPTIED})')} AS start_ts",
    )
    return base.selectExpr(
        "event_id AS call_id",
        "agent_id",
        "customer_id",
        "(event_id * 7) % 120 AS queue_hold_time",
        "start_ts",
        "start_ts + make_dt_interval(0, 0, 0, seconds) AS end_ts",
        "seconds AS duration_s",
        "base_s * (k % 5) div 10 AS hold_time_during_call_s",
        "event_type = 'error' AS transfer_flag",
        "load_id",
    )


def raw_crm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_corrections(_event_base(spark, sf_dir), "event_id % 20 = 1").selectExpr(
        "event_id AS crm_id",
        "agent_id",
        "event_id AS call_id",
        "customer_id",
        "IF(event_id % 100 = 3, NULL, event_type) AS reason_code",
        "IF(k < 50, 'low', 'high') AS sub_reason_code",
        # A correction turns the flag round.
        "(k % 10 < 4) <> is_correction AS previous_issue_flag",
        f"start_ts + {_moved('event_id % 60 = 1')} AS created_ts",
        "load_id",
    )


def raw_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _event_base(spark, sf_dir).where("event_id % 3 = 0")
    return (
        _with_corrections(base, "event_id % 60 = 0")
        .selectExpr("*", "start_ts + make_dt_interval(0, 0, 0, base_s) AS call_end", "k % 5 AS mood")
        .selectExpr(
            "event_id AS survey_id",
            "event_id AS call_id",
            "agent_id",
            "customer_id",
            "call_end + INTERVAL 5 SECONDS AS sent_ts",
            "call_end + make_dt_interval(CAST(mood AS INT), 0, 0, 15 + event_id % 46)"
            f" + {_moved('event_id % 120 = 0')} AS response_ts",
            "IF(is_correction, 5 - mood, 1 + mood) AS csat",
            "1 + (k * 7 + event_id) % 10 AS nps",
            "load_id",
        )
    )


def loads(spark: SparkSession) -> DataFrame:
    # An inline relation: Spark knows its size and can broadcast it on its own.
    return spark.sql(
        f"""SELECT * FROM VALUES
            ('{FIRST_LOAD}', TIMESTAMP_NTZ'2024-03-01 00:00:00'),
            ('{SECOND_LOAD}', TIMESTAMP_NTZ'2024-03-02 00:00:00') AS t(load_id, inserted_at)"""
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return nation.selectExpr("CAST(n_nationkey AS BIGINT) AS agent_id", "n_name AS agent_name")


def managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region")
    return region.selectExpr("CAST(r_regionkey AS BIGINT) AS manager_id", "r_name AS manager_name")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    return customer.selectExpr("c_custkey AS customer_id", "c_mktsegment AS program")


def agent_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agents stay with one manager, or move to the next one late in January."""
    nation = read_table(spark, sf_dir, "nation").selectExpr(
        "CAST(n_nationkey AS BIGINT) AS agent_id",
        "CAST(n_regionkey AS BIGINT) AS home",
        "n_nationkey % 3 <> 0 AS moves",
        "date_add(DATE'2024-01-25', n_nationkey) AS move_day",
        f"DATE'{OPEN_END}' AS open_end",
    )
    return nation.selectExpr(
        "agent_id",
        """inline(filter(array(
            struct(home AS manager_id, DATE'2024-01-01' AS effective_start,
                   IF(moves, date_sub(move_day, 1), open_end) AS effective_end),
            struct((home + 1) % 5 AS manager_id, move_day AS effective_start, open_end AS effective_end)
        ), segment -> moves OR segment.effective_start < move_day))""",
    )


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    raw = {"calls": raw_calls, "crm": raw_crm, "surveys": raw_surveys}
    seeds = {
        "agents": agents,
        "managers": managers,
        "customers": customers,
        "agent_assignments": agent_assignments,
    }
    return Inputs(
        raw={name: partial(make, spark, sf_dir) for name, make in raw.items()},
        loads={name: partial(loads, spark) for name in raw},
        seeds={name: partial(make, spark, sf_dir) for name, make in seeds.items()},
    )

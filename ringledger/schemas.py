"""Column layouts of the inputs (raw records, load log, seeds)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


LONG, TEXT, FLAG, DAY, TIME = (
    T.LongType(),
    T.StringType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CALLS = _struct(
    call_id=LONG,
    agent_id=LONG,
    customer_id=LONG,
    queue_hold_time=LONG,
    start_ts=TIME,
    end_ts=TIME,
    duration_s=LONG,
    hold_time_during_call_s=LONG,
    transfer_flag=FLAG,
)
CRM = _struct(
    crm_id=LONG,
    agent_id=LONG,
    call_id=LONG,
    customer_id=LONG,
    reason_code=TEXT,
    sub_reason_code=TEXT,
    previous_issue_flag=FLAG,
    created_ts=TIME,
)
SURVEYS = _struct(
    survey_id=LONG,
    call_id=LONG,
    agent_id=LONG,
    customer_id=LONG,
    sent_ts=TIME,
    response_ts=TIME,
    csat=LONG,
    nps=LONG,
)
LOADS = _struct(load_id=TEXT, inserted_at=TIME)

AGENTS = _struct(agent_id=LONG, agent_name=TEXT)
MANAGERS = _struct(manager_id=LONG, manager_name=TEXT)
CUSTOMERS = _struct(
    customer_id=LONG,
    first_name=TEXT,
    last_name=TEXT,
    birth_date=DAY,
    state=TEXT,
    zip_code=TEXT,  # text, as leading zeros matter
    program=TEXT,
)
AGENT_ASSIGNMENTS = _struct(agent_id=LONG, manager_id=LONG, effective_start=DAY, effective_end=DAY)
SEEDS = {
    "agents": AGENTS,
    "managers": MANAGERS,
    "customers": CUSTOMERS,
    "agent_assignments": AGENT_ASSIGNMENTS,
}


@dataclass(frozen=True)
class Dataset:
    """One raw feed: its business key, event time, and the day its files are filed under."""

    name: str
    key: str
    event_ts: str
    columns: T.StructType

    @property
    def column_names(self) -> list[str]:
        return self.columns.fieldNames()


DATASETS = {
    "calls": Dataset("calls", "call_id", "start_ts", CALLS),
    "crm": Dataset("crm", "crm_id", "created_ts", CRM),
    # A survey arrives when it is answered, which may be days after it was sent.
    "surveys": Dataset("surveys", "survey_id", "response_ts", SURVEYS),
}

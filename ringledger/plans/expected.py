"""What each query must return, as SQL over the same input tables (DuckDB dialect)."""

from __future__ import annotations

import re

from ringledger.operators.quality import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Check,
)
from ringledger.plans.checks import CHECKS, RAW_CHECKS

# Named sub-queries. Each may use the ones above it.
PARTS: dict[str, str] = {}

PARTS["occurrence"] = """
    SELECT event_id, event_id % 25 AS agent_id,
           CASE WHEN event_id % 100 <> 7 THEN user_id END AS customer_id, event_type,
           CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
           ts + INTERVAL 15 DAY AS began,
           20 + (event_id * 37) % 1800 AS secs
    FROM events"""

PARTS["loads"] = """
    SELECT * FROM (VALUES ('L1', TIMESTAMP '2024-03-01 00:00:00'),
                          ('L2', TIMESTAMP '2024-03-02 00:00:00')) AS v(load_id, inserted_at)"""

PARTS["raw_calls"] = """
    SELECT event_id AS call_id, agent_id, customer_id, (event_id * 7) % 120 AS queue_hold_time,
           began + to_days(late) AS start_ts, began + to_days(late) + to_seconds(secs + extra) AS end_ts,
           CAST(secs + extra AS BIGINT) AS duration_s,
           CAST(secs * (k % 5) // 10 AS BIGINT) AS hold_time_during_call_s,
           event_type = 'error' AS transfer_flag, load_id
    FROM (SELECT *, event_id % 25 = 7 AND CAST(began AS DATE) = DATE '2024-01-20' AS emptied FROM occurrence),
         (VALUES ('L1', 0), ('L2', 60)) AS version(load_id, extra),
         LATERAL (SELECT CASE WHEN load_id = 'L2' AND (event_id % 60 = 0 OR emptied) THEN 11 ELSE 0 END AS late)
    WHERE load_id = 'L1' OR event_id % 20 = 0 OR emptied"""

PARTS["raw_crm"] = """
    SELECT event_id AS crm_id, agent_id, event_id AS call_id, customer_id,
           CASE WHEN event_id % 100 <> 3 THEN event_type END AS reason_code,
           CASE WHEN k < 50 THEN 'low' ELSE 'high' END AS sub_reason_code,
           (k % 10 < 4) = (load_id = 'L1') AS previous_issue_flag,
           began + to_days(CASE WHEN load_id = 'L2' AND event_id % 60 = 1 THEN 11 ELSE 0 END) AS created_ts, load_id
    FROM occurrence, (VALUES ('L1'), ('L2')) AS version(load_id)
    WHERE load_id = 'L1' OR event_id % 20 = 1"""

PARTS["raw_surveys"] = """
    SELECT event_id AS survey_id, event_id AS call_id, agent_id, customer_id,
           began + to_seconds(secs + 5) AS sent_ts,
           began + to_seconds(secs + 15 + event_id % 46) + to_days(CAST(k % 5 AS INTEGER))
               + to_days(CASE WHEN load_id = 'L2' AND event_id % 120 = 0 THEN 11 ELSE 0 END) AS response_ts,
           CASE load_id WHEN 'L1' THEN 1 + k % 5 ELSE 5 - k % 5 END AS csat,
           1 + (k * 7 + event_id) % 10 AS nps, load_id
    FROM occurrence, (VALUES ('L1'), ('L2')) AS version(load_id)
    WHERE event_id % 3 = 0 AND (load_id = 'L1' OR event_id % 60 = 0)"""

PARTS["agents"] = "SELECT CAST(n_nationkey AS BIGINT) AS agent_id, n_name AS agent_name FROM nation"
PARTS["managers"] = "SELECT CAST(r_regionkey AS BIGINT) AS manager_id, r_name AS manager_name FROM region"
PARTS["customers"] = "SELECT c_custkey AS customer_id, c_mktsegment AS program FROM customer"
PARTS["agent_assignments"] = """
    SELECT CAST(n_nationkey AS BIGINT) AS agent_id, CAST(n_regionkey AS BIGINT) AS manager_id,
           DATE '2024-01-01' AS effective_start,
           CASE WHEN n_nationkey % 3 = 0 THEN DATE '2262-04-11' ELSE DATE '2024-01-24' + n_nationkey END
               AS effective_end
    FROM nation
    UNION ALL
    SELECT n_nationkey, (n_regionkey + 1) % 5, DATE '2024-01-25' + n_nationkey, DATE '2262-04-11'
    FROM nation WHERE n_nationkey % 3 <> 0"""


def _newest(raw: str, key: str) -> str:
    return f"""
    SELECT r.* EXCLUDE (load_id) FROM {raw} AS r JOIN loads USING (load_id)
    QUALIFY inserted_at = max(inserted_at) OVER (PARTITION BY {key})"""


PARTS["stg_calls"] = _newest("raw_calls", "call_id")
PARTS["stg_crm"] = _newest("raw_crm", "crm_id")
PARTS["stg_surveys"] = _newest("raw_surveys", "survey_id")

PARTS["mart_calls"] = """
    SELECT f.*, agent_name, program AS customer_program
    FROM stg_calls AS f JOIN agents USING (agent_id) JOIN customers USING (customer_id)"""
PARTS["mart_crm"] = """
    SELECT f.*, agent_name, program AS customer_program
    FROM stg_crm AS f JOIN agents USING (agent_id) JOIN customers USING (customer_id)"""
PARTS["mart_surveys"] = """
    SELECT f.*, agent_name, program AS customer_program,
           date_diff('day', sent_ts, response_ts) AS days_to_respond,
           CASE WHEN nps >= 9 THEN 1 WHEN nps >= 7 THEN 0 WHEN nps IS NOT NULL THEN -1 END AS nps_calc
    FROM stg_surveys AS f JOIN agents USING (agent_id) JOIN customers USING (customer_id)"""

PARTS["mart_crm_callbacks"] = """
    SELECT a.crm_id AS original_crm_id, b.crm_id AS callback_crm_id,
           a.agent_id AS original_agent_id, b.agent_id AS callback_agent_id, customer_id,
           a.created_ts AS original_created_ts, b.created_ts AS callback_created_ts,
           date_diff('day', a.created_ts, b.created_ts) AS days_between,
           a.reason_code = b.reason_code AS same_reason_flag,
           a.sub_reason_code = b.sub_reason_code AS same_sub_reason_flag,
           b.previous_issue_flag AS callback_previous_issue_flag
    FROM mart_crm AS a JOIN mart_crm AS b USING (customer_id)
    WHERE b.created_ts - a.created_ts > INTERVAL 0 DAY
      AND b.created_ts - a.created_ts <= INTERVAL 3 DAY"""


def _repeat(extra: str = "") -> str:
    return f"""EXISTS (
        SELECT 1 FROM mart_crm AS later
        WHERE later.customer_id = t.customer_id AND later.reason_code = t.reason_code
          AND later.sub_reason_code = t.sub_reason_code {extra}
          AND later.created_ts > t.created_ts AND later.created_ts <= t.created_ts + INTERVAL 3 DAY)"""


PARTS["checked"] = f"""
    SELECT t.*, {_repeat()} AS again, {_repeat("AND later.previous_issue_flag")} AS again_flagged
    FROM mart_crm AS t"""


def _resolution(missed: str) -> str:
    return f"""
    SELECT crm_id, agent_id, agent_name, CAST(created_ts AS DATE) AS fcr_date, 1 AS fcr_denom,
           CASE WHEN {missed} THEN 0 ELSE 1 END AS fcr_num
    FROM checked"""


PARTS["mart_first_call_resolution"] = _resolution("again_flagged")


def _with_manager(inner: str, day: str) -> str:
    return f"""
    SELECT s.*, manager_id, manager_name
    FROM ({inner}) AS s
    JOIN agent_assignments AS h ON h.agent_id = s.agent_id
         AND s.{day} >= effective_start AND s.{day} <= effective_end
    JOIN managers USING (manager_id)"""


PARTS["daily_agent_call_metrics_source"] = _with_manager(
    """SELECT agent_id, agent_name, CAST(start_ts AS DATE) AS call_date,
              CAST(sum(duration_s) AS BIGINT) AS duration_sum,
              CAST(sum(hold_time_during_call_s) AS BIGINT) AS agent_hold_time_sum,
              count(*) FILTER (WHERE transfer_flag) AS transfer_sum, count(*) AS call_count
       FROM mart_calls GROUP BY ALL""",
    "call_date",
)
PARTS["daily_agent_crm_metrics_source"] = _with_manager(
    """SELECT agent_id, agent_name, fcr_date AS call_date,
              CAST(sum(fcr_num) AS BIGINT) AS fcr_sum, count(*) AS fcr_denom
       FROM mart_first_call_resolution GROUP BY ALL""",
    "call_date",
)
PARTS["daily_agent_survey_metrics_source"] = _with_manager(
    """SELECT agent_id, agent_name, CAST(sent_ts AS DATE) AS survey_date,
              CAST(sum(csat) AS BIGINT) AS csat_sum, CAST(sum(nps_calc) AS BIGINT) AS nps_calc_sum,
              count(*) AS survey_count
       FROM mart_surveys GROUP BY ALL""",
    "survey_date",
)


def _card(ids: tuple[str, ...], names: tuple[str, ...], monthly: bool) -> str:
    period = "call_month" if monthly else "call_date"
    keys = ", ".join(ids)

    def when(day: str) -> str:
        return f"CAST(date_trunc('month', {day}) AS DATE)" if monthly else day

    match = f"USING ({keys}, {period})"
    shown = "" if monthly else "calls, "
    return f"""
    SELECT {keys}, {", ".join(names)}, {period}, {shown.replace("calls", "calls AS call_count")}
           talk / calls AS customer_resolution_time, held / calls AS avg_hold_time,
           moved / calls AS transfer_rate, solved / tickets AS first_call_resolution,
           coalesce(answers, 0) AS survey_count, stars / answers AS csat,
           CAST(score AS DOUBLE) * 100 / answers AS nps
    FROM (SELECT {keys}, {", ".join(names)}, {when("call_date")} AS {period},
                 CAST(sum(call_count) AS BIGINT) AS calls, CAST(sum(duration_sum) AS DOUBLE) AS talk,
                 CAST(sum(agent_hold_time_sum) AS DOUBLE) AS held, CAST(sum(transfer_sum) AS DOUBLE) AS moved
          FROM daily_agent_call_metrics_source GROUP BY ALL)
    LEFT JOIN (SELECT {keys}, {when("call_date")} AS {period}, CAST(sum(fcr_sum) AS DOUBLE) AS solved,
                      CAST(sum(fcr_denom) AS BIGINT) AS tickets
               FROM daily_agent_crm_metrics_source GROUP BY ALL) {match}
    LEFT JOIN (SELECT {keys}, {when("survey_date")} AS {period}, CAST(sum(csat_sum) AS DOUBLE) AS stars,
                      CAST(sum(nps_calc_sum) AS BIGINT) AS score,
                      CAST(sum(survey_count) AS BIGINT) AS answers
               FROM daily_agent_survey_metrics_source GROUP BY ALL) {match}"""


_AGENT, _MANAGER = ("agent_id", "agent_name"), ("manager_id", "manager_name")
PARTS["daily_agent_metrics"] = _card(_AGENT[:1], _AGENT[1:], False)
PARTS["daily_agent_manager_metrics"] = _card(
    (_AGENT[0], _MANAGER[0]), (_AGENT[1], _MANAGER[1]), False
)
PARTS["monthly_agent_metrics"] = _card(_AGENT[:1], _AGENT[1:], True)
PARTS["monthly_agent_manager_metrics"] = _card((_AGENT[0], _MANAGER[0]), (_AGENT[1], _MANAGER[1]), True)
PARTS["monthly_manager_metrics"] = _card(_MANAGER[:1], _MANAGER[1:], True)

TABLES = tuple(name for name in PARTS if name.startswith(("stg_", "mart_", "daily_", "monthly_")))


def _query(body: str, **changed: str) -> str:
    """``body`` with the parts it needs in front; ``changed`` replaces some of them."""
    parts = {**PARTS, **changed}
    needed: set[str] = set()
    pending = [body]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in parts:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(parts[name])
    listed = ",\n".join(f"{name} AS ({parts[name]})" for name in parts if name in needed)
    return f"WITH {listed}\n{body}" if listed else body


def _stacked_cards() -> str:
    cards = {
        "daily_agent_metrics": ("agent_id, agent_name", "NULL, NULL", "call_date", "call_count"),
        "daily_agent_manager_metrics": (
            "agent_id, agent_name", "manager_id, manager_name", "call_date", "call_count"),
        "monthly_agent_metrics": ("agent_id, agent_name", "NULL, NULL", "call_month", "NULL"),
        "monthly_agent_manager_metrics": (
            "agent_id, agent_name", "manager_id, manager_name", "call_month", "NULL"),
        "monthly_manager_metrics": ("NULL, NULL", "manager_id, manager_name", "call_month", "NULL"),
    }
    selects = [
        f"SELECT '{name}', {agent}, {manager}, {period}, {calls}, customer_resolution_time, avg_hold_time, "
        f"transfer_rate, first_call_resolution, survey_count, csat, nps FROM {name}"
        for name, (agent, manager, period, calls) in cards.items()
    ]
    return f"""SELECT * FROM ({" UNION ALL ".join(selects)}) AS u(scorecard, agent_id, agent_name, manager_id,
        manager_name, period, call_count, customer_resolution_time, avg_hold_time, transfer_rate,
        first_call_resolution, survey_count, csat, nps)"""


def _check_sql(check: Check) -> str:
    column = ", ".join(check.columns)
    failing = {
        NOT_NULL: f"SELECT count(*) FROM {check.table} WHERE {column} IS NULL",
        UNIQUE: f"""SELECT count(*) FROM (SELECT {column} FROM {check.table} WHERE {column} IS NOT NULL
                    GROUP BY ALL HAVING count(*) > 1)""",
    }.get(check.kind)
    if check.kind == ACCEPTED_VALUES:
        allowed = ", ".join(map(str, check.values))
        failing = f"SELECT count(*) FROM {check.table} WHERE {column} NOT IN ({allowed})"
    elif check.kind == EXPRESSION:
        failing = f"SELECT count(*) FROM {check.table} WHERE ({check.expression}) IS NOT TRUE"
    elif check.kind == RELATIONSHIPS:
        parent, key = check.parent
        failing = (
            f"SELECT count(*) FROM {check.table} AS c WHERE {column} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{key} = c.{column})"
        )
    elif failing is None:
        failing = f"SELECT count(*) FROM (SELECT {column} FROM {check.table} GROUP BY ALL HAVING count(*) > 1)"
    subject = check.subject.replace("'", "''")
    return f"""SELECT '{check.table}' AS table_name, '{check.kind}' AS check_name, '{subject}' AS subject,
        ({failing}) AS failing_rows"""


# Columns of the stored tables, in order, with their Spark types.
_CALL = """start_ts timestamp_ntz, end_ts timestamp_ntz, duration_s bigint,
    hold_time_during_call_s bigint, transfer_flag boolean"""
_TOPIC = """reason_code string, sub_reason_code string, previous_issue_flag boolean,
    created_ts timestamp_ntz"""
_FIGURES = """customer_resolution_time double, avg_hold_time double, transfer_rate double,
    first_call_resolution double, survey_count bigint, csat double, nps double"""
_AGENT_COLUMNS = "agent_id bigint, agent_name string"
_MANAGER_COLUMNS = "manager_id bigint, manager_name string"
_CUSTOMER_COLUMNS = "customer_id bigint, customer_program string"
COLUMNS = {
    "stg_calls": f"call_id bigint, agent_id bigint, customer_id bigint, queue_hold_time bigint, {_CALL}",
    "stg_crm": f"crm_id bigint, agent_id bigint, call_id bigint, customer_id bigint, {_TOPIC}",
    "stg_surveys": """survey_id bigint, call_id bigint, agent_id bigint, customer_id bigint,
        sent_ts timestamp_ntz, response_ts timestamp_ntz, csat bigint, nps bigint""",
    "mart_calls": f"call_id bigint, {_AGENT_COLUMNS}, {_CUSTOMER_COLUMNS}, queue_hold_time bigint, {_CALL}",
    "mart_crm": f"crm_id bigint, {_AGENT_COLUMNS}, call_id bigint, {_CUSTOMER_COLUMNS}, {_TOPIC}",
    "mart_surveys": f"""survey_id bigint, call_id bigint, {_AGENT_COLUMNS}, {_CUSTOMER_COLUMNS},
        sent_ts timestamp_ntz, response_ts timestamp_ntz, days_to_respond bigint, csat bigint, nps bigint,
        nps_calc int""",
    "mart_crm_callbacks": """original_crm_id bigint, callback_crm_id bigint, original_agent_id bigint,
        callback_agent_id bigint, customer_id bigint, original_created_ts timestamp_ntz,
        callback_created_ts timestamp_ntz, days_between bigint, same_reason_flag boolean,
        same_sub_reason_flag boolean, callback_previous_issue_flag boolean""",
    "mart_first_call_resolution": f"crm_id bigint, {_AGENT_COLUMNS}, fcr_date date, fcr_denom int, fcr_num int",
    "daily_agent_call_metrics_source": f"""{_AGENT_COLUMNS}, call_date date, duration_sum bigint,
        agent_hold_time_sum bigint, transfer_sum bigint, call_count bigint, {_MANAGER_COLUMNS}""",
    "daily_agent_crm_metrics_source": f"""{_AGENT_COLUMNS}, call_date date, fcr_sum bigint,
        fcr_denom bigint, {_MANAGER_COLUMNS}""",
    "daily_agent_survey_metrics_source": f"""{_AGENT_COLUMNS}, survey_date date, csat_sum bigint,
        nps_calc_sum bigint, survey_count bigint, {_MANAGER_COLUMNS}""",
    "daily_agent_metrics": f"{_AGENT_COLUMNS}, call_date date, call_count bigint, {_FIGURES}",
    "daily_agent_manager_metrics": f"""{_AGENT_COLUMNS}, {_MANAGER_COLUMNS}, call_date date,
        call_count bigint, {_FIGURES}""",
    "monthly_agent_metrics": f"{_AGENT_COLUMNS}, call_month date, {_FIGURES}",
    "monthly_agent_manager_metrics": f"{_AGENT_COLUMNS}, {_MANAGER_COLUMNS}, call_month date, {_FIGURES}",
    "monthly_manager_metrics": f"{_MANAGER_COLUMNS}, call_month date, {_FIGURES}",
}


def _content_term(column: str, kind: str) -> str:
    """A whole number that depends on one value; the query uses the same rules."""
    value = {
        "boolean": f"CAST({column} AS INTEGER)",
        "double": f"CAST(round({column} * 1000000) AS BIGINT)",
        "date": f"date_diff('day', DATE '1970-01-01', {column})",
        "timestamp_ntz": f"epoch_us({column})",
        "string": f"CAST('0x' || substr(md5({column}), 1, 8) AS BIGINT)",
    }.get(kind, column)
    return f"coalesce(CAST({value} AS HUGEINT), 7)"


def _contents_sql(table: str) -> str:
    columns = [c.split() for c in COLUMNS[table].split(",")]
    # A factor per column, so that values in the wrong column show.
    terms = " + ".join(f"{n} * {_content_term(*column)}" for n, column in enumerate(columns, start=1))
    return f"""SELECT '{table}' AS table_name, count(*) AS rows, CAST(sum({terms}) AS VARCHAR) AS contents
        FROM {table}"""


# Written by hand: what is wrong with the rows the query plants into the calls.
_VIOLATIONS = """
    SELECT table_name, check_name, subject, CAST(n AS BIGINT) AS failing_rows FROM (VALUES
        ('calls', 'unique', 'call_id', 1),
        ('calls', 'not_null', 'agent_id', 2),
        ('calls', 'accepted_values', 'queue', 3),
        ('calls', 'relationships', 'agent_id', 4),
        ('calls', 'unique_combination_of_columns', 'call_id, agent_id', 1),
        ('calls', 'expression_is_true', 'duration_s >= 0', 5)
    ) AS v(table_name, check_name, subject, n)"""


def _profile_sql() -> str:
    rows = []
    for table, columns in COLUMNS.items():
        listed = [c.split() for c in f"{columns}, warehouse_updated_ts timestamp".split(",")]
        rows += [f"('{table}', {n}, '{name}', '{kind}')" for n, (name, kind) in enumerate(listed, start=1)]
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COLUMNS)
    return f"""SELECT table_name, position, column_name, data_type, row_count
        FROM (VALUES {", ".join(rows)}) AS v(table_name, position, column_name, data_type)
        JOIN ({counts}) AS n USING (table_name)"""


def _copies(dataset: str, key: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, {key} AS record_id, count(*) AS copies
        FROM raw_{dataset} GROUP BY {key} HAVING count(*) > 1"""


def _origins(dataset: str, key: str, moment: str) -> str:
    load = "CASE load_id WHEN 'L1' THEN '000000000' ELSE '000000001' END"
    return f"""SELECT '{dataset}' AS dataset, {key} AS record_id, count(*) AS copies,
               string_agg(DISTINCT {load}, ',' ORDER BY {load}) AS loads, CAST(count(*) AS INTEGER) AS files,
               string_agg(DISTINCT CAST(CAST({moment} AS DATE) AS VARCHAR), ',' ORDER BY CAST(CAST({moment} AS DATE) AS VARCHAR)) AS folders
        FROM raw_{dataset} GROUP BY {key} HAVING count(*) > 1"""


def _ingested(dataset: str, key: str, moment: str) -> str:
    return f"""SELECT '{dataset}' AS dataset, {key} AS record_id, CAST({moment} AS DATE) AS event_day,
        CASE load_id WHEN 'L1' THEN '000000000' ELSE '000000001' END AS load_id, true AS logged
        FROM raw_{dataset}"""


_FEEDS = (("calls", "call_id", "start_ts"), ("crm", "crm_id", "created_ts"), ("surveys", "survey_id", "response_ts"))

_VARIES = "min(avg_hold_time) < max(avg_hold_time) AND min(transfer_rate) < max(transfer_rate)"
_FIGURE_NAMES = ("customer_resolution_time", "transfer_rate", "first_call_resolution", "survey_count", "csat", "nps")


def expected_sql() -> dict[str, str]:
    sql = {name: _query(f"SELECT * FROM {name}") for name in TABLES}
    for long, short in (
        ("daily_agent_call_metrics_source", "daily_agent_call_source"),
        ("daily_agent_crm_metrics_source", "daily_agent_crm_source"),
        ("daily_agent_survey_metrics_source", "daily_agent_survey_source"),
    ):
        sql[short] = sql.pop(long)

    sql["scan_day_range"] = _query(
        """SELECT * EXCLUDE (load_id), CAST(start_ts AS DATE) AS day FROM raw_calls
           WHERE CAST(start_ts AS DATE) BETWEEN DATE '2024-01-20' AND DATE '2024-01-26'"""
    )
    sql["partitioned_sink"] = _query(
        "SELECT * EXCLUDE (load_id), CAST(created_ts AS DATE) AS day FROM raw_crm"
    )
    sql["duplicate_origins"] = _query(" UNION ALL ".join(_origins(*feed) for feed in _FEEDS))
    sql["ingest_schema_drift"] = _query(
        """SELECT call_id, CASE load_id WHEN 'L1' THEN '000000000' ELSE '000000001' END AS load_id, duration_s,
                  CASE load_id WHEN 'L1' THEN hold_time_during_call_s END AS hold_time_during_call_s,
                  CASE WHEN load_id = 'L2' AND call_id % 3 <> 0 THEN 'channel ' || call_id % 3 END AS channel,
                  CASE load_id WHEN 'L2' THEN CAST(call_id % 7 AS VARCHAR) END AS desk,
                  CASE load_id WHEN 'L1' THEN '' ELSE 'channel,desk' END AS added,
                  CASE load_id WHEN 'L1' THEN '' ELSE 'hold_time_during_call_s' END AS missing
           FROM raw_calls"""
    )
    sql["ingest_files"] = _query(" UNION ALL ".join(_ingested(*feed) for feed in _FEEDS))
    sql["seed_dimensions"] = """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
               'S' || c_nationkey AS state, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip_code,
               c_mktsegment AS program
        FROM customer"""
    sql["seed_assignments"] = _query(
        _with_manager(
            """SELECT call_id, agent_id, agent_name, CAST(start_ts AS DATE) AS call_date
               FROM stg_calls JOIN agents USING (agent_id)""",
            "call_date",
        )
    )
    sql["dataset_coverage"] = _query(
        f"""SELECT day, calls_rows, crm_rows, surveys_rows,
               CASE WHEN calls_rows > 0 AND crm_rows > 0 AND surveys_rows > 0 THEN 'complete'
                    WHEN calls_rows + crm_rows + surveys_rows > 0 THEN 'partial' ELSE 'missing' END AS status
            FROM (SELECT day, {", ".join(
                f"(SELECT count(*) FROM raw_{d} WHERE CAST({m} AS DATE) = day) AS {d}_rows" for d, _, m in _FEEDS)}
                  FROM (SELECT CAST(unnest(range(DATE '2024-01-10', DATE '2024-02-26', INTERVAL 1 DAY)) AS DATE)
                               AS day))"""
    )
    sql["raw_duplicates"] = _query(" UNION ALL ".join(_copies(d, key) for d, key, _ in _FEEDS))

    sql["fcr_reason_only"] = _query(_resolution("again"))
    sql["fcr_cutover"] = _query(
        _resolution("CASE WHEN created_ts < DATE '2024-02-01' THEN again ELSE again_flagged END")
    )
    sql["fcr_definition_compare"] = _query(
        """SELECT CAST(created_ts AS DATE) AS fcr_date, count(*) AS tickets,
                  count(*) FILTER (WHERE NOT again) AS resolved_before,
                  count(*) FILTER (WHERE NOT again_flagged) AS resolved_after,
                  resolved_before / tickets AS rate_before, resolved_after / tickets AS rate_after
           FROM checked GROUP BY 1"""
    )
    sql["scd2_segments"] = """
        SELECT entity_id, value, effective_start,
               coalesce(lead(effective_start) OVER (PARTITION BY entity_id ORDER BY effective_start) - 1,
                        DATE '2262-04-11') AS effective_end
        FROM (SELECT user_id AS entity_id, CAST(ts AS DATE) AS effective_start,
                     arg_max(event_type, (ts, event_type)) AS value
              FROM events GROUP BY 1, 2)"""
    sql["segments_after_changes"] = sql["scd2_segments"]

    sql["incremental_rows"] = _query("SELECT * FROM stg_calls")
    sql["incremental_rows_inclusive"] = _query(
        """SELECT * FROM stg_calls WHERE start_ts >= TIMESTAMP '2024-01-20 00:00:00'
           AND start_ts <= TIMESTAMP '2024-01-25 00:00:00'"""
    )
    sql["incremental_daily"] = _query("SELECT * FROM daily_agent_metrics")
    sql["incremental_callbacks"] = _query(
        """SELECT * FROM mart_crm_callbacks
           WHERE callback_created_ts < DATE '2024-02-05'
             AND CAST(original_created_ts AS DATE) >= DATE '2024-01-26' - INTERVAL 7 DAY"""
    )
    sql["incremental_late_surveys"] = _query("SELECT * FROM daily_agent_survey_metrics_source")
    sql["incremental_replay"] = _query(_stacked_cards())
    sql["upsert_rows"] = _query("SELECT * FROM stg_calls")
    sql["upsert_composite_key"] = _query("SELECT * FROM stg_crm")

    sql["full_build"] = _query(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in TABLES)
    )
    sql["pipeline_full"] = _query(" UNION ALL ".join(map(_contents_sql, TABLES)))
    sql["incremental_replay_shuffled"] = sql["pipeline_full"]
    sql["table_profile"] = _query(_profile_sql())
    sql["dq_report"] = _query(" UNION ALL ".join(_check_sql(check) for check in CHECKS))
    sql["dq_violations"] = _VIOLATIONS
    sql["dq_raw_report"] = _query(" UNION ALL ".join(_check_sql(check) for check in RAW_CHECKS))
    sql["dq_failing_rows"] = _query(
        "SELECT * FROM raw_calls QUALIFY count(*) OVER (PARTITION BY call_id) > 1"
    )

    sql["agent_fcr_extremes"] = _query(
        """WITH rated AS (SELECT agent_id, agent_name,
                                 round(CAST(sum(CAST(first_call_resolution AS DECIMAL(30, 18))) AS DOUBLE)
                                       / count(first_call_resolution), 14) AS rate
                          FROM daily_agent_metrics GROUP BY agent_id, agent_name
                          HAVING count(first_call_resolution) > 0)
           (SELECT 'highest' AS place, agent_id, agent_name, round(rate, 6) AS avg_first_call_resolution
            FROM rated ORDER BY rate DESC, agent_id LIMIT 1)
           UNION ALL
           (SELECT 'lowest', agent_id, agent_name, round(rate, 6) FROM rated ORDER BY rate, agent_id LIMIT 1)"""
    ).replace("\nWITH rated AS", ",\nrated AS", 1)
    sql["manager_csat_latest_month"] = _query(
        """SELECT manager_id, manager_name, call_month, round(csat, 6) AS csat FROM monthly_manager_metrics
           WHERE csat IS NOT NULL AND call_month = (SELECT max(call_month) FROM monthly_manager_metrics)
           ORDER BY monthly_manager_metrics.csat DESC, manager_id LIMIT 1"""
    )
    sql["hold_transfer_correlation"] = _query(
        f"""SELECT agent_id, agent_name, count(*) AS days,
                   CASE WHEN {_VARIES} THEN round(corr(avg_hold_time, transfer_rate), 6) END
                       AS hold_transfer_correlation
            FROM daily_agent_metrics GROUP BY agent_id, agent_name"""
    )
    sql["hold_transfer_correlation_overall"] = _query(
        f"""SELECT count(*) AS agent_months,
                   CASE WHEN {_VARIES} THEN round(corr(avg_hold_time, transfer_rate), 6) END
                       AS hold_transfer_correlation
            FROM monthly_agent_metrics"""
    )
    figures = ", ".join(f"t.{f} AS team_{f}, a.{f} AS agent_{f}" for f in _FIGURE_NAMES)
    sql["manager_drilldown"] = _query(
        f"""SELECT manager_id, call_month, t.manager_name, agent_id, agent_name, {figures}
            FROM monthly_manager_metrics AS t JOIN monthly_agent_manager_metrics AS a
            USING (manager_id, call_month)"""
    )
    return sql

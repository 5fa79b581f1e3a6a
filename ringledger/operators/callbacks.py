"""Callback detection: a customer's later ticket within a few days of an earlier one.

Two results are built on it. ``callback_pairs`` lists every (original, callback)
pair, because the callback table is a product of its own. Resolution flags only
need to know *whether* a matching callback exists, and ``repeat_flags`` answers
that from two aggregated timestamps per ticket without forming any pair.

Both cut a customer's history into cells as long as the callback period, so the
callbacks of a ticket lie in its own cell or the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.functions.columns import day_number, days_crossed
from ringledger.operators.skew import left_lookup
from ringledger.window import EVERYTHING, Span

CALLBACK_DAYS = 3

# A cell with more tickets than this is split into chunks of about this size.
CHUNK_ROWS = 2000


def _cell(moment: str, callback_days: int) -> str:
    return f"CAST(floor({day_number(moment)} / {int(callback_days)}) AS BIGINT)"


def _chunks_around(tickets: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunk counts of a cell and its neighbours, wherever one of the three is too full for one chunk:
    (customer_id, cell, own, following, previous)."""
    full = tickets.groupBy("customer_id", "cell").agg(F.expr("count(1) AS n")).where(F.col("n") > chunk_rows)
    chunks = f"ceil(n / {int(chunk_rows)})"
    views = f"""inline(array(
        struct(cell, {chunks} AS own, NULL AS following, NULL AS previous),
        struct(cell - 1 AS cell, NULL AS own, {chunks} AS following, NULL AS previous),
        struct(cell + 1 AS cell, NULL AS own, NULL AS following, {chunks} AS previous)))"""
    seen = full.selectExpr("customer_id", views).groupBy("customer_id", "cell")
    return seen.agg(*[F.expr(f"max({name}) AS {name}") for name in ("own", "following", "previous")])


def callback_pairs(
    tickets: DataFrame,
    originals: Span = EVERYTHING,
    callbacks: Span = EVERYTHING,
    callback_days: int = CALLBACK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Every pair of tickets of one customer with 0 < gap <= ``callback_days``.

    An equi join on (customer, cell) with the exact time test on top. Both spans
    are applied before the join, as Spark cannot infer one side's range from the
    other's.

    A customer who owns a large part of all tickets would put a quadratic join
    into one task. Full cells are therefore joined as a grid: originals and
    callbacks are cut into chunks, and each chunk of one side is copied to meet
    each chunk of the other in a task of its own. Every full cell is split,
    however many there are.
    """
    base = tickets.selectExpr(
        "crm_id", "agent_id", "customer_id", "created_ts",
        "reason_code", "sub_reason_code", "previous_issue_flag",
        f"{_cell('created_ts', callback_days)} AS cell",
    ).where("customer_id IS NOT NULL AND created_ts IS NOT NULL")
    # At most three rows per ``chunk_rows`` tickets, mostly none at all: sent to the tickets rather than shuffled with them.
    placed = base.join(F.broadcast(_chunks_around(base, chunk_rows)), ["customer_id", "cell"], "left")
    place = "xxhash64(crm_id, agent_id, reason_code, sub_reason_code, previous_issue_flag)"

    # Rows of the grid are chunks of originals. Its columns are chunks of
    # callbacks: first those of the same cell, then those of the next one. A cell
    # without a full one around it is a grid of one.
    def columns(own: str, following: str) -> str:
        return f"IF({own} IS NULL AND {following} IS NULL, 1L, coalesce({own}, 1L) + coalesce({following}, 1L))"

    def home_column(own: str, following: str) -> str:
        return f"IF({own} IS NULL AND {following} IS NULL, 0L, pmod({place}, coalesce({own}, 1L)))"

    earlier = originals.keep(placed, "created_ts").selectExpr(
        "customer_id",
        "cell",
        f"pmod({place}, coalesce(own, 1L)) AS grid_row",
        f"explode(sequence(0L, {columns('own', 'following')} - 1L)) AS grid_column",
        "crm_id AS original_crm_id",
        "agent_id AS original_agent_id",
        "created_ts AS original_created_ts",
        "reason_code AS original_reason",
        "sub_reason_code AS original_sub_reason",
    )
    # A callback meets originals of its own cell, and of the one before as one from the next cell.
    meets = f"""inline(array(
        struct(cell AS met_in, coalesce(own, 1L) AS grid_rows, {home_column('own', 'following')} AS grid_column),
        struct(cell - 1 AS met_in, coalesce(previous, 1L) AS grid_rows,
               IF(previous IS NULL AND own IS NULL, 0L,
                  coalesce(previous, 1L) + pmod({place}, coalesce(own, 1L))) AS grid_column)))"""
    later = (
        callbacks.keep(placed, "created_ts")
        .selectExpr("* EXCEPT (own, following, previous, cell)", meets)
        .selectExpr(
            "customer_id",
            "met_in AS cell",
            "explode(sequence(0L, grid_rows - 1L)) AS grid_row",
            "grid_column",
            "crm_id AS callback_crm_id",
            "agent_id AS callback_agent_id",
            "created_ts AS callback_created_ts",
            "reason_code AS callback_reason",
            "sub_reason_code AS callback_sub_reason",
            "previous_issue_flag AS callback_previous_issue_flag",
        )
    )
    in_time = f"""callback_created_ts > original_created_ts
        AND callback_created_ts <= original_created_ts + INTERVAL {int(callback_days)} DAYS"""
    # Spark would size either side by the tickets' compressed files and might send millions of rows through the driver.
    return (
        earlier.join(later.hint("merge"), ["customer_id", "cell", "grid_row", "grid_column"])
        .where(in_time)
        .selectExpr(
            "original_crm_id",
            "callback_crm_id",
            "original_agent_id",
            "callback_agent_id",
            "customer_id",
            "original_created_ts",
            "callback_created_ts",
            f"{days_crossed('original_created_ts', 'callback_created_ts')} AS days_between",
            "original_reason = callback_reason AS same_reason_flag",
            "original_sub_reason = callback_sub_reason AS same_sub_reason_flag",
            "callback_previous_issue_flag",
        )
    )


def repeat_flags(
    tickets: DataFrame,
    originals: Span = EVERYTHING,
    callbacks: Span = EVERYTHING,
    callback_days: int = CALLBACK_DAYS,
) -> DataFrame:
    """Tickets with ``repeated`` and ``repeated_flagged``.

    ``repeated``: the customer called again in time with the same reason and
    sub-reason. ``repeated_flagged``: such a callback was also marked as being
    about a previous issue. NULL reasons never match.

    A cell is no longer than the callback period, so a later ticket in the same
    cell is always in time: its existence shows in the cell's *last* ticket. In
    the next cell only the *first* ticket matters. Both are plain max/min, which
    combine on the map side, so a hot customer arrives as a few rows per map task;
    the join back is linear, and AQE splits hot topics in it.
    """
    # Numbers first: sorts then rarely get as far as comparing texts.
    topic = ["customer_id", "cell", "reason_code", "sub_reason_code"]
    celled = tickets.selectExpr(
        "crm_id", "agent_id", "agent_name", "created_ts", "previous_issue_flag",
        "customer_id", "reason_code", "sub_reason_code",
        f"{_cell('created_ts', callback_days)} AS cell",
    )
    # Each ticket is seen from its own cell and from the one before it.
    sightings = callbacks.keep(celled, "created_ts").selectExpr(
        "customer_id",
        "reason_code",
        "sub_reason_code",
        "created_ts",
        "previous_issue_flag",
        "inline(array(struct(cell, false AS ahead), struct(cell - 1 AS cell, true AS ahead)))",
    )
    extents = sightings.groupBy(*topic).agg(
        F.expr("max(IF(NOT ahead, created_ts, NULL)) AS last_own"),
        F.expr("min(IF(ahead, created_ts, NULL)) AS first_next"),
        F.expr("max(IF(NOT ahead AND previous_issue_flag, created_ts, NULL)) AS last_own_flagged"),
        F.expr("min(IF(ahead AND previous_issue_flag, created_ts, NULL)) AS first_next_flagged"),
    )
    # Not broadcast, whatever the tickets' files say: there may be nearly as many extents as tickets.
    placed = left_lookup(originals.keep(celled, "created_ts"), extents.hint("merge"), topic)

    def seen(kind: str) -> str:
        later_in_cell = f"coalesce(last_own{kind} > created_ts, false)"
        soon_in_next = f"first_next{kind} <= created_ts + INTERVAL {int(callback_days)} DAYS"
        return f"{later_in_cell} OR coalesce({soon_in_next}, false)"

    return placed.selectExpr(
        "crm_id",
        "agent_id",
        "agent_name",
        "created_ts",
        f"{seen('')} AS repeated",
        f"{seen('_flagged')} AS repeated_flagged",
    )

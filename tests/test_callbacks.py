from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.operators.callbacks import callback_pairs, repeat_flags
from ringledger.operators.resolution import (
    compare_definitions,
    resolved_unless_flagged,
    resolved_unless_repeated,
    resolved_with_cutover,
)
from ringledger.schemas import DATASETS
from ringledger.window import Span
from tests.conftest import at, rows

MART = T.StructType([*DATASETS["crm"].columns.fields, T.StructField("agent_name", T.StringType())])


def ticket(crm_id, when, customer=1, reason="r", sub="s", flag=True):
    moment = at(when) if isinstance(when, str) else when
    return (crm_id, 1, crm_id, customer, reason, sub, flag, moment, "Ann")


def mart(spark, tickets):
    return spark.createDataFrame(tickets, MART)


def expected_pairs(tickets):
    return sorted(
        (a[0], b[0])
        for a in tickets
        for b in tickets
        if a[3] == b[3] and a[7] < b[7] <= a[7] + timedelta(days=3)
    )


def expected_flags(tickets):
    flags = {}
    for a in tickets:
        again = [
            b
            for b in tickets
            if a[3] == b[3]
            and None not in (a[4], a[5])
            and a[4:6] == b[4:6]
            and a[7] < b[7] <= a[7] + timedelta(days=3)
        ]
        flags[a[0]] = (bool(again), any(b[6] for b in again))
    return flags


def random_tickets(seed, count, hot_share=0.34):
    rng = random.Random(seed)
    first = at("01-16 00:00")
    return [
        ticket(
            n,
            first + timedelta(hours=rng.randrange(24 * 14), microseconds=rng.choice([0, 1])),
            customer=0 if rng.random() < hot_share else rng.randrange(1, 40),
            reason=rng.choice(["a", "b", None]),
            sub=rng.choice(["x", "y", None]),
            flag=rng.choice([True, False, None]),
        )
        for n in range(count)
    ]


def test_edges_of_the_callback_period(spark):
    tickets = [
        ticket(1, "01-16 10:00"),
        ticket(2, "01-16 10:00"),
        ticket(3, "01-16 10:00:01"),
        ticket(4, "01-19 10:00"),
        ticket(5, at("01-19 10:00") + timedelta(microseconds=1)),
        ticket(6, "01-16 11:00", customer=2),
    ]
    pairs = callback_pairs(mart(spark, tickets)).where("original_crm_id = 1")
    assert [r["callback_crm_id"] for r in pairs.orderBy("callback_crm_id").collect()] == [3, 4]


def test_pair_columns(spark):
    tickets = [
        ticket(1, "01-16 23:00", reason=None),
        ticket(2, "01-17 01:00", flag=False),
        ticket(3, "01-17 02:00", sub="t"),
    ]
    found = callback_pairs(mart(spark, tickets)).select(
        "original_crm_id", "callback_crm_id", "days_between",
        "same_reason_flag", "same_sub_reason_flag", "callback_previous_issue_flag",
    )
    assert rows(found) == [
        (1, 2, 1, None, True, False),
        (1, 3, 1, None, False, True),
        (2, 3, 0, True, False, True),
    ]


@pytest.mark.parametrize("chunk_rows", [2, 7, 100_000])
def test_pairs_match_brute_force_however_cells_are_split(spark, chunk_rows):
    tickets = random_tickets(3, 300)
    pairs = callback_pairs(mart(spark, tickets), chunk_rows=chunk_rows)
    assert rows(pairs.select("original_crm_id", "callback_crm_id")) == sorted(
        expected_pairs(tickets), key=repr
    )


def test_pairs_of_one_customer_only(spark):
    tickets = random_tickets(5, 250, hot_share=1.0)
    pairs = callback_pairs(mart(spark, tickets), chunk_rows=10)
    found = [tuple(r) for r in pairs.select("original_crm_id", "callback_crm_id").collect()]
    assert sorted(found) == expected_pairs(tickets)


def test_spans_limit_both_sides(spark):
    tickets = random_tickets(4, 200)
    found = callback_pairs(
        mart(spark, tickets),
        originals=Span(date(2024, 1, 18), None),
        callbacks=Span(None, date(2024, 1, 25)),
        chunk_rows=5,
    )
    when = {t[0]: t[7] for t in tickets}
    wanted = [
        (a, b) for a, b in expected_pairs(tickets) if when[a] >= at("01-18") and when[b] < at("01-25")
    ]
    assert sorted(tuple(r) for r in found.select("original_crm_id", "callback_crm_id").collect()) == wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_flags_match_brute_force(spark, seed):
    tickets = random_tickets(seed, 400)
    flags = repeat_flags(mart(spark, tickets))
    found = {r["crm_id"]: (r["repeated"], r["repeated_flagged"]) for r in flags.collect()}
    assert flags.count() == len(tickets)
    assert found == expected_flags(tickets)


def test_zoned_timestamps_give_the_same_result(spark):
    tickets = random_tickets(6, 200)
    zoned = mart(spark, tickets).withColumn("created_ts", F.col("created_ts").cast("timestamp"))
    found = callback_pairs(zoned, chunk_rows=5).select("original_crm_id", "callback_crm_id")
    assert sorted(tuple(r) for r in found.collect()) == expected_pairs(tickets)
    flags = repeat_flags(zoned).collect()
    assert {r["crm_id"]: (r["repeated"], r["repeated_flagged"]) for r in flags} == expected_flags(tickets)


def test_null_reason_never_disqualifies(spark):
    tickets = [ticket(1, "01-16 10:00", reason=None), ticket(2, "01-16 11:00", reason=None)]
    assert {r["fcr_num"] for r in resolved_unless_flagged(repeat_flags(mart(spark, tickets))).collect()} == {1}


def test_many_callbacks_give_one_row(spark):
    tickets = [ticket(1, "01-16 10:00")] + [ticket(n, f"01-16 1{n}:00") for n in (2, 3, 4)]
    resolved = resolved_unless_flagged(repeat_flags(mart(spark, tickets)))
    assert rows(resolved.where("crm_id = 1").select("fcr_date", "fcr_denom", "fcr_num")) == [
        (date(2024, 1, 16), 1, 0)
    ]
    assert resolved.count() == 4


def test_definitions(spark):
    tickets = [
        ticket(1, "01-16 10:00"),
        ticket(2, "01-16 11:00", flag=False),
        ticket(3, "02-01 10:00"),
        ticket(4, "02-01 11:00", flag=False),
    ]
    checked = repeat_flags(mart(spark, tickets))

    def missed(resolution):
        return sorted(r["crm_id"] for r in resolution.where("fcr_num = 0").collect())

    assert missed(resolved_unless_repeated(checked)) == [1, 3]
    assert missed(resolved_unless_flagged(checked)) == []
    assert missed(resolved_with_cutover(checked, date(2024, 2, 1))) == [1]
    compared = compare_definitions(checked)
    assert rows(compared) == [
        (date(2024, 1, 16), 2, 1, 2, 0.5, 1.0),
        (date(2024, 2, 1), 2, 1, 2, 0.5, 1.0),
    ]

"""Segments kept up to date, and the join on them, against the plainest way to say the same."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ringledger.operators.assignments import in_force, segments_from_changes, with_manager
from ringledger.operators.segments import SegmentStore, merged_segments
from tests.conftest import at, rows

FIRST = datetime(2024, 1, 1)


def frame(spark, changes):
    return spark.createDataFrame(changes, "who bigint, what string, at timestamp_ntz, withdrawn boolean")


def built(spark, changes):
    left = {(w, v, t) for w, v, t, gone in changes if not gone} - {(w, v, t) for w, v, t, gone in changes if gone}
    df = spark.createDataFrame(sorted(left), "who bigint, what string, at timestamp_ntz")
    return rows(segments_from_changes(df, "who", "what", "at"))


def random_batches(rng, days, per_batch, batches=3):
    """Changes of few entities on few days, so that they collide; some take back what came before, or what never was."""
    made, result = [], []
    for _ in range(batches):
        batch = []
        for _ in range(per_batch):
            if made and rng.random() < 0.4:
                batch.append((*rng.choice(made), True))
            else:
                change = (rng.randrange(4), rng.choice("abc"), FIRST + timedelta(days=rng.randrange(days), hours=rng.randrange(3)))
                made.append(change)
                batch.append((*change, False))
        result.append(batch)
    return result


@pytest.mark.parametrize("seed", range(5))
def test_any_batches_give_the_segments_of_all_changes(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches = random_batches(rng, days=rng.choice([4, 12, 40]), per_batch=rng.choice([6, 25]))
    store, state = SegmentStore(spark, str(tmp_path), "who", "what", "at"), {}
    for batch in batches:
        store.merge(frame(spark, batch))
        gone = {c[:3] for c in batch if c[3]}
        for c in batch:
            state[c[:3]] = c[:3] not in gone
        wanted = built(spark, [(*c, not there) for c, there in state.items()])
        assert rows(store.read()) == wanted
    store.merge(frame(spark, batches[-1]))  # once more
    assert rows(store.read()) == wanted


def day(n):
    return date(2024, 1, n)


OPEN = date(2262, 4, 11)
STORED = [(1, "a", day(5), day(9)), (1, "b", day(10), day(19)), (1, "c", day(20), OPEN), (2, "a", day(1), OPEN)]


@pytest.mark.parametrize(
    ("touched", "wanted", "gone"),
    [
        ((1, day(12), "x", True), [(1, "b", day(10), day(11)), (1, "x", day(12), day(19))], []),  # split
        ((1, day(10), "x", True), [(1, "a", day(5), day(9)), (1, "x", day(10), day(19))], []),  # taken over
        ((1, day(10), None, False), [(1, "a", day(5), day(19))], [day(10)]),  # joined to the one before
        ((1, day(20), None, False), [(1, "b", day(10), OPEN)], [day(20)]),
        ((1, day(5), None, False), [], [day(5)]),  # the first one goes, nothing takes its days
        ((1, day(2), "x", True), [(1, "x", day(2), day(4)), (1, "a", day(5), day(9))], []),  # before all others
        ((1, day(12), None, False), [(1, "b", day(10), day(19))], []),  # nothing began there
        ((3, day(7), "x", True), [(3, "x", day(7), OPEN)], []),  # a new entity
        ((3, day(7), None, False), [], []),
    ],
)
def test_one_touched_day(spark, touched, wanted, gone):
    stored = spark.createDataFrame(STORED, "who bigint, what string, effective_start date, effective_end date")
    touch = spark.createDataFrame([touched], "who bigint, day date, what string, present boolean")
    found = merged_segments(stored, touch, "who", "what")
    assert rows(found.where("NOT gone").drop("gone")) == sorted(wanted, key=repr)
    assert [r["effective_start"] for r in found.where("gone").collect()] == gone


def test_far_away_segments_are_not_written(spark, tmp_path):
    store = SegmentStore(spark, str(tmp_path), "who", "what", "at")
    store.merge(frame(spark, [(1, "abc"[n % 3], FIRST + timedelta(days=n), False) for n in range(0, 60, 3)]))
    before = set((tmp_path / "segments").rglob("*.parquet"))
    store.merge(frame(spark, [(1, "z", FIRST + timedelta(days=31), False)]))
    new = {p.parent.name for p in set((tmp_path / "segments").rglob("*.parquet")) - before}
    assert new == {"day=2024-01-31", "day=2024-02-01"}


# -- facts and the segments in force -------------------------------------------------------


def joined(facts, segments):
    on = F.expr("who = w AND day BETWEEN effective_start AND effective_end")
    return rows(facts.join(segments.withColumnRenamed("who", "w"), on).select("who", "day", "n", "what"))


def found(facts, segments):
    return rows(in_force(facts, segments, "who", "day").select("who", "day", "n", "segment.what"))


@pytest.mark.parametrize("overlapping", [False, True])
def test_the_same_rows_as_a_range_join(spark, overlapping):
    rng = random.Random(3)
    segments = []
    for who in (1, 2, 3, None):
        start = 0
        for n in range(12):
            end = start + rng.randrange(-2, 6)
            segments.append((who, f"{who}-{n}", FIRST.date() + timedelta(days=start), FIRST.date() + timedelta(days=end)))
            start = rng.randrange(60) if overlapping else max(end, start) + rng.randrange(1, 4)
    segments += [(1, "null start", None, OPEN), (1, "null end", FIRST.date(), None), segments[0]]
    facts = [(rng.choice([1, 2, 3, 4, None]), rng.choice([FIRST.date() + timedelta(days=rng.randrange(-3, 70)), None]), n) for n in range(300)]
    segments = spark.createDataFrame(segments, "who bigint, what string, effective_start date, effective_end date")
    facts = spark.createDataFrame(facts, "who bigint, day date, n int")
    assert found(facts, segments) == joined(facts, segments) and len(found(facts, segments)) > 30


def test_a_hundred_thousand_segments_of_one_agent(spark):
    """Facts are merged with the segments in order, not compared with all of their agent."""
    segments = spark.range(100_000).selectExpr(
        "IF(id < 0, 2, 1) AS agent_id", "id % 7 AS manager_id", "date_add(DATE'1990-01-01', CAST(id AS INT)) AS effective_start",
        "date_add(DATE'1990-01-01', CAST(id AS INT)) AS effective_end",
    )
    daily = spark.range(0, 100_000, 3).selectExpr("IF(id < 0, 2, 1) AS agent_id", "date_add(DATE'1990-01-01', CAST(id AS INT)) AS d", "id AS n")
    managers = spark.range(7).selectExpr("id AS manager_id", "concat('m', id) AS manager_name")
    managed = with_manager(daily, "d", segments, managers, many=True)
    right, n = managed.select(F.count_if(F.expr("manager_id = n % 7 AND manager_name = concat('m', n % 7)")), F.count("*")).first()
    assert (right, n) == (33_334, 33_334)
    plan = managed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_managers_are_the_same_either_way(spark):
    segments = spark.createDataFrame(
        [(1, 1, day(1), day(9)), (1, 2, day(10), OPEN), (2, 1, day(3), OPEN), (2, 3, day(5), day(6)), (3, 9, day(1), OPEN)],
        "agent_id bigint, manager_id bigint, effective_start date, effective_end date",
    )
    daily = spark.range(60).selectExpr("id % 4 AS agent_id", "date_add(DATE'2024-01-01', CAST(id % 15 AS INT)) AS d", "id AS n")
    managers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "manager_id bigint, manager_name string")
    one, other = (rows(with_manager(daily, "d", segments, managers, many=many)) for many in (False, True))
    assert one == other and len(one) > 20


def test_segment_ends_belong_to_it(spark):
    segments = spark.createDataFrame([(1, "a", day(5), day(9)), (1, "b", day(11), OPEN)], "who bigint, what string, effective_start date, effective_end date")
    facts = spark.createDataFrame([(1, day(n), n) for n in (4, 5, 9, 10, 11)], "who bigint, day date, n int")
    assert [(r[2], r[3]) for r in found(facts, segments)] == [(11, "b"), (5, "a"), (9, "a")]
    assert at("01-05 00:00").date() == day(5)

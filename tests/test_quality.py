from __future__ import annotations

from collections import Counter

import pytest

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
from ringledger.plans.checks import CHECKS, SCORECARD_RULES
from tests.conftest import rows

CLEAN = [(1, 1, 5, 10), (2, 1, None, 20), (3, 2, 1, 30)]
PARENT = [(1,), (2,)]
EXPECTATIONS = [
    Check("t", UNIQUE, ("id",)),
    Check("t", NOT_NULL, ("id",)),
    Check("t", ACCEPTED_VALUES, ("score",), values=(1, 5)),
    Check("t", RELATIONSHIPS, ("ref",), parent=("p", "id")),
    Check("t", UNIQUE_COMBINATION, ("id", "ref")),
    Check("t", EXPRESSION, expression="amount > 0"),
]


def tables(spark, entries):
    frames = {
        "t": spark.createDataFrame(entries, "id bigint, ref bigint, score bigint, amount bigint"),
        "p": spark.createDataFrame(PARENT, "id bigint"),
    }
    return frames.__getitem__


def failures(spark, entries):
    report = check_report(EXPECTATIONS, tables(spark, entries))
    return {r["check_name"]: r["failing_rows"] for r in report.collect() if r["failing_rows"]}


def test_clean_rows_pass(spark):
    assert failures(spark, CLEAN) == {}
    assert check_report(EXPECTATIONS, tables(spark, CLEAN)).count() == len(EXPECTATIONS)


@pytest.mark.parametrize(
    ("planted", "failed"),
    [
        ((1, 2, 5, 10), {UNIQUE: 1}),
        ((None, 1, 5, 10), {NOT_NULL: 1}),
        ((4, 1, 3, 10), {ACCEPTED_VALUES: 1}),
        ((4, 9, 5, 10), {RELATIONSHIPS: 1}),
        ((1, 1, 5, 10), {UNIQUE: 1, UNIQUE_COMBINATION: 1}),
        ((4, 1, 5, 0), {EXPRESSION: 1}),
        ((4, 1, 5, None), {EXPRESSION: 1}),  # a NULL is not true
        ((4, None, None, 10), {}),  # NULL passes references and value lists
    ],
)
def test_each_kind_catches_its_violation(spark, planted, failed):
    assert failures(spark, [*CLEAN, planted]) == failed


def test_empty_table_passes(spark):
    assert failures(spark, []) == {}


@pytest.mark.parametrize("kind", range(len(EXPECTATIONS)))
def test_failing_rows_are_the_counted_ones(spark, kind):
    bad = [(1, 1, 3, 0), (None, 9, 5, 10), (None, 9, 5, 10)]
    lookup = tables(spark, CLEAN + bad)
    found = rows(failing_rows(EXPECTATIONS[kind], lookup))
    wanted = {
        UNIQUE: [CLEAN[0], bad[0]],
        NOT_NULL: bad[1:],
        ACCEPTED_VALUES: bad[:1],
        RELATIONSHIPS: bad[1:],
        UNIQUE_COMBINATION: [CLEAN[0], *bad],
        EXPRESSION: bad[:1],
    }[EXPECTATIONS[kind].kind]
    if EXPECTATIONS[kind].kind == RELATIONSHIPS:
        found = [(r[1], r[0], *r[2:]) for r in found]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_one_scan_and_one_exchange_for_all_checks_of_a_table(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables(spark, CLEAN)("t").write.parquet(str(tmp_path / "t"))
    tables(spark, CLEAN)("p").write.parquet(str(tmp_path / "p"))
    plan = check_report(EXPECTATIONS, lambda name: spark.read.parquet(str(tmp_path / name)))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # the table and the one it refers to
    assert plan.count("Exchange") == 2  # all keys and violations; the totals of all tables
    assert "Join" not in plan and "SinglePartition" not in plan


def test_references_between_types_and_to_repeated_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,), (1,), (5_000_000_000,), (None,)], "id bigint")
    checks = [Check("c", RELATIONSHIPS, ("ref",), parent=("p", "id")), Check("p", UNIQUE, ("id",)), Check("p", UNIQUE_COMBINATION, ("id",))]
    found = check_report(checks, {"c": child, "p": parent}.__getitem__).orderBy("table_name", "check_name").collect()
    assert [r["failing_rows"] for r in found] == [2, 1, 1]


def test_a_hot_key_is_combined_before_the_exchange(spark):
    table = spark.range(0, 30_000, 1, 6).selectExpr("IF(id % 3 = 0, -1, id) AS id", "1L AS ref")
    checks = [Check("t", UNIQUE, ("id",)), Check("t", RELATIONSHIPS, ("ref",), parent=("p", "id")), Check("t", NOT_NULL, ("id",))]
    report = check_report(checks, {"t": table, "p": spark.range(5)}.__getitem__)
    assert [r["failing_rows"] for r in report.orderBy("check_name").collect()] == [0, 0, 1]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning(position") and "partial_count" in plan


def test_missing_figures_of_a_scorecard_are_allowed(spark):
    card = spark.createDataFrame(
        [(1.0, 0.0, 0.5, None, None, None)],
        "customer_resolution_time double, avg_hold_time double, transfer_rate double, "
        "first_call_resolution double, csat double, nps double",
    )
    checks = [Check("card", EXPRESSION, expression=rule) for rule in SCORECARD_RULES]
    assert {r["failing_rows"] for r in check_report(checks, lambda _: card).collect()} == {0}
    off = card.selectExpr("customer_resolution_time", "avg_hold_time", "1.5D AS transfer_rate",
                          "first_call_resolution", "csat", "-101D AS nps")
    failed = check_report(checks, lambda _: off).where("failing_rows > 0")
    assert sorted(r["subject"].split()[0] for r in failed.collect()) == ["nps", "transfer_rate"]


def test_catalogue():
    assert len(CHECKS) == len(set(CHECKS)) == 116
    assert Counter(check.kind for check in CHECKS) == {
        UNIQUE: 10,
        NOT_NULL: 49,
        ACCEPTED_VALUES: 7,
        RELATIONSHIPS: 4,
        UNIQUE_COMBINATION: 9,
        EXPRESSION: 37,
    }


def test_rows_are_checked_by_compiled_code_only(spark):
    """Lambdas are not compiled: over callback pairs they took longer than the counting itself."""
    plan = check_report(EXPECTATIONS, tables(spark, CLEAN))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def test_a_row_that_breaks_several_rules(spark):
    entries = [(None, 9, 7, -1), (None, 9, 7, -1), (2, None, None, None), (2, 2, 5, 1)]
    kinds = {"unique": 1, "not_null": 2, "accepted_values": 2, "relationships": 2, "unique_combination_of_columns": 1}
    assert failures(spark, entries) == {**kinds, "expression_is_true": 3}

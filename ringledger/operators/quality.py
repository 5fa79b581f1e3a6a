"""Declarative data checks: one scan and one exchange per table, however many checks it has."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringledger.operators.skew import rows_of_keys

UNIQUE = "unique"
UNIQUE_COMBINATION = "unique_combination_of_columns"
NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"
RELATIONSHIPS = "relationships"
EXPRESSION = "expression_is_true"

Lookup = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Check:
    """One expectation about a table. A NULL passes every kind but ``not_null``
    and, being not true, an expression."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    values: tuple[int, ...] = ()
    parent: tuple[str, str] | None = None
    expression: str | None = None

    @property
    def subject(self) -> str:
        """The columns or the expression, as reported."""
        return self.expression or ", ".join(self.columns)


def _violation(check: Check) -> Column | None:
    """Row-level test for a bad row; ``None`` where a row cannot be judged on its own."""
    if check.kind == NOT_NULL:
        return F.col(check.columns[0]).isNull()
    if check.kind == ACCEPTED_VALUES:
        return ~F.coalesce(F.col(check.columns[0]).isin(*check.values), F.lit(True))
    if check.kind == EXPRESSION:
        return ~F.coalesce(F.expr(check.expression), F.lit(False))
    return None


def _repeated_keys(check: Check, tables: Lookup) -> DataFrame:
    keyed = tables(check.table)
    if check.kind == UNIQUE:
        keyed = keyed.where(F.col(check.columns[0]).isNotNull())
    return keyed.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def _orphans(check: Check, tables: Lookup) -> DataFrame:
    (column,), (parent, parent_column) = check.columns, check.parent
    known = tables(parent).select(F.col(parent_column).alias(column))
    return tables(check.table).where(F.col(column).isNotNull()).join(known, column, "left_anti")


def _offenders(check: Check, tables: Lookup) -> DataFrame:
    """What a check counts: bad rows, or keys that occur more than once."""
    if check.kind in (UNIQUE, UNIQUE_COMBINATION):
        return _repeated_keys(check, tables)
    if check.kind == RELATIONSHIPS:
        return _orphans(check, tables)
    return tables(check.table).where(_violation(check))


def failing_rows(check: Check, tables: Lookup) -> DataFrame:
    """The rows of the table behind a failing check.

    A key may be repeated any number of times, so its rows are not gathered but
    looked up where they are.
    """
    if check.kind not in (UNIQUE, UNIQUE_COMBINATION):
        return _offenders(check, tables)
    return rows_of_keys(tables(check.table), _repeated_keys(check, tables), check.columns)


def _counted(checks: list[tuple[int, Check]], tables: Lookup) -> DataFrame:
    """Per check of one table, named by position, and per key: how many failures there are.

    A row is turned into the keys it has in every check on keys, and one more entry for every rule it breaks by
    itself. Equal entries are counted together, first where they are and then after the one exchange. The keys a
    check refers to come in as entries of their own.
    """
    table = tables(checks[0][1].table)
    kinds = dict(table.dtypes)
    keyed = [(n, check) for n, check in checks if _violation(check) is None]
    slots = [f"key_{c}" for c in dict.fromkeys(c for _, check in keyed for c in check.columns)]

    def entry(position: int, columns: tuple[str, ...]) -> Column:
        values = [F.col(c) if c in columns else F.lit(None).cast(kinds[c]) for c in (s.removeprefix("key_") for s in slots)]
        return F.struct(F.lit(position).alias("position"), *[v.alias(s) for v, s in zip(values, slots, strict=True)])

    def key_of(n: int, check: Check) -> Column:
        if check.kind == UNIQUE_COMBINATION:
            return entry(n, check.columns)
        return F.when(F.col(check.columns[0]).isNotNull(), entry(n, check.columns))

    keys = [key_of(n, check) for n, check in keyed]
    # Few rows break a rule, so that only these go through all of them. No lambda is used, as Spark doesn't compile them.
    rules = [(n, violation) for n, check in checks if (violation := _violation(check)) is not None]
    listed = F.array(*keys)
    if rules:
        broken = [F.when(violation, entry(n, ())) for n, violation in rules]
        some = reduce(Column.__or__, [violation for _, violation in rules])
        listed = F.when(some, F.array(*keys, *broken))
        listed = listed.otherwise(F.array(*keys)) if keys else listed
    found = table.select(F.explode(listed).alias("entry")).where("entry IS NOT NULL").select("entry.*", F.lit(False).alias("known"))
    references = [(n, check) for n, check in keyed if check.kind == RELATIONSHIPS]
    for n, check in references:
        (column,), (parent, parent_column) = check.columns, check.parent
        known = tables(parent).select(
            F.lit(n).alias("position"), F.col(parent_column).alias(f"key_{column}"), F.lit(True).alias("known")
        )
        found = found.unionByName(known, allowMissingColumns=True)
    by_key = found.groupBy("position", *slots).agg(F.count_if(~F.col("known")).alias("n"), F.max("known").alias("known"))
    repeated = F.col("position").isin([n for n, check in keyed if check.kind != RELATIONSHIPS])
    orphaned = F.when(F.col("known"), 0).otherwise(F.col("n"))
    return by_key.select(
        "position",
        F.when(repeated, (F.col("n") > 1).cast("long"))
        .when(F.col("position").isin([n for n, _ in references]), orphaned)
        .otherwise(F.col("n"))
        .alias("failing_rows"),
    )


def check_report(checks: Iterable[Check], tables: Lookup) -> DataFrame:
    """One row per check with its number of failures."""
    numbered = list(enumerate(checks))
    counted: list[DataFrame] = []
    for table in dict.fromkeys(check.table for _, check in numbered):
        counted.append(_counted([(n, c) for n, c in numbered if c.table == table], tables))
    none = counted[0].sparkSession.createDataFrame([(n, 0) for n, _ in numbered], "position int, failing_rows bigint")
    totals = reduce(DataFrame.unionByName, counted, none).groupBy("position").agg(F.sum("failing_rows").alias("failing_rows"))

    # The names come from the list of checks: a map literal, not a join.
    def named(value: Callable[[Check], str]) -> Column:
        pairs = [F.lit(part) for n, check in numbered for part in (n, value(check))]
        return F.element_at(F.create_map(*pairs), F.col("position"))

    return totals.select(
        named(lambda c: c.table).alias("table_name"),
        named(lambda c: c.kind).alias("check_name"),
        named(lambda c: c.subject).alias("subject"),
        "failing_rows",
    )

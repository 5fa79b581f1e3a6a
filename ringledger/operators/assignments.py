"""Effective-dated manager assignments: building the segments and joining on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringledger.functions.columns import OPEN_END


def last_of_each_day(changes: DataFrame, entity: str, value: str, changed_at: str) -> DataFrame:
    """The change that counts of every entity and day: entity, value, changed_at, effective_start."""
    last_of_day = F.row_number().over(
        Window.partitionBy(entity, "effective_start").orderBy(F.desc(changed_at), F.desc(value))
    )
    return (
        changes.select(entity, value, changed_at, F.to_date(changed_at).alias("effective_start"))
        .withColumn("place", last_of_day)
        .where(F.col("place") == 1)
        .drop("place")
    )


def segments_from_changes(changes: DataFrame, entity: str, value: str, changed_at: str) -> DataFrame:
    """Turn change events into segments that end the day before the next change.

    Segments are whole days, so of several changes on one day the last one
    counts. That first step also leaves at most one row per entity and day for
    the ordered window, however many events an entity has.
    """
    daily = last_of_each_day(changes, entity, value, changed_at)
    next_start = F.lead("effective_start").over(Window.partitionBy(entity).orderBy("effective_start"))
    return daily.select(
        entity,
        value,
        "effective_start",
        F.coalesce(F.date_sub(next_start, 1), F.lit(OPEN_END)).alias("effective_end"),
    )


def in_force(facts: DataFrame, segments: DataFrame, entity: str, day: str) -> DataFrame:
    """Every fact with ``segment``, a struct of all columns of each segment of its entity that holds its day.

    Both ends of a segment belong to it. Segments that overlap no earlier one are merged with the facts in order of
    days, so a fact meets the last one that has begun, and not all of its entity. The others are carried along and
    compared one by one.
    Facts that no segment holds are left out, and those without an entity.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in segments.columns])
    sound = segments.select(F.col(entity).alias("_entity"), F.col("effective_start").alias("_at"), F.col("effective_end").alias("_until"), held.alias("segment"))
    sound = sound.where("_at <= _until AND _entity IS NOT NULL")
    so_far = Window.partitionBy("_entity").orderBy("_at", "_until").rowsBetween(Window.unboundedPreceding, -1)
    sound = sound.withColumn("_apart", F.coalesce(F.max("_until").over(so_far) < F.col("_at"), F.lit(True)))

    names = [f"`{c}`" for c in facts.columns]
    fact = facts.where(F.col(entity).isNotNull()).select(
        F.col(entity).alias("_entity"), F.col(day).alias("_at"), F.struct(*names).alias("_fact")
    )
    both = sound.unionByName(fact, allowMissingColumns=True)
    order = Window.partitionBy("_entity").orderBy("_at", F.col("_fact").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    one = F.struct("_until", "segment")
    begun = F.last(F.when(F.col("_apart"), one), ignorenulls=True).over(order)
    others = F.collect_list(F.when(~F.col("_apart"), one)).over(order)
    met = both.withColumns({"_begun": begun, "_others": others}).where("_fact IS NOT NULL")
    held = F.filter(F.concat(F.array("_begun"), "_others"), lambda s: s.isNotNull() & (F.col("_at") <= s["_until"]))
    return met.select("_fact", F.explode(held).alias("_held")).select(*[F.col(f"_fact.{n}") for n in names], "_held.segment")


def with_manager(
    daily: DataFrame, day: str, assignments: DataFrame, managers: DataFrame, many: bool = False
) -> DataFrame:
    """Add the manager an agent had on ``day`` (segment ends included on both sides).

    ``daily`` is already aggregated to one row per agent and day, so this joins
    far fewer rows than the facts have. Days outside every segment are dropped.
    With few segments per agent a join on the agent is cheapest; ``many`` merges
    rows and segments in order of days instead. The rows are the same.
    """
    segment = assignments.select("agent_id", "manager_id", "effective_start", "effective_end")
    if many:
        placed = in_force(daily, segment, "agent_id", day).withColumn("manager_id", F.col("segment.manager_id"))
    else:
        on_duty = F.expr(f"agent_id = assigned_agent AND {day} BETWEEN effective_start AND effective_end")
        placed = daily.join(segment.withColumnRenamed("agent_id", "assigned_agent"), on_duty)
    return placed.join(managers.selectExpr("manager_id", "manager_name"), "manager_id").selectExpr(
        *daily.columns, "manager_id", "manager_name"
    )

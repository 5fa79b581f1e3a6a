"""Effective-dated segments kept up to date: changes that come late or are withdrawn, merged into what is stored.

A segment lasts from the day of a change to the day before the entity's next one. A change that comes late splits the
segment its day lies in, or takes its value over if it begins there; a day whose changes are all withdrawn joins its
segment to the one before. Only segments at the touched days are computed anew and written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ringledger.functions.columns import OPEN_END
from ringledger.operators.assignments import last_of_each_day
from ringledger.operators.upsert import StoredTable
from ringledger.window import EVERYTHING, Span

START, END = "effective_start", "effective_end"


def merged_segments(stored: DataFrame, touched: DataFrame, entity: str, value: str) -> DataFrame:
    """The segments that ``touched`` days make other than they are, and the starts that go.

    ``stored`` has entity, value, effective_start and effective_end, without gaps within an entity. ``touched`` has one
    row per entity and day: the value that begins on it if ``present``, else none does any more. The result has
    the columns of ``stored`` and ``gone``, true for stored starts that are none any more.

    Everything is ordered per entity by whole days, so a window holds two rows per day of its history at most.
    """
    ours = stored.join(touched.select(entity).distinct(), entity, "left_semi")
    rows = ours.select(
        entity, F.col(START).alias("at"), F.lit(0).alias("is_touch"), F.lit(True).alias("present"), value, F.col(END).alias("until")
    ).unionByName(
        touched.select(entity, F.col("day").alias("at"), F.lit(1).alias("is_touch"), "present", value), allowMissingColumns=True
    )
    in_order = Window.partitionBy(entity).orderBy("at", "is_touch")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    onward = in_order.rowsBetween(0, Window.unboundedFollowing)
    touch_day = F.when(F.col("is_touch") == 1, F.col("at"))
    rows = rows.withColumns(
        {
            "next_touch": F.min(touch_day).over(onward),
            "touched_before": F.min(touch_day).over(earlier).isNotNull(),
            "is_first": F.max("until").over(earlier).isNull(),
        }
    )
    # A stored segment is affected by a touch within it or on the day after it; the first one also by an earlier touch.
    at_touch = (F.col("next_touch") <= F.date_add("until", 1)) | (F.col("is_first") & F.col("touched_before"))
    rows = rows.where((F.col("is_touch") == 1) | at_touch)
    # Affected segments that follow each other without a gap are one run; its last day stays what it is.
    last_day = F.max("until").over(earlier)
    rows = rows.withColumn("begins_run", ((F.col("is_touch") == 0) & (F.col("at") > F.date_add(last_day, 1))).cast("int"))
    rows = rows.withColumn("run", F.sum(F.coalesce("begins_run", F.lit(0))).over(in_order))
    rows = rows.withColumn("run_until", F.max("until").over(Window.partitionBy(entity, "run")))
    # On a day that is touched the touch decides.
    day = Window.partitionBy(entity, "run", "at")
    rows = rows.withColumns(
        {"was_stored": F.min("is_touch").over(day) == 0, "decides": F.row_number().over(day.orderBy(F.desc("is_touch"))) == 1}
    ).where("decides")
    starts = F.when(F.col("present"), F.col("at"))
    ahead = Window.partitionBy(entity, "run").orderBy("at").rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("next_start", F.min(starts).over(ahead))
    return rows.where("present OR was_stored").select(
        entity,
        value,
        F.col("at").alias(START),
        F.coalesce(F.date_sub("next_start", 1), F.col("run_until"), F.lit(OPEN_END)).alias(END),
        (~F.col("present")).alias("gone"),
    )


class SegmentStore:
    """Changes and the segments that follow from them, both stored by day.

    A change is told by its entity, time and value; the same change twice is one. Of several on a day the last one
    counts, then the greatest value.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str, value: str, changed_at: str):
        self.spark, self.entity, self.value, self.changed_at = spark, entity, value, changed_at
        self.changes = StoredTable(spark, f"{path}/changes", [entity, changed_at, value], changed_at)
        self.segments = StoredTable(spark, f"{path}/segments", [entity, START], START)

    def merge(self, batch: DataFrame) -> None:
        """Take in changes (entity, value, time, ``withdrawn``), in any order and as late as they like.

        A change that is both brought and withdrawn in a batch is withdrawn; merging a batch again changes nothing.
        """
        key = [self.entity, self.changed_at, self.value]
        withdrawn = batch.where("withdrawn").select(*key).distinct()
        brought = batch.where("NOT withdrawn").select(*key).distinct().join(withdrawn, key, "left_anti")
        self.changes.upsert(brought.select(*key), gone=withdrawn)
        days = batch.select(self.entity, F.to_date(self.changed_at).alias("day")).where("day IS NOT NULL").distinct()
        bounds = days.agg(F.min("day"), F.max("day")).first()
        if bounds[0] is None:
            return
        left = self.changes.read(Span(bounds[0], None)).where(F.to_date(self.changed_at) <= F.lit(bounds[1]))
        winners = last_of_each_day(left, self.entity, self.value, self.changed_at).withColumnRenamed(START, "day")
        touched = days.join(winners, [self.entity, "day"], "left").select(
            self.entity, "day", self.value, F.col(self.changed_at).isNotNull().alias("present")
        )
        new = not self.segments.days()
        stored = self.read() if not new else self._none(touched)
        found = merged_segments(stored, touched, self.entity, self.value)
        if new:
            self.segments.replace(found.drop("gone"))
        else:
            self.segments.upsert(found.where("NOT gone").drop("gone"), gone=found.where("gone").select(self.entity, START))

    def _none(self, touched: DataFrame) -> DataFrame:
        empty = touched.where("false")
        return empty.select(self.entity, self.value, F.col("day").alias(START), F.col("day").alias(END))

    def read(self) -> DataFrame:
        return self.segments.read(EVERYTHING).select(self.entity, self.value, START, END)

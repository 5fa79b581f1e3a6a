"""Stored tables with keyed replacement: Parquet partitioned by day, whole days rewritten by dynamic partition overwrite.

An upsert writes its batch once, finds the days that hold rows of the same keys, and overwrites these days and the
batch's own with the batch and the rows it does not replace. Spark stages such a write and swaps the folders of its
days when all tasks are done. Nothing else is kept: a run that dies while folders are swapped is run again.

A day that loses all its rows is rewritten with one row of nulls, which has no time of update and is never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.session import scratch_dir
from ringledger.window import EVERYTHING, Span

PART = "day"
UPDATED = "warehouse_updated_ts"

#: Columns of a version by which most rows are told apart: when and with which load they came in.
FIRST = 2
#: So many keys may be sent to all tasks: some tens of megabytes.
FEW_KEYS = 500_000

# Records without a date are kept too, in the folder Spark uses for NULL.
Day = date | None


@dataclass(frozen=True)
class WriteInfo:
    """What one write did, counted by the job that wrote: rows, touched days, and per column its type and NULLs."""

    table: str
    rows_written: int
    days: tuple[Day, ...]
    columns: tuple[tuple[str, str], ...]
    nulls: dict[str, int]
    key_ranges: dict[str, tuple[Any, Any]]


class StoredTable:
    """One keyed table, partitioned by the date of ``day_column``.

    ``version`` names columns that order the versions of a record: an upsert then leaves rows alone that are newer
    than the batch's. ``hidden`` columns are stored but not read back. One writer at a time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Iterable[str],
        day_column: str,
        name: str | None = None,
        version: Iterable[str] = (),
        hidden: Iterable[str] = (),
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.day_column = day_column
        self.name = name or self.path.rsplit("/", 1)[-1]
        self.version = list(version)
        self.hidden = list(hidden)
        self._schema: T.StructType | None = None

    # -- reading ---------------------------------------------------------------

    def days(self) -> list[Day]:
        """Days with a folder, by their names alone; some may hold no rows any more."""
        # Asked of the file system, as a failed read would show up as an error of every run that observes its writes.
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(context._jsc.hadoopConfiguration()).exists(folder):
            return []
        files = self.spark.read.schema(f"{PART} date").parquet(self.path).inputFiles()
        names = {re.search(rf"/{PART}=([^/]+)/[^/]*$", file)[1] for file in files}
        days = [None if name == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(name) for name in names]
        return sorted(days, key=lambda day: day or date.min)

    def _rows(self) -> DataFrame:
        if self._schema is None:
            if not self.days():
                raise LookupError(f"table {self.name} has never been written")
            fields = [f for f in self.spark.read.parquet(self.path).schema if f.name != PART]
            self._schema = T.StructType([*fields, T.StructField(PART, T.DateType())])
        return self.spark.read.schema(self._schema).parquet(self.path).where(F.col(UPDATED).isNotNull())

    def read(self, span: Span = EVERYTHING) -> DataFrame:
        """Current rows whose day lies in ``span``; the folders of other days are not opened."""
        return span.keep(self._rows(), PART).drop(PART, *self.hidden)

    # -- writing ---------------------------------------------------------------

    def _stamped(self, df: DataFrame, now: datetime) -> DataFrame:
        stamped = df.withColumn(UPDATED, F.lit(now)).withColumn(PART, F.to_date(self.day_column))
        # Files can hold NULLs whatever the plan says about nullability.
        self._schema = T.StructType([T.StructField(f.name, f.dataType) for f in stamped.schema])
        return stamped

    def _facts(self) -> list[Column]:
        """What is observed of rows while they are written. Rows of nulls, which only hold a day, do not show."""
        columns = [f.name for f in self._schema]
        counts = [F.count(F.col(name)).alias(f"count {name}") for name in columns]
        bounds = [f(key).alias(f"{f.__name__} {key}") for key in self.keys for f in (F.min, F.max)]
        undated = F.count_if(F.col(PART).isNull() & F.col(UPDATED).isNotNull()).alias("undated")
        return [*counts, *bounds, F.collect_set(PART).alias("days"), undated]

    def _write(self, rows: DataFrame, also: Iterable[Day], *facts: Column, placed: DataFrame | None = None) -> dict[str, Any]:
        """Overwrite the days of ``rows``, and those of ``also`` whether or not they get any.

        Rebalancing by day gives every day a few well-sized files, and AQE splits a day that is too big for one task.
        Rows of ``placed`` come from files of their day and are written by the tasks that read them.
        The facts are observed behind it, in the tasks that write.
        """
        if also := list(also):
            none_left = self.spark.createDataFrame([(day,) for day in also], f"{PART} date")
            rows = rows.unionByName(none_left, allowMissingColumns=True)
        seen = Observation()
        rows = rows.hint("rebalance", PART)
        observed = (rows if placed is None else rows.unionByName(placed)).observe(seen, *facts)
        observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)
        return seen.get

    def _info(self, facts: dict[str, Any], rows: int, days: Iterable[Day]) -> WriteInfo:
        columns = tuple((f.name, f.dataType.simpleString()) for f in self._schema if f.name not in (PART, *self.hidden))
        return WriteInfo(
            self.name,
            rows,
            tuple(sorted(set(days), key=lambda day: day or date.min)),
            columns,
            {name: facts[f"count {UPDATED}"] - facts[f"count {name}"] for name, _ in columns},
            {key: (facts[f"min {key}"], facts[f"max {key}"]) for key in self.keys},
        )

    @staticmethod
    def _days_of(facts: dict[str, Any]) -> list[Day]:
        return [*facts["days"], *([None] if facts["undated"] else [])]

    def replace(self, df: DataFrame) -> WriteInfo:
        """Full refresh: afterwards the table holds exactly the rows of ``df``."""
        return self.replace_days(df, EVERYTHING)

    def replace_days(self, df: DataFrame, span: Span) -> WriteInfo:
        """Afterwards the days of ``span`` hold exactly the rows of ``df``, which has no others.

        For tables whose rows of a day are always computed together: nothing old is read or copied.
        """
        now, held = datetime.now(timezone.utc), self.days()
        rows = self._stamped(df, now)
        if span.start is not None or span.end is not None:
            stray = F.raise_error(F.concat(F.lit(f"row of {self.name} outside the replaced days: "), F.col(PART).cast("string")))
            rows = rows.withColumn(PART, F.when(span.holds(F.col(PART)), F.col(PART)).otherwise(stray.cast("date")))
        old = [day for day in held if span.holds_day(day)]
        facts = self._write(rows, old if held else [None], *self._facts())
        return self._info(facts, facts[f"count {UPDATED}"], [*old, *self._days_of(facts)])

    def upsert(self, batch: DataFrame, gone: DataFrame | None = None) -> WriteInfo:
        """Replace the rows that share a key with ``batch`` and add the batch.

        The batch is computed once. ``gone`` lists more keys whose rows go, whether or not the batch has them.
        """
        now, held = datetime.now(timezone.utc), self.days()
        if not held:
            return self.replace(batch)
        folder = scratch_dir(self.spark, f"batch-of-{self.name}")
        seen, stamped = Observation(), self._stamped(batch, now)
        stamped.observe(seen, *self._facts()).write.parquet(folder)
        facts, batch = seen.get, self.spark.read.schema(self._schema).parquet(folder)

        keys = batch.select(*self.keys)
        low, high = facts[f"min {self.keys[0]}"], facts[f"max {self.keys[0]}"]
        if gone is not None:
            keys = keys.unionByName(gone.select(*self.keys)).distinct()
            if self.day_column not in self.keys:
                low, high = keys.agg(F.min(self.keys[0]), F.max(self.keys[0])).first()
        moved, ours, left = set(), set(self._days_of(facts)), None
        if self.day_column in self.keys:
            if gone is not None:
                moved = {row[PART] for row in gone.select(F.to_date(self.day_column).alias(PART)).distinct().collect()}
                moved &= set(held)
        elif low is not None:
            # The range reaches the files' statistics; of what it leaves, only key columns are read.
            stored = self._rows().where(F.col(self.keys[0]).between(F.lit(low), F.lit(high)))
            moved, stale, left = self._met(stored, batch, keys, ours)
            left = left if gone is None else None
            if stale is not None:
                batch = batch.join(stale, self.keys, "left_anti").select(*self._schema.names)
                keys = keys.join(stale, self.keys, "left_anti")
        names, more = self._schema.names, {}
        survivors = self._rows().where(_on(ours if left is not None else ours | moved)).join(keys, self.keys, "left_anti").select(*names)
        if left is not None and moved:
            # Nothing else goes from these days, so their rows needn't be shuffled, neither to find it nor to be filed.
            more["placed"] = self._rows().where(_on(moved)).join(F.broadcast(left), self.keys, "left_anti").select(*names)
        # Reading and overwriting the same days is safe: Spark swaps them after the last task.
        added = F.count_if(F.col(UPDATED) == F.lit(now)).alias("rows")
        rows = self._write(batch.unionByName(survivors), moved - ours, added, **more)["rows"]
        return self._info(facts, rows, ours | moved)

    def _met(
        self, stored: DataFrame, batch: DataFrame, keys: DataFrame, ours: set[Day]
    ) -> tuple[set[Day], DataFrame | None, DataFrame | None]:
        """Days other than ``ours`` with stored rows that go, the keys, if any, of which a newer row is stored, and those of
        the rows that go from these days, if they are few enough to be sent to all tasks.

        Most keys that meet tell nothing: theirs is the newer row, on a day that is written anyway. Only the others are
        listed, once. All of a large table may be asked, so it comes with its keys, its day, the first ``FIRST`` columns of
        the version and a hash of all of them; the rows are compared as a whole only where the former are equal and the
        latter are not.
        """
        elsewhere = ~F.coalesce(_on(ours), F.lit(False))
        if not self.version:
            found = stored.select(*self.keys, PART).join(keys, self.keys, "left_semi").select(PART).where(elsewhere)
            return {row[PART] for row in found.distinct().collect()}, None, None
        columns = [F.struct(*self.version[:FIRST]), F.xxhash64(*self.version, *[F.col(c).isNull() for c in self.version])]

        def brief(rows: DataFrame, side: str, *more: str) -> DataFrame:
            return rows.select(*self.keys, *more, *[c.alias(f"{name}_{side}") for name, c in zip(("first", "hash"), columns)])

        both = brief(stored, "old", PART).join(brief(batch, "new"), self.keys)
        alike = (F.col("first_old") == F.col("first_new")) & (F.col("hash_old") != F.col("hash_new"))
        newer = F.when(alike, F.lit(None)).otherwise(F.col("first_old") > F.col("first_new"))
        told = both.select(*self.keys, PART, newer.alias("newer")).where(F.coalesce("newer", F.lit(True)) | elsewhere)
        seen, folder = Observation(), scratch_dir(self.spark, f"met-by-{self.name}")
        counts = [F.count_if("newer").alias("newer"), F.count_if(~F.col("newer")).alias("older"), F.count_if(F.col("newer").isNull()).alias("open")]
        told.observe(seen, *counts).write.parquet(folder)
        told, found = self.spark.read.schema(told.schema).parquet(folder), seen.get
        met, stale = told.where("NOT newer"), told.where("newer")
        if found["open"]:
            old, new = F.struct(*self.version).alias("old"), F.struct(*self.version).alias("new")
            rest = stored.join(told.where("newer IS NULL").select(*self.keys), self.keys, "left_semi")
            rest = rest.select(*self.keys, PART, old).join(batch.select(*self.keys, new), self.keys).withColumn("newer", F.expr("old > new"))
            rest = rest.select(*self.keys, PART, "newer")
            met, stale = met.unionByName(rest.where(~F.col("newer") & elsewhere)), stale.unionByName(rest.where("newer"))
        moved = {row[PART] for row in met.select(PART).distinct().collect()} if found["older"] or found["open"] else set()
        some = found["newer"] or (found["open"] and not stale.isEmpty())
        stale = stale.select(*self.keys).distinct() if some else None
        few = found["older"] + found["open"] <= FEW_KEYS
        left = met.select(*self.keys).distinct() if few else None
        if left is not None and stale is not None:
            left = left.join(stale, self.keys, "left_anti")
        return moved, stale, left


def _on(days: Iterable[Day]) -> Column:
    """Predicate on the partition column, so that only these folders are opened."""
    test = F.col(PART).isin([day for day in days if day is not None])
    return test | F.col(PART).isNull() if None in days else test

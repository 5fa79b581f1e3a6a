"""Incremental ingestion of day-partitioned files into raw tables.

Every run takes the files it has not seen yet, whichever day folder they are in,
stamps their rows with a load id and logs when the load happened. A file that
was copied under a new name is new, so its rows come in again under a later load;
the staging tables keep the latest version.

Files are read by the layout the feed has now, and what has changed in them is noticed per load: columns that were added
are kept as text in a map, columns that are missing are NULL, both are logged, and a changed type is refused before
any row is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.schemas import LOADS, Dataset
from ringledger.sources.landing import DAY
from ringledger.window import EVERYTHING, Span

EVENT_DAY = "event_day"
ANY_AGE = "36500d"
# Where a raw row comes from, and what its file has beside the feed's columns.
ORIGIN = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("extra", T.MapType(T.StringType(), T.StringType()))])
LOAD_DETAILS = "load_id string, inserted_at timestamp_ntz, files bigint, added array<string>, missing array<string>"
# Types a file may have where the feed has another one: Spark reads them without loss.
READABLE_AS = {
    "bigint": ("int", "smallint", "tinyint"),
    "timestamp_ntz": ("timestamp",),
}


class ChangedType(TypeError):
    """Files have a column in a type the feed can't read."""


def compared(dataset: Dataset, found: T.StructType) -> tuple[list[T.StructField], list[str]]:
    """Columns that files have and the feed does not, and names of those it has and they do not."""
    kinds = {f.name: f.dataType.simpleString() for f in found}
    changed = [
        f"{f.name}: {kinds[f.name]} instead of {kind}"
        for f in dataset.columns
        if f.name in kinds
        and kinds[f.name] != (kind := f.dataType.simpleString())
        and kinds[f.name] not in READABLE_AS.get(kind, ())
    ]
    if changed:
        raise ChangedType(f"{dataset.name}: {', '.join(changed)}")
    added = [f for f in found if f.name not in dataset.column_names and f.name != DAY]
    return added, [name for name in dataset.column_names if name not in kinds]


def _read_files(spark: SparkSession, dataset: Dataset, base: str, files: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The rows of some files with ``ORIGIN``, and names of added and missing columns. Only footers tell these."""
    reader = spark.read.option("basePath", f"{base}/{dataset.name}")
    try:
        found = reader.option("mergeSchema", "true").parquet(*files).schema
    except Exception as error:
        if "CANNOT_MERGE" not in str(error):
            raise
        raise ChangedType(f"{dataset.name}: files of one load have different types for a column") from error
    added, missing = compared(dataset, found)
    schema = T.StructType([*dataset.columns.fields, *added, T.StructField(DAY, T.DateType())])
    entries = [F.struct(F.lit(f.name), F.col(f"`{f.name}`").cast("string").alias("value")) for f in added]
    extra = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())) if added else F.lit(None)
    rows = reader.option("mergeSchema", "false").schema(schema).parquet(*files).select(
        *dataset.column_names, F.col("_metadata.file_path").alias("source_file"), extra.cast(ORIGIN["extra"].dataType).alias("extra")
    )
    return rows, [f.name for f in added], missing


def ingest_new_files(
    spark: SparkSession, dataset: Dataset, base: str, raw: str, files_per_load: int | None = None
) -> None:
    """Bring every unseen file of ``<base>/<dataset>`` into ``<raw>/<dataset>``, then stop.

    All of them make one load, unless ``files_per_load`` cuts a large backlog
    into several.

    The stream's checkpoint remembers the files, whatever their age: a file is new
    if its path is, and may carry any modification time. A micro-batch may be
    handed out again after a failure; it then overwrites the folders of its own
    load, so no row is stored twice. Rows are filed by the day of their event time
    first, so that a window lists its own days only, and not by the folder they
    happened to arrive in.
    """
    target = f"{raw}/{dataset.name}"
    schema = T.StructType([*dataset.columns.fields, T.StructField(DAY, T.DateType())])

    def land(batch: DataFrame, batch_id: int) -> None:
        load, session = f"{batch_id:09d}", batch.sparkSession
        files = sorted(row["file"] for row in batch.select("file").distinct().collect())
        rows, added, missing = _read_files(session, dataset, base, files)
        (
            rows.select("*", F.to_date(dataset.event_ts).alias(EVENT_DAY), F.lit(load).alias("load_id"))
            .hint("rebalance", EVENT_DAY)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(EVENT_DAY, "load_id")
            .parquet(f"{target}/rows")
        )
        stamp = session.range(1, numPartitions=1).select(
            F.current_timestamp().cast("timestamp_ntz").alias("inserted_at"),
            F.lit(len(files)).cast("bigint").alias("files"),
            F.lit(added).cast("array<string>").alias("added"),
            F.lit(missing).cast("array<string>").alias("missing"),
        )
        stamp.write.mode("overwrite").parquet(f"{target}/loads/load_id={load}")

    # By default Spark leaves out files a week older than the newest one it has seen.
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if files_per_load is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    query = (
        reader.parquet(f"{base}/{dataset.name}")
        .select(F.col("_metadata.file_path").alias("file"))
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_all(spark: SparkSession, datasets: Iterable[Dataset], base: str, raw: str) -> None:
    """Ingest several feeds side by side; they share neither files nor checkpoints."""
    feeds = list(datasets)
    with ThreadPoolExecutor(len(feeds)) as pool:
        list(pool.map(lambda feed: ingest_new_files(spark, feed, base, raw), feeds))


def raw_table(
    spark: SparkSession, raw: str, dataset: Dataset, span: Span = EVERYTHING, origin: bool = False
) -> DataFrame:
    """The loads of a dataset, with ``load_id`` and the ``event_day`` they are filed under.

    Of a bounded span only its own day folders are listed. ``origin`` adds the columns of ``ORIGIN``.
    """
    schema = T.StructType(
        [
            *dataset.columns.fields,
            *(ORIGIN.fields if origin else ()),
            T.StructField("load_id", T.StringType()),
            T.StructField(EVENT_DAY, T.DateType()),
        ]
    )
    rows = f"{raw}/{dataset.name}/rows"
    reader = spark.read.schema(schema).option("basePath", rows)
    days = span.listed_days()
    if days is None:
        return span.keep(reader.parquet(rows), EVENT_DAY)
    try:
        return reader.parquet(f"{rows}/{EVENT_DAY}={{{','.join(map(str, days))}}}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def raw_feed(spark: SparkSession, raw: str, dataset: Dataset) -> Callable[..., DataFrame]:
    """A raw table as an input that is read for the days of a run."""

    def of_days(span: Span = EVERYTHING) -> DataFrame:
        return raw_table(spark, raw, dataset, span)

    return of_days


def load_log(spark: SparkSession, raw: str, dataset: Dataset) -> DataFrame:
    """When each load of a dataset happened: (load_id, inserted_at)."""
    return spark.read.schema(LOADS).parquet(f"{raw}/{dataset.name}/loads").select(*LOADS.fieldNames())


def load_details(spark: SparkSession, raw: str, dataset: Dataset) -> DataFrame:
    """The load log with the number of files, and the columns that files had added or lacked."""
    return spark.read.schema(LOAD_DETAILS).parquet(f"{raw}/{dataset.name}/loads")

"""Day-partitioned Parquet files: ``<base>/<dataset>/day=YYYY-MM-DD/part-*.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringledger.schemas import Dataset
from ringledger.window import EVERYTHING, Span

DAY = "day"


def append_days(records: DataFrame, base: str, dataset: Dataset) -> None:
    """File records under the day of their event time, next to files already there.

    Rebalancing by day keeps the number of files per day small; AQE splits a day
    that holds too much for one file.
    """
    (
        records.select(*dataset.column_names, F.to_date(dataset.event_ts).alias(DAY))
        .hint("rebalance", DAY)
        .write.mode("append")
        .partitionBy(DAY)
        .parquet(f"{base}/{dataset.name}")
    )


def scan_days(spark: SparkSession, base: str, dataset: Dataset, span: Span = EVERYTHING) -> DataFrame:
    """Records filed under the days in ``span``, in one scan.

    The test is on the partition column, so other days are pruned before any
    file is opened.
    """
    schema = T.StructType([*dataset.columns.fields, T.StructField(DAY, T.DateType())])
    return span.keep(spark.read.schema(schema).parquet(f"{base}/{dataset.name}"), DAY)

"""Which expected days have data in which feed."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringledger.schemas import DATASETS


def dataset_coverage(
    spark: SparkSession, raw: dict[str, DataFrame], first: date, last: date
) -> DataFrame:
    """Rows per feed for every day from ``first`` to ``last``, and a status.

    ``complete``: every feed has rows, ``missing``: none has, ``partial``: some do.
    Days are counted per feed before they meet, so the join is on a few rows.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    stacked = reduce(
        DataFrame.unionByName,
        [
            raw[name].select(F.lit(name).alias("dataset"), F.to_date(feed.event_ts).alias("day"))
            for name, feed in DATASETS.items()
        ],
    )
    counted = stacked.groupBy("day").agg(
        *[F.count_if(F.col("dataset") == name).alias(f"{name}_rows") for name in DATASETS]
    )
    counts = [f"{name}_rows" for name in DATASETS]
    present = reduce(lambda a, b: a + b, [(F.col(c) > 0).cast("int") for c in counts])
    return (
        days.join(counted, "day", "left")
        .select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts])
        .withColumn(
            "status",
            F.when(present == len(counts), "complete").when(present == 0, "missing").otherwise("partial"),
        )
    )

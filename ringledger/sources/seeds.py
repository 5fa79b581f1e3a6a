"""Small CSV dimensions, read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringledger.schemas import SEEDS


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One seed. Types are declared, never inferred: a zip code stays text.

    The header is checked against the schema, so swapped columns are an error.
    """
    return spark.read.csv(
        f"{folder}/{name}", schema=SEEDS[name], header=True, enforceSchema=False, mode="FAILFAST"
    )


def write_seed(df: DataFrame, folder: str, name: str) -> None:
    df.select(*SEEDS[name].fieldNames()).write.mode("overwrite").csv(f"{folder}/{name}", header=True)

"""Latest version of every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.schemas import Dataset


# When and with which load a record came in: stored with it, so that versions can be told apart later.
LOADED = ("_inserted_at", "_load_id")


def version_columns(dataset: Dataset) -> list[str]:
    """What orders the versions of a record, once it has the columns of ``LOADED``."""
    return [*LOADED, *(name for name in dataset.column_names if name != dataset.key)]


def latest_version(raw: DataFrame, loads: DataFrame, dataset: Dataset, loaded: bool = False) -> DataFrame:
    """Keep, per business key, the record of the most recent load, with its ``LOADED`` columns if wanted.

    Two files of one load share their load time, so the order goes on over the
    load id and then over the record's own values: whichever way the rows are
    partitioned the same one wins.

    Ranking with ``row_number`` and keeping rank 1 lets Spark cut every map task
    down to one row per key before the exchange, so a key with very many copies
    reaches its reducer as one row per map task.
    """
    stamped = raw.join(loads.select("load_id", "inserted_at"), "load_id").withColumnsRenamed(
        {"inserted_at": LOADED[0], "load_id": LOADED[1]}
    )
    newest_first = ", ".join(f"{name} DESC NULLS LAST" for name in version_columns(dataset))
    rank = f"row_number() OVER (PARTITION BY {dataset.key} ORDER BY {newest_first})"
    columns = [*dataset.column_names, *(LOADED if loaded else ())]
    return stamped.selectExpr(*columns, f"{rank} AS version_rank").where("version_rank = 1").selectExpr(*columns)


def repeated_records(raw: DataFrame, dataset: Dataset) -> DataFrame:
    """Business keys that were loaded more than once, with their number of copies."""
    return (
        raw.groupBy(F.col(dataset.key).alias("record_id"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.lit(dataset.name).alias("dataset"), "record_id", "copies")
    )


def repeated_origins(raw: DataFrame, dataset: Dataset) -> DataFrame:
    """Business keys that were loaded more than once, with the loads, files and day folders that hold them.

    ``raw`` has ``load_id`` and ``source_file``. What is listed for a key is distinct before it is shuffled, so a key
    of very many copies arrives as its files.
    """
    folder = F.regexp_extract("source_file", "/day=([^/]+)/", 1)
    return (
        raw.groupBy(F.col(dataset.key).alias("record_id"), "load_id", "source_file")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("record_id")
        .agg(
            F.sum("n").alias("copies"),
            F.array_sort(F.collect_set("load_id")).alias("loads"),
            F.array_sort(F.collect_set("source_file")).alias("files"),
            F.array_sort(F.collect_set(folder)).alias("folders"),
        )
        .where(F.col("copies") > 1)
        .select(F.lit(dataset.name).alias("dataset"), "record_id", "copies", "loads", "files", "folders")
    )

"""Small helpers the operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ringledger
from ringledger.session import scratch_dir

#: The columns of the documents table; every filtering stage returns exactly these.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: White space of the contracts: space and \t \n \v \f \r, nothing else.
SPACE = r"[ \t\n\x0B\f\r]"

#: One Arrow batch holds at most so many rows and so many bytes, so a Python worker's memory is bounded
#: by this and the longest text, whatever the table's size.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20


_shipped: set[str] = set()


def prepared(spark: SparkSession, times: int = 1) -> SparkSession:
    """Bound the session's Arrow batches, and send this package to the executors' Python workers once.

    ``times`` larger batches suit work that goes through a whole batch step by step.

    The driver serves the archive to executors itself (``addPyFile``); they need no folder in common with it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(times * BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(times * BATCH_BYTES))
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(ringledger.__file__).resolve().parent
        base = Path(tempfile.mkdtemp(prefix="ringledger-package-")) / "ringledger"
        spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", root.parent, root.name))
        _shipped.add(application)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage ends here, lost executors lose nothing."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it.

    A column made in an earlier ``withColumn`` may be merged into the lambda that names it and then be
    computed per element; a lambda's own argument can't be.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc32_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

from ringledger.session import build_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "ringledger-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before: dict[str, str | None] = {}

    def change(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir() -> str:
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data in {SF_DIR}")
    return SF_DIR


def at(text: str) -> datetime:
    """'01-16 23:00' in 2024."""
    return datetime.fromisoformat(f"2024-{text}")


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)

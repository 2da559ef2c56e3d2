from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from forecourt.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """Build a frame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture()
def settings(spark):
    """Change session settings for one test."""
    changed: dict[str, str | None] = {}

    def change(**values: object) -> None:
        for key, value in values.items():
            name = "spark.sql." + key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, str(value))

    yield change
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)

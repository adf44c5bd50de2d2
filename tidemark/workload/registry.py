"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.workload.ctes import with_blocks

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; without SQL only its rows can be counted."""
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is taken")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_blocks(sql)
        return run

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def stamped(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that engines need not agree on a timestamp type."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})

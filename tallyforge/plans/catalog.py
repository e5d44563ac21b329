"""The registered queries, each with the SQL that must give the same rows.

Dates, times and lists are turned into text here, so that both engines hand over plain values;
the operators themselves return typed columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.plans.tables import with_views
from tallyforge.streaming.twins import new_folder

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is registered twice")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = with_views(sql)


def written(spark: SparkSession, name: str, write: Callable[[str], None]) -> str:
    """Write to a new shared folder and return its path."""
    folder = new_folder(spark, name)
    write(folder)
    return folder


def text_days(df: DataFrame, column: str = "day") -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


def text_times(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd HH:mm:ss"))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})

"""Unpacking records that arrive several to a row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.predicates import whole_number


def parse_records(df: DataFrame, payload: str, sep: str = ";") -> DataFrame:
    """Split a payload into lines; the id is the second space-separated field."""
    lines = df.select(F.explode(F.split(F.col(payload), F.lit(rf"\Q{sep}\E"))).alias("line"))
    target = whole_number(F.get(F.split("line", " "), F.lit(1)))
    return lines.select(target.alias("target_id"), "line").where(F.col("target_id").isNotNull())


def parse_day_fields(df: DataFrame, column: str = "line") -> DataFrame:
    """Month lines ``total, title, yyyymmdd:n ...`` to ``(title, day, views)``."""
    fields = df.select(F.split(column, "\t").alias("f"))
    tokens = fields.select(
        F.col("f")[1].alias("title"),
        F.explode(F.expr("filter(slice(f, 3, size(f)), x -> x <> '')")).alias("token"),
    )
    return tokens.select(
        "title",
        F.to_date(F.substring_index("token", ":", 1), "yyyyMMdd").alias("day"),
        whole_number(F.substring_index("token", ":", -1)).alias("views"),
    )

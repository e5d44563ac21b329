"""Output shapes and writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.pageviews import days_per_title
from tallyforge.operators.songs import join_sales_songs


def tsv_lines(df: DataFrame) -> DataFrame:
    """All columns joined by tabs, nulls as empty fields."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_text_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    tsv_lines(df).write.mode(mode).text(path)


def month_line(
    daily: DataFrame, days: Sequence[dt.date] | None = None, min_total: int | None = None
) -> DataFrame:
    """``(title, line)`` with line = ``total TAB title TAB yyyymmdd:n TAB ...``, trailing tab kept.

    Every day of the axis is written, and the total covers all days; ``min_total`` keeps titles
    above it only.
    """
    rows = days_per_title(daily, days, min_total)
    token = lambda x: F.concat(F.date_format(x["day"], "yyyyMMdd"), F.lit(":"), x["views"].cast("string"))
    line = F.concat_ws(
        "\t", F.col("total").cast("string"), "title", F.array_join(F.transform("days", token), "\t"), F.lit("")
    )
    return rows.select("title", line.alias("line"))


def month_pivot(daily: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """One column per given day, 0 where the title had no views that day."""
    wide = daily.groupBy("title").pivot("day", list(days)).agg(F.sum("views"))
    return wide.fillna(0)


def write_merged_csv(
    sales: DataFrame, songs: DataFrame, path: str, how: str = "inner", mode: str = "errorifexists"
) -> None:
    """Sales columns then song columns without the key, comma-joined, no header or quoting."""
    joined = join_sales_songs(sales, songs, how)
    order = sales.columns + [c for c in songs.columns if c != "track_id"]
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    joined.select(F.concat_ws(",", *fields).alias("value")).write.mode(mode).text(path)

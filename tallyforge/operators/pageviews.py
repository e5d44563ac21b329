"""Page-view analytics: filtering, daily totals, peaks, ranks and rising runs.

``counts`` has (project, title, views[, day]); ``articles`` (title, day, views) may repeat a
day; ``daily`` has one row per (title, day).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.predicates import is_article, whole_number
from tallyforge.scale import with_position


def filter_articles(counts: DataFrame, project: str = "en") -> DataFrame:
    return counts.where((F.col("project") == project) & is_article("title"))


def project_title_views(counts: DataFrame) -> DataFrame:
    return counts.select("title", "views")


def drop_bad_numbers(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose text ``column`` is an integer, as BIGINT."""
    return df.withColumn(column, whole_number(column)).where(F.col(column).isNotNull())


def line_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("lines"))


def total_views(df: DataFrame) -> DataFrame:
    return df.agg(F.sum("views").alias("views"))


def sum_by_title_day(articles: DataFrame) -> DataFrame:
    return articles.groupBy("title", "day").agg(F.sum("views").alias("views"))


def month_total(daily: DataFrame) -> DataFrame:
    return daily.groupBy("title").agg(F.sum("views").alias("total"))


def having_total(daily: DataFrame, min_total: int = 100_000) -> DataFrame:
    """Titles whose total is above (not at) ``min_total``."""
    return month_total(daily).where(F.col("total") > min_total)


def count_over(df: DataFrame, limit: int = 10_000) -> DataFrame:
    return df.where(F.col("views") > limit).agg(F.count(F.lit(1)).alias("n"))


def max_views(df: DataFrame, needle: str | None = None) -> DataFrame:
    """Highest views, of all rows or of titles containing ``needle``."""
    rows = df if needle is None else df.where(F.col("title").contains(needle))
    return rows.agg(F.max("views").alias("views"))


def sort_views(df: DataFrame) -> DataFrame:
    """Ascending by views.  The other columns break ties, and keep a common count splittable."""
    ties = [c for c in df.columns if c != "views"]
    return df.orderBy("views", *ties)


def most_popular(daily: DataFrame) -> DataFrame:
    """The title with the highest total, and that total."""
    return month_total(daily).orderBy(F.desc("total"), "title").limit(1)


def date_range_filter(daily: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    return daily.where(F.col("day").between(F.lit(lo), F.lit(hi)))


def _first_day() -> Column:
    # Comparing (day, views) gives the same day, but keeps views in the plan, so that the exchange
    # behind ``daily`` is the one its main reader uses and is run once.
    return F.min(F.struct("day", "views"))["day"]


# Days from first to last beyond which a date is taken for a mistake, such as one from a file name.
MAX_SPAN_DAYS = 3_660


def day_axis(daily: DataFrame, days: Sequence[dt.date] | None = None) -> Column:
    """The days to report: those given, else every day from the first to the last seen.

    The query fails when these are more than MAX_SPAN_DAYS apart; give the days then.
    """
    if days is not None:
        return F.array(*[F.lit(d) for d in days])
    last = F.max(F.struct("day", "views"))["day"]
    wide = F.datediff(last, _first_day()) > MAX_SPAN_DAYS
    message = F.lit(f"days of views span more than {MAX_SPAN_DAYS} days; name the days to report")
    axis = F.when(wide, F.raise_error(message).cast("array<date>")).otherwise(F.sequence(_first_day(), last))
    return daily.agg(axis).scalar()


def days_per_title(
    daily: DataFrame, days: Sequence[dt.date] | None = None, min_total: int | None = None
) -> DataFrame:
    """``(title, total, days)``: per title its total and an array of (day, views), one entry per
    day, 0 when absent.  ``min_total`` keeps titles above it.

    A group is at most one entry per calendar day, so collecting it is bounded; a repeated
    (title, day) counts with the sum of its views.
    """
    daily = daily.groupBy("title", "day").agg(F.sum("views").alias("views"))
    seen = daily.groupBy("title").agg(
        F.sum("views").alias("total"),
        F.map_from_entries(F.collect_list(F.struct("day", "views"))).alias("seen"),
    )
    if min_total is not None:
        seen = seen.where(F.col("total") > min_total)
    filled = F.transform(
        "axis",
        lambda d: F.struct(
            d.alias("day"), F.coalesce(F.try_element_at("seen", d), F.lit(0)).alias("views")
        ),
    )
    return seen.withColumn("axis", day_axis(daily, days)).select("title", "total", filled.alias("days"))


def dense_days(daily: DataFrame, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Every (title, day) pair, with 0 views where there was none."""
    return days_per_title(daily, days).select("title", F.inline("days"))


def days_a_beats_b(daily: DataFrame, a: str, b: str) -> DataFrame:
    """Days on which ``a`` has strictly more views than ``b``; no row counts as 0."""
    def views_of(title: str) -> Column:
        return F.sum(F.when(F.col("title") == title, F.col("views")).otherwise(0))

    per_day = daily.where(F.col("title").isin(a, b)).groupBy("day")
    beats = per_day.agg((views_of(a) > views_of(b)).alias("beats"))
    return beats.agg(F.count_if("beats").alias("days"))


def peak_day(daily: DataFrame, title: str | None = None) -> DataFrame:
    """Day of most views per title, the earliest on ties; for one title or for all."""
    rows = daily if title is None else daily.where(F.col("title") == title)
    # max_by combines before the shuffle, which a row_number would not.
    rank = F.struct("views", -F.unix_date("day"))
    return rows.groupBy("title").agg(F.max_by("day", rank).alias("day"), F.max("views").alias("views"))


def list_join(titles: DataFrame, per_title: DataFrame, value: str) -> DataFrame:
    """Each listed title with its ``value``; titles without rows get 0."""
    listed = titles.select("title").distinct()
    return listed.join(per_title.select("title", value), "title", "left").withColumn(
        value, F.coalesce(value, F.lit(0))
    )


def _ranked(listed: DataFrame, value: str) -> DataFrame:
    placed = with_position(listed, [F.desc(value), F.asc("title")], "rank")
    return placed.select("rank", "title", value)


def rank_by_peak(daily: DataFrame, titles: DataFrame) -> DataFrame:
    """Listed titles by their best single day."""
    best = daily.groupBy("title").agg(F.max("views").alias("views"))
    return _ranked(list_join(titles, best, "views"), "views")


def rank_by_total(daily: DataFrame, titles: DataFrame) -> DataFrame:
    """Listed titles by their total."""
    total = daily.groupBy("title").agg(F.sum("views").alias("views"))
    return _ranked(list_join(titles, total, "views"), "views")


def join_list(ranked: DataFrame, block_items: int) -> DataFrame:
    """Ranked titles on comma-joined lines of ``block_items`` titles, numbered by part."""
    part = F.floor((F.col("rank") - 1) / block_items).alias("part")
    entries = F.sort_array(F.collect_list(F.struct("rank", "title")))
    line = F.array_join(F.transform(entries, lambda e: e["title"]), ",")
    return ranked.groupBy(part).agg(line.alias("line"))


def top_with_zero_first_day(daily: DataFrame, first_day: dt.date | None = None) -> DataFrame:
    """The most viewed title among those with no views on the first day."""
    start = F.lit(first_day) if first_day is not None else daily.agg(_first_day()).scalar()
    totals = daily.groupBy("title").agg(
        F.sum("views").alias("total"),
        F.sum(F.when(F.col("day") == start, F.col("views")).otherwise(0)).alias("on_first"),
    )
    quiet = totals.where(F.col("on_first") == 0).select("title", "total")
    return quiet.orderBy(F.desc("total"), "title").limit(1)


def rising_runs(
    daily: DataFrame, drop_open_run: bool = False, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """Per title, the length in days of its longest strictly rising run."""
    views = days_per_title(daily, days).select("title", F.transform("days", lambda x: x["views"]).alias("v"))
    zero = F.struct(
        F.lit(None).cast("bigint").alias("prev"), F.lit(1).alias("run"), F.lit(1).alias("best")
    )

    def step(state: Column, x: Column) -> Column:
        rises = F.coalesce(state["prev"] < x, F.lit(False))
        run = F.when(rises, state["run"] + 1).otherwise(1)
        # With drop_open_run a run counts only once a later day has broken it.
        ended = F.when(rises, F.lit(1)).otherwise(state["run"]) if drop_open_run else run
        return F.struct(
            x.alias("prev"), run.alias("run"), F.greatest(state["best"], ended).alias("best")
        )

    return views.select("title", F.aggregate("v", zero, step, lambda s: s["best"]).alias("run_days"))


def longest_increasing_run(
    daily: DataFrame, drop_open_run: bool = False, days: Sequence[dt.date] | None = None
) -> DataFrame:
    """The longest rising run of any title, and how many titles reach it."""
    by_length = rising_runs(daily, drop_open_run, days).groupBy("run_days").agg(
        F.count(F.lit(1)).alias("titles")
    )
    return by_length.agg(
        F.max("run_days").alias("run_days"), F.max_by("titles", "run_days").alias("titles")
    ).where(F.col("run_days").isNotNull())


def packed_score(packed: DataFrame, lo: str, hi: str, column: str = "packed") -> DataFrame:
    """Score rows of ``date,c1,c2,c3;...``: sum(c1) + max(c2) + max(c3) over dates in the range."""
    items = F.transform(F.split(column, ";"), lambda x: F.split(x, ","))
    chosen = F.filter(items, lambda x: x[0].between(lo, hi))

    def numbers(i: int) -> Column:
        return F.transform("_chosen", lambda x: whole_number(x[i]))

    zero = F.lit(0).cast("bigint")
    total = F.aggregate(numbers(1), zero, lambda s, x: s + F.coalesce(x, zero))
    score = total + F.greatest(F.array_max(numbers(2)), zero) + F.greatest(F.array_max(numbers(3)), zero)
    return packed.withColumn("_chosen", chosen).withColumn("score", score).drop("_chosen", column)

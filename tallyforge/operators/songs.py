"""Catalogue and sales questions: searches, joins, n-th groups, totals per artist.

``songs`` has one row per track_id; ``sales`` any number.  Joins between them take their
strategy from Spark: the adaptive planner broadcasts a side whose measured size allows it and
splits a track that holds much of the sales.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.predicates import any_of


def grep_any_column(df: DataFrame, needle: str) -> DataFrame:
    """Rows whose comma-joined line contains ``needle``, case-sensitive."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    return df.where(line.contains(needle))


def column_contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.where(F.col(column).contains(needle))


def column_matches(df: DataFrame, column: str, pattern: str, ci: bool = False) -> DataFrame:
    """Rows whose ``column`` has a match of the regular expression."""
    return df.where(F.col(column).rlike(f"(?i){pattern}" if ci else pattern))


def last_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one highest by ``order`` (a column without ties within a key)."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def range_and_threshold(
    songs: DataFrame, lo: int = 1970, hi: int = 1989, min_hot: float = 0.8
) -> DataFrame:
    return songs.where(F.col("year").between(lo, hi) & (F.col("artist_hotttnesss") > min_hot))


def equals_ignore_case(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.lower(column) == F.lower(F.lit(value)))


def like_any(df: DataFrame, columns: Sequence[str], pattern: str, ci: bool = False) -> DataFrame:
    """Rows where any of ``columns`` matches the LIKE ``pattern``."""
    match = (lambda c: F.col(c).ilike(pattern)) if ci else (lambda c: F.col(c).like(pattern))
    return df.where(any_of([match(c) for c in columns]))


def max_rows(df: DataFrame, column: str) -> DataFrame:
    """All rows holding the maximum of ``column``."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def average(df: DataFrame, column: str, blanks_as_zero: bool = False) -> DataFrame:
    """Mean of a column; ``blanks_as_zero`` divides by all rows instead of the non-null ones."""
    value = F.coalesce(F.col(column).cast("double"), F.lit(0.0)) if blanks_as_zero else F.col(column)
    return df.agg(F.avg(value).alias("average"))


def join_sales_songs(sales: DataFrame, songs: DataFrame, how: str = "inner") -> DataFrame:
    """Sales with their song; ``how='left'`` keeps sales of unknown tracks.

    A track listed several times gives a row for each; see ``lookup_last`` for the other reading.
    """
    return sales.join(songs, "track_id", how)


def lookup_last(sales: DataFrame, songs: DataFrame, order: str) -> DataFrame:
    """Sales with the last song of their track by ``order``; sales of unknown tracks are kept."""
    return sales.join(last_of_each(songs, "track_id", order).drop(order), "track_id", "left")


def sales_per_track(sales: DataFrame) -> DataFrame:
    """One row per track.  Joining this instead of single sales moves far less data and leaves
    no track heavier than another."""
    return sales.groupBy("track_id").agg(F.sum("sales_count").alias("sales_count"))


def artist_sales(sales: DataFrame, songs: DataFrame, artist_id: str) -> DataFrame:
    """Total sales of the tracks of one artist."""
    tracks = songs.where(F.col("artist_id") == artist_id).select("track_id")
    return (
        sales_per_track(sales)
        .join(tracks, "track_id", "left_semi")
        .agg(F.sum("sales_count").alias("total_sales"))
    )


def songs_selling(songs: DataFrame, sales: DataFrame, min_units: int = 50) -> DataFrame:
    """Songs with at least one sale above ``min_units``, each once."""
    best = sales.where(F.col("sales_count") > min_units).select("track_id").distinct()
    return songs.join(best, "track_id", "left_semi")


def sum_sales_artist(joined: DataFrame) -> DataFrame:
    """Sales per artist id, with one name of the artist."""
    return joined.groupBy("artist_id").agg(
        F.max("artist_name").alias("artist_name"), F.sum("sales_count").alias("sales")
    )


def top_artist(joined: DataFrame) -> DataFrame:
    ranked = sum_sales_artist(joined).orderBy(F.desc_nulls_last("sales"), "artist_id")
    return ranked.limit(1).select("artist_name", "sales")


def group_count(df: DataFrame, keys: Sequence[str], label: str | None = None) -> DataFrame:
    """Rows per group as ``n``; ``label`` adds one representative value of another column."""
    extra = [F.max(label).alias(label)] if label else []
    return df.groupBy(*keys).agg(*extra, F.count(F.lit(1)).alias("n"))


def nth_group(df: DataFrame, keys: Sequence[str], n: int = 3, label: str | None = None) -> DataFrame:
    """The group with the ``n``-th most rows; equal counts go by key."""
    counts = group_count(df, keys, label)
    return counts.orderBy(F.desc("n"), *keys).offset(n - 1).limit(1)

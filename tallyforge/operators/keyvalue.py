"""Key-value change logs ``(seq, ts, k, op, v, loc)`` and lookups by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.scale import HEAVY_ROWS, carry_forward, join_unique


def latest_by_key(log: DataFrame, by_loc: bool = False) -> DataFrame:
    """Value of the last PUT per key (and location); reads do not count."""
    keys = ["k", "loc"] if by_loc else ["k"]
    puts = log.where(F.col("op") == "PUT")
    return puts.groupBy(*keys).agg(F.max_by("v", F.struct("ts", "seq")).alias("v"))


def asof_read(log: DataFrame, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """For each GET the value of the last PUT of its key at or before it, null when none."""
    rows = log.select("k", "ts", "seq", "op", F.when(F.col("op") == "PUT", F.col("v")).alias("put"))
    filled = carry_forward(rows, ["k"], ["ts", "seq"], "put", "value", min_rows)
    return filled.where(F.col("op") == "GET").select("seq", "ts", "k", "value")


def point_lookup(
    df: DataFrame, ids: DataFrame | Sequence, column: str, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Rows whose ``column`` is among ``ids`` (a list, or a DataFrame with that column)."""
    if isinstance(ids, DataFrame):
        return join_unique(df, ids.select(column).distinct(), [column], "left_semi", min_rows)
    return df.where(F.col(column).isin(list(ids)))


def range_lookup(
    requests: DataFrame, targets: DataFrame, width: int = 80, split_at: int = 420_000
) -> DataFrame:
    """``(id, target_id, line)``: the targets prefetched for each requested id.

    Ids below ``split_at`` ask for [id, id + width - 1], the others for [id - width + 1, id].
    A range touches two blocks of ``width`` ids at most, so both sides meet by block in an
    equi-join: two rows per request are moved, and a block holds at most ``width`` targets.
    """
    ascending = F.col("id") < split_at
    wanted = requests.select("id").distinct().select(
        "id",
        F.when(ascending, F.col("id")).otherwise(F.col("id") - (width - 1)).alias("lo"),
        F.when(ascending, F.col("id") + (width - 1)).otherwise(F.col("id")).alias("hi"),
    )
    blocks = F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))
    asked = wanted.withColumn("block", F.explode(blocks))
    held = targets.withColumn("block", F.floor(F.col("target_id") / width))
    return (
        asked.join(held, "block")
        .where(F.col("target_id").between(F.col("lo"), F.col("hi")))
        .select("id", "target_id", "line")
    )

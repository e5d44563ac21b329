"""Load-test logs and threshold alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rps_per_minute(log: DataFrame, target: float = 4000) -> DataFrame:
    """``(test, minute, rps, below_target, first_minute_at_target)``: the hosts of a test summed up.

    The minutes of a test are few, so its first minute at the target is found in a window.
    """
    per_minute = log.groupBy("test", "minute").agg(F.sum("rps").alias("rps"))
    reached = F.when(F.col("rps") >= target, F.col("minute"))
    return per_minute.withColumns(
        {
            "below_target": F.col("rps") < target,
            "first_minute_at_target": F.min(reached).over(Window.partitionBy("test")),
        }
    )


def period_average(df: DataFrame, ts: str, value: str, period: str) -> DataFrame:
    """Mean of ``value`` per tumbling period, as ``(period_start, average)``."""
    grouped = df.groupBy(F.window(F.col(ts).cast("timestamp"), period)).agg(F.avg(value).alias("average"))
    return grouped.select(F.col("window.start").alias("period_start"), "average")


def consecutive_breaches(
    averages: DataFrame, threshold: float, period: str, n: int, below: bool = False
) -> DataFrame:
    """Add ``alarm``: this period and the ``n`` - 1 before it all exist and breach the threshold.

    A breach is reported to the ``n`` periods it can complete and the reports are counted, so no
    global ordering of the periods is needed.
    """
    breach = F.col("average") <= threshold if below else F.col("average") >= threshold
    steps = F.array(*[F.lit(i) for i in range(n)])
    # A period without a breach reports only itself, with no vote.
    reach = F.when(breach, steps).otherwise(F.array(F.lit(0)))
    reports = averages.withColumn("vote", F.when(breach, 1).otherwise(0)).withColumn("step", F.explode(reach))
    moved = F.col("period_start") + F.col("step") * F.expr(f"interval {period}")
    own = F.col("step") == 0
    return (
        reports.groupBy(moved.alias("period_start"))
        .agg(F.max(F.when(own, F.col("average"))).alias("average"), F.sum("vote").alias("votes"))
        .where(F.col("average").isNotNull())
        .select("period_start", "average", (F.col("votes") == n).alias("alarm"))
    )


def alarm_consecutive(
    df: DataFrame,
    ts: str,
    value: str,
    threshold: float,
    period: str = "60 seconds",
    n: int = 2,
    below: bool = False,
) -> DataFrame:
    """Alarm state per period: mean at or over ``threshold`` (or at or under it) ``n`` times in a row."""
    return consecutive_breaches(period_average(df, ts, value, period), threshold, period, n, below)

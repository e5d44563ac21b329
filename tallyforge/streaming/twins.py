"""Structured Streaming twins of the time-based operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyforge.operators.loadtest import consecutive_breaches
from tallyforge.scale import checkpoint_dir, remove


def stream_latest_by_key(stream: DataFrame) -> DataFrame:
    """Running last PUT per key; use update mode.  State is one row per key.

    ``ts`` and ``seq`` of the winning write are kept, so that updates can be merged later.
    """
    stamp = F.struct("ts", "seq")
    puts = stream.where(F.col("op") == "PUT")
    return puts.groupBy("k").agg(F.max_by("v", stamp).alias("v"), F.max(stamp).alias("stamp"))


def _windowed(stream: DataFrame, period: str, ts: str, delay: str):
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return timed.groupBy(F.window("_ts", period))


def stream_rps(
    stream: DataFrame, period: str = "1 minute", ts: str = "ts", value: str = "rps",
    delay: str = "1 minute", target: float = 4000,
) -> DataFrame:
    """Sum per tumbling period with ``below_target``.  Rows later than ``delay`` are dropped."""
    sums = _windowed(stream, period, ts, delay).agg(F.sum(value).alias("rps"))
    return sums.select(
        F.col("window.start").alias("period_start"), "rps", (F.col("rps") < target).alias("below_target")
    )


def stream_period_avg(
    stream: DataFrame, period: str = "60 seconds", ts: str = "ts", value: str = "value",
    delay: str = "60 seconds",
) -> DataFrame:
    """Mean per tumbling period, first half of the alarm."""
    means = _windowed(stream, period, ts, delay).agg(F.avg(value).alias("average"))
    return means.select(F.col("window.start").alias("period_start"), "average")


def start_alarm(
    averages: DataFrame, folder: str, threshold: float, period: str, n: int, below: bool = False
) -> StreamingQuery:
    """Second half of the alarm: evaluate closed periods batch by batch.

    A batch may complete an alarm begun in the one before, so the last ``n`` - 1 periods are kept
    under ``folder/tail`` and read back by the next batch, nothing older.  Every batch writes only
    its own folders, so a replay gives the same files.
    """
    span = F.expr(f"interval {period}") * F.lit(n - 1)

    def close(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Written once and read back: each action on a batch would run its state update again.
        own = f"{folder}/averages/batch={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        closed = spark.read.schema(batch.schema).parquet(own)
        seen = closed
        if batch_id > 0:
            tail = spark.read.schema(batch.schema).parquet(f"{folder}/tail/batch={batch_id - 1}")
            seen = closed.unionByName(tail)
        first = closed.agg(F.min("period_start")).scalar()
        alarms = consecutive_breaches(seen, threshold, period, n, below).where(F.col("period_start") >= first)
        alarms.write.mode("overwrite").parquet(f"{folder}/alarms/batch={batch_id}")
        last = seen.agg(F.max("period_start")).scalar()
        kept = seen.where(F.col("period_start") > last - span)
        kept.write.mode("overwrite").parquet(f"{folder}/tail/batch={batch_id}")
        # A batch starts when the one before is committed: a replay needs its tail and no more.
        remove(spark, f"{folder}/averages/batch={batch_id - 1}")
        remove(spark, f"{folder}/tail/batch={batch_id - 2}")

    return (
        averages.writeStream.outputMode("append")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .foreachBatch(close)
        .start()
    )


ALARMS = "period_start timestamp, average double, alarm boolean"


def read_alarms(spark: SparkSession, folder: str) -> DataFrame:
    """What ``start_alarm`` has found so far, nothing if no period is closed yet."""
    spark.createDataFrame([], ALARMS).write.mode("overwrite").parquet(f"{folder}/alarms/batch=-1")
    return spark.read.schema(ALARMS).parquet(f"{folder}/alarms/batch=*")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for the state and output of one streaming run, on shared storage."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def run_to_files(df: DataFrame, mode: str, folder: str) -> DataFrame:
    """Process everything available and return what was emitted, with ``batch`` numbers.

    Each batch goes to its own folder, overwritten on replay, so a restart cannot duplicate rows.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()
    # So that there is something to read when nothing was emitted.
    df.sparkSession.createDataFrame([], df.schema).write.mode("overwrite").parquet(f"{folder}/out/batch=-1")
    return df.sparkSession.read.schema(df.schema).option("basePath", f"{folder}/out").parquet(
        f"{folder}/out"
    )


def merge_latest(updates: DataFrame) -> DataFrame:
    """Final value per key from the update-mode output of ``stream_latest_by_key``."""
    return updates.groupBy("k").agg(F.max_by("v", "stamp").alias("v"))

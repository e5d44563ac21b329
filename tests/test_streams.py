"""Streaming twins equal their batch operators on the same rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import keyvalue, loadtest
from tallyforge.streaming import twins

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def stream_of(spark, folder, batches, schema):
    """Each list of rows as one file and one micro-batch, in order."""
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/n={i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")


def test_latest_by_key(spark, rows, tmp_path):
    schema = "seq long, ts timestamp, k string, op string, v double, loc int"
    batches = [
        [(1, at(1), "a", "PUT", 1.0, 1), (2, at(2), "b", "PUT", 2.0, 1)],
        [(3, at(5), "a", "PUT", 3.0, 2), (4, at(6), "b", "GET", None, 2)],
        [(5, at(4), "a", "PUT", 4.0, 1), (6, at(2), "b", "PUT", 5.0, 1)],
    ]
    stream = stream_of(spark, str(tmp_path), batches, schema)
    updates = twins.run_to_files(twins.stream_latest_by_key(stream), "update", str(tmp_path / "run"))
    batch = spark.createDataFrame([r for b in batches for r in b], schema)
    assert rows(twins.merge_latest(updates)) == rows(keyvalue.latest_by_key(batch)) == [("a", 3.0), ("b", 5.0)]


def test_rps_and_late_rows(spark, rows, tmp_path):
    schema = "ts timestamp, host string, rps double"
    batches = [
        [(at(0), "a", 1000.0), (at(0.5), "b", 3500.0), (at(1), "a", 10.0)],
        [(at(5), "a", 1.0)],
        [(at(6), "a", 1.0)],
        # Dropped: the window of minute 0 was closed by the watermark of an earlier batch.
        [(at(0.2), "late", 9999.0), (at(10), "a", 1.0)],
    ]
    stream = stream_of(spark, str(tmp_path), batches, schema)
    out = twins.run_to_files(twins.stream_rps(stream), "append", str(tmp_path / "run"))
    found = {r["period_start"]: (r["rps"], r["below_target"]) for r in out.collect()}
    assert found[at(0)] == (4500.0, False)
    assert found[at(1)] == (10.0, True)
    assert at(10) not in found


@pytest.mark.parametrize("per_batch", [1, 3])
def test_alarm_over_batches(spark, rows, tmp_path, per_batch):
    schema = "ts timestamp, value double"
    data = [(at(m), v) for m, v in enumerate([90.0, 91.0, 50.0, 95.0, 95.0, 95.0, 10.0, 99.0])] + [(at(60), 0.0)]
    batches = [data[i:i + per_batch] for i in range(0, len(data), per_batch)]
    stream = stream_of(spark, str(tmp_path), batches, schema)
    averages = twins.stream_period_avg(stream)
    twins.start_alarm(averages, str(tmp_path / "run"), 88, "60 seconds", 2).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "run/alarms")).select("period_start", "average", "alarm")
    batch = loadtest.alarm_consecutive(spark.createDataFrame(data, schema), "ts", "value", 88)
    assert rows(found) == rows(batch.where(F.col("period_start") < F.lit(at(60))))

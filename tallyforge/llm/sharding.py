"""Sharding in random order: a two-pass external shuffle.

Pass 1 scatters the records over memory-sized buckets by a seeded hash of their place in the
input, so that neither a hot source nor a group of equal rows can fill a bucket.  Pass 2 takes
each bucket into memory, shuffles it (Fisher-Yates) and writes it to ``spark.checkpoint.dir``.
The buckets one after another are a random order of all records; its n-th part is shard n.

Only built-in expressions, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import free_name, without, written

# Bytes that every record takes besides its text.
RECORD_BYTES = 16
# Buckets grow beyond their size rather than exceed this number: one small row for each of them is
# broadcast and summed up in one task.
MAX_BUCKETS = 1_000_000


def with_size(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``: UTF-8 bytes of the text (null: none) plus a record's fixed bytes."""
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long") + RECORD_BYTES
    return without(docs, ["size"]).withColumn("size", size)


def shuffled(docs: DataFrame, seed: int = 0, bucket_bytes: int = 8 << 20, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``size`` and ``position``, their place (from 0) in a random order.

    Rows are scattered by their place in the input, which files fix; put ``checkpoint()`` before
    if ``docs`` comes from something whose row order may change when a lost task is run again.
    An empty table gives an empty table; nulls, repeated rows and other columns are just carried.
    """
    sized = with_size(without(docs, ["position"]), text)
    total = sized.agg(F.sum("size")).first()[0] or 0
    n_buckets = max(1, min(MAX_BUCKETS, -(-total // bucket_bytes)))
    names = {c: free_name(sized, c) for c in ("_place", "_bucket", "_records", "_record", "_start")}
    place, bucket, records, record, start = names.values()
    scattered = (
        sized.withColumn(place, F.monotonically_increasing_id())
        .withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), place), F.lit(n_buckets)))
        .repartition(n_buckets, bucket)
    )
    row = F.struct(place, *(F.col(f"`{c}`") for c in sized.columns))
    # One bucket is bounded by construction; ordered first, so that the seed alone decides.
    mixed = scattered.groupBy(bucket).agg(F.sort_array(F.collect_list(row)).alias(records)).select(
        bucket, F.posexplode(F.shuffle(records, seed)).alias(place, record)
    )
    buckets = written(
        mixed.select(bucket, place, *(F.col(f"{record}.`{c}`").alias(c) for c in sized.columns)), "shards"
    )
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    # At most MAX_BUCKETS rows of two numbers.
    starts = buckets.groupBy(bucket).agg(F.count(F.lit(1)).alias(start)).select(
        bucket, F.coalesce(F.sum(start).over(before), F.lit(0)).alias(start)
    )
    return (
        buckets.join(F.broadcast(starts), bucket)
        .withColumn("position", F.col(start) + F.col(place))
        .select(*(F.col(f"`{c}`") for c in sized.columns), "position")
    )


def sharded(
    docs: DataFrame, n_shards: int, seed: int = 0, bucket_bytes: int = 8 << 20, text: str = "text"
) -> DataFrame:
    """All rows with ``size``, ``shard`` (from 0) and ``slot`` (from 0 in each shard, no gaps).

    Shards are consecutive parts of the random order, of row counts at most one apart; a bucket
    lies in one shard or in neighbouring ones.  Columns of the input with these names are replaced.
    """
    mixed = shuffled(without(docs, ["shard", "slot"]), seed, bucket_bytes, text)
    rows = mixed.count()
    first = F.expr(f"(shard * {rows}L + {n_shards - 1}) div {n_shards}")
    return (
        mixed.withColumn("shard", F.expr(f"cast(position * {n_shards} div {max(rows, 1)} as int)"))
        .withColumn("slot", F.col("position") - first)
        .drop("position")
    )


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder for each shard; no shuffle, as a task holds rows of few shards. ``slot`` is the order."""
    shards.write.partitionBy("shard").parquet(path)

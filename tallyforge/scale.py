"""Building blocks that keep one heavy key from landing in one task.

Most operators need none of this: partial aggregation and the adaptive skew join already
spread a hot key.  What they cannot spread is work that wants a whole group in order (a list
per user, a running value per key, a global rank).  The helpers here find the few keys that
are too heavy, with a bound on how many there can be, and treat those rows by sorted ranges.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A key is heavy when it has more rows than this ...
HEAVY_ROWS = 1_000_000
# ... and more than 1/MAX_HEAVY_KEYS of all rows, so there are fewer than MAX_HEAVY_KEYS of
# them whatever the input size.  That bound is what makes broadcasting them safe.
MAX_HEAVY_KEYS = 1_000_000

# Spark deletes the shuffle files of a query when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# What was written in the innermost ``passing`` block.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)

_SLOT_BITS = 33  # monotonically_increasing_id keeps the in-partition row number in the low 33 bits


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Only a session whose executors are this very process (``local``, ``local[...]``) gets a temporary
    one when none is set.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="tallyforge-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` and continue from the files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}_{uuid.uuid4().hex}"


@contextmanager
def writing(spark: SparkSession, path: str) -> Iterator[None]:
    """For a query that only writes ``path``: its shuffle files go when it ends, not when the driver's garbage does."""
    if (made := _made.get()) is not None:
        made.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Deletes in the end what is written inside, but for what was written last, the result."""
    token = _made.set(made := [])
    try:
        yield
    finally:
        _made.reset(token)
    for path in made[:-1]:
        remove(spark, path)
    if (outer := _made.get()) is not None:
        outer += made[-1:]


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` in compressed columns and continue from the files."""
    with writing(df.sparkSession, path):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, path: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> DataFrame:
    """``stored``, one file for each of ``buckets`` hash ranges of ``keys``.

    A join on the keys with a side repartitioned to as many parts reads the files in place.  With
    ``dealt``, rows come from such a join and lie in the right tasks, so they are not moved.  The
    table stays in the session's catalog, under the folder's name, until ``remove``.
    """
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = df if dealt else df.repartition(buckets, *keys)
    write = rows.write.bucketBy(buckets, *keys).option("compression", "zstd")
    with writing(df.sparkSession, path):
        write.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any storage, and its table; a missing one is no error."""
    spark.sql(f"drop table if exists `{path.rsplit('/', 1)[1].replace('-', '_').replace('=', '_')}`")
    if path in (made := _made.get() or ()):
        made.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    min_rows: int = HEAVY_ROWS,
    max_keys: int = MAX_HEAVY_KEYS,
) -> DataFrame:
    """Keys holding more than ``min_rows`` rows and more than 1/``max_keys`` of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    share = counts.agg(F.sum("key_rows") / F.lit(max_keys)).scalar()
    return counts.where((F.col("key_rows") > min_rows) & (F.col("key_rows") > share)).select(*keys)


def _find_heavy(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame | None:
    """The heavy keys as a broadcast table, or None when there are none."""
    heavy = stable(heavy_keys(df, keys, min_rows))
    # Fewer than MAX_HEAVY_KEYS rows by construction.
    return None if heavy.isEmpty() else F.broadcast(heavy)


def split_heavy(
    df: DataFrame, keys: Sequence[str], min_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Split into (rows of ordinary keys, rows of heavy keys or None when there are none).

    Null keys never match the heavy list and stay with the ordinary ones.
    """
    heavy = _find_heavy(df, keys, min_rows)
    if heavy is None:
        return df, None
    return df.join(heavy, list(keys), "left_anti"), df.join(heavy, list(keys), "left_semi")


def join_unique(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per key, whatever the skew of ``rows``.

    The adaptive skew join splits a hot key only when both sides come straight from an exchange;
    a side that was joined or aggregated by the same key before is beyond it.  Here the heavy
    keys meet their few table rows by broadcast, and the others by an ordinary join.
    """
    keys = list(keys)
    heavy = _find_heavy(rows, keys, min_rows)
    if heavy is None:
        return rows.join(table, keys, how)
    few = F.broadcast(table.join(heavy, keys, "left_semi"))
    light_rows = rows.join(heavy, keys, "left_anti")
    heavy_rows = rows.join(heavy, keys, "left_semi")
    return light_rows.join(table, keys, how).unionByName(heavy_rows.join(few, keys, how))


def sorted_cells(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sort globally and record where each row landed.

    ``cell`` is the sorted range partition and ``slot`` the place inside it; both are fixed by
    the checkpoint, so they can be aggregated and joined back consistently.
    """
    placed = stable(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    return placed.withColumns(
        {
            "cell": F.shiftright("_place", _SLOT_BITS),
            "slot": F.col("_place").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1)),
        }
    ).drop("_place")


def with_position(
    df: DataFrame, order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Add the 1-based place of each row in the global order, without a single-task sort."""
    cells = sorted_cells(df, order)
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
    # One row per range partition: small enough for an unpartitioned window and a broadcast.
    earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cell", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    return (
        cells.join(F.broadcast(starts), "cell")
        .withColumn(name, F.col("start") + F.col("slot") + 1)
        .drop("cell", "slot", "start")
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    min_rows: int = HEAVY_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``(keys, items, position)``: each row's place, from 0, among its key's rows in item order.

    Heavy keys are numbered over sorted ranges and the others within one task; the result does not
    depend on which was chosen.  ``counted`` is a cheaper table to look for heavy keys in: one in
    which every key has at least as many rows as in ``df``.
    """
    keys, items = list(keys), list(items)
    needed = df.select(*keys, *items)
    heavy = _find_heavy(needed if counted is None else counted.select(*keys), keys, min_rows)
    order = Window.partitionBy(*keys).orderBy(*items)
    place = (F.row_number().over(order) - 1).cast("bigint")
    if heavy is None:
        return needed.withColumn("position", place)
    light = needed.join(heavy, keys, "left_anti").withColumn("position", place)
    ordered = with_position(needed.join(heavy, keys, "left_semi"), keys + items)
    starts = ordered.groupBy(*keys).agg(F.min("position").alias("first"))  # one row per heavy key
    placed = ordered.join(F.broadcast(starts), keys).withColumn("position", F.col("position") - F.col("first"))
    return light.unionByName(placed.drop("first"))


def pack_sorted(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    block_items: int,
    min_rows: int = HEAVY_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Sorted arrays of ``items`` structs, as ``(keys, part, items)``.

    Part p of a key holds its items p * ``block_items`` up to (p + 1) * ``block_items`` - 1 in their
    order, whatever the number of rows; so a list never has more than ``block_items`` entries.
    """
    placed = numbered(df, keys, items, min_rows, counted)
    part = F.floor(F.col("position") / block_items).alias("part")
    packed = F.sort_array(F.collect_list(F.struct(*items))).alias("items")
    return placed.groupBy(*keys, part).agg(packed)


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Last non-null ``value`` of the key at or before each row, as column ``name``."""
    keys, order = list(keys), list(order)
    light, heavy = split_heavy(df, keys, min_rows)
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = light.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    if heavy is None:
        return out
    cells = sorted_cells(heavy, keys + order)
    in_cell = (
        Window.partitionBy(*keys, "cell").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    )
    local = cells.withColumn("_local", F.last(value, ignorenulls=True).over(in_cell))
    known = F.when(F.col(value).isNotNull(), F.col("slot"))
    ends = cells.groupBy(*keys, "cell").agg(F.max_by(value, known).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys, "cell", F.last("_end", ignorenulls=True).over(earlier).alias("_before")
    )
    filled = (
        local.join(carried, keys + ["cell"])
        .withColumn(name, F.coalesce("_local", "_before"))
        .drop("cell", "slot", "_local", "_before")
    )
    return out.unionByName(filled)


def lookup_by_weight(
    rows: DataFrame, table: DataFrame, key: str, weight: str, max_keys: int = MAX_HEAVY_KEYS
) -> DataFrame:
    """Inner-join ``rows`` to ``table`` (one row per key) where ``weight`` counts rows per key.

    The keys above 1/``max_keys`` of the total weight are broadcast: there are fewer than
    ``max_keys`` of them and they cover most rows, which then need no shuffle.  The remaining
    keys, none of them heavy, meet through an ordinary join.

    The misses are found by an outer join because, unlike an anti join, it stays above the
    aggregate that built ``rows``; both branches then read the same exchange.
    """
    values = [c for c in table.columns if c != key]
    share = table.agg(F.sum(weight) / F.lit(max_keys)).scalar()
    frequent = F.broadcast(table.where(F.col(weight) > share))
    rare = table.where(F.col(weight) <= share)
    marked = rows.join(frequent, key, "left")
    hits = marked.where(F.col(weight).isNotNull())
    misses = marked.where(F.col(weight).isNull()).drop(*values)
    return hits.unionByName(misses.join(rare, key))

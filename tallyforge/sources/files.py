"""File readers.  Each is a lazy scan; the ``parse_*`` half works on any DataFrame of lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tallyforge.functions.predicates import whole_number
from tallyforge.functions.text import WHITESPACE


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``(value)``."""
    return spark.read.text(path)


def with_file_date(lines: DataFrame) -> DataFrame:
    """Add ``day`` from a file name holding ``-yyyymmdd-hhmmss``; null for other names."""
    stamp = F.regexp_extract(F.col("_metadata.file_name"), r"-(\d{8})-\d{6}(?!\d)", 1)
    return lines.withColumn("day", F.try_to_timestamp(stamp, F.lit("yyyyMMdd")).cast("date"))


def parse_pagecounts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whitespace-separated lines of exactly four fields; other widths are dropped."""
    others = [c for c in lines.columns if c != column]
    fields = F.split(F.btrim(F.col(column), F.lit(WHITESPACE)), r"\s+")
    return (
        lines.withColumn("f", fields)
        .where(F.size("f") == 4)
        .select(
            F.col("f")[0].alias("project"),
            F.col("f")[1].alias("title"),
            whole_number(F.col("f")[2]).alias("views"),
            whole_number(F.col("f")[3]).alias("nbytes"),
            *others,
        )
    )


def read_pagecounts(spark: SparkSession, path: str, file_date: bool = False) -> DataFrame:
    """Hourly page counts ``(project, title, views, nbytes[, day])``."""
    lines = read_lines(spark, path)
    return parse_pagecounts(with_file_date(lines) if file_date else lines)


def read_csv_plain(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Comma-split files without quoting or header."""
    return spark.read.schema(schema).option("quote", "").csv(path)


def parse_tsv(
    lines: DataFrame,
    fields: Mapping[str, int],
    column: str = "value",
    trim: bool = False,
    keep_short: bool = False,
) -> DataFrame:
    """Pick tab-separated fields by 0-based position.

    Lines too short to have every wanted field are dropped; ``keep_short=True`` keeps them with
    nulls, and ``short_lines`` returns just those.
    """
    text = F.btrim(F.col(column), F.lit(WHITESPACE)) if trim else F.col(column)
    parts = lines.select(F.split(text, "\t").alias("f"))
    picked = parts.select(*[F.get("f", F.lit(i)).alias(name) for name, i in fields.items()])
    return picked if keep_short else picked.dropna(subset=list(fields))


def short_lines(lines: DataFrame, fields: Mapping[str, int], column: str = "value") -> DataFrame:
    """The lines ``parse_tsv`` rejects."""
    return lines.where(F.size(F.split(column, "\t")) <= max(fields.values()))


def read_tsv(
    spark: SparkSession, path: str, fields: Mapping[str, int], trim: bool = False
) -> DataFrame:
    return parse_tsv(read_lines(spark, path), fields, trim=trim)


def parse_title_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """One title per line, outer whitespace and blank lines removed."""
    title = F.btrim(F.col(column), F.lit(WHITESPACE))
    return lines.withColumn("title", title).drop(column).where(F.col("title") != "")


def read_title_list(spark: SparkSession, path: str) -> DataFrame:
    """``(position, title)``; position grows with the line number but has gaps.

    Lines of several files follow each other in order of the files' paths.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    # One row per input split: small enough for an unpartitioned window and a broadcast.
    splits = lines.select("file", "block").distinct().withColumn("split", F.row_number().over(Window.orderBy("file", "block")))
    at = F.shiftleft(F.col("split").cast("bigint"), 33) + F.col("place").bitwiseAND((1 << 33) - 1)
    placed = lines.join(F.broadcast(splits), ["file", "block"]).withColumn("position", at)
    return parse_title_list(placed.select("value", "position"))


def read_ini_log(spark: SparkSession, path: str) -> DataFrame:
    """Load-test logs ``[Minute N]`` / ``host=rps`` to ``(test, minute, host, rps)``, test being the file.

    A header applies to the lines below it.  It is carried down inside each input split first,
    then from split to split (one row each), so a large file is not gathered into one task.
    """
    lines = spark.read.text(path).select(
        F.btrim("value", F.lit(WHITESPACE)).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    header = F.when(F.col("line").startswith("["), F.col("line"))
    in_block = (
        Window.partitionBy("file", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    local = lines.withColumn("local", F.last(header, ignorenulls=True).over(in_block))
    ends = lines.groupBy("file", "block").agg(
        F.max_by(header, F.when(header.isNotNull(), F.col("place"))).alias("last_header")
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "file", "block", F.last("last_header", ignorenulls=True).over(earlier).alias("carried")
    )
    section = F.coalesce("local", "carried")
    return (
        local.join(carried, ["file", "block"])
        .where(section.startswith("[Minute") & F.col("line").contains("=") & ~F.col("line").startswith(";"))
        .select(
            F.col("file").alias("test"),
            F.regexp_extract(section, r"(\d+)", 1).try_cast("int").alias("minute"),
            F.trim(F.substring_index("line", "=", 1)).alias("host"),
            F.trim(F.substring_index("line", "=", -1)).try_cast("double").alias("rps"),
        )
    )

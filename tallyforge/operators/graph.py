"""Link graphs as edge tables ``(src, dst)``; adjacency stays flat, one row per link."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.scale import MAX_HEAVY_KEYS, new_path, pack_sorted, remove, stored, stored_by

LINKS_PER_SHARD = 1_000_000
# Links in one stored file, and the most files Spark makes for a table by hash.  The task that lays a
# file out holds its links twice, at some 300 bytes each.
LINKS_PER_PART = 1_000_000
MAX_PARTS = 100_000


def distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").distinct()


def all_pages(edges: DataFrame) -> DataFrame:
    """Every page that occurs at either end of a link."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("page"))
    return ends.distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    return distinct_edges(edges).groupBy(F.col("src").alias("page")).agg(F.count(F.lit(1)).alias("links"))


def _ends(edges: DataFrame) -> DataFrame:
    """Per page whether it has out-links and in-links, in one pass over the edges."""
    marks = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("page"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                F.struct(F.col("dst").alias("page"), F.lit(0).alias("out"), F.lit(1).alias("into")),
            )
        )
    )
    return marks.groupBy("page").agg(F.max("out").alias("out"), F.max("into").alias("into"))


def dangling_pages(edges: DataFrame) -> DataFrame:
    """Pages without out-links."""
    return _ends(edges).where(F.col("out") == 0).select("page")


def sourceless_pages(edges: DataFrame) -> DataFrame:
    """Pages without in-links."""
    return _ends(edges).where(F.col("into") == 0).select("page")


def collect_neighbours(edges: DataFrame, block_items: int) -> DataFrame:
    """``(src, part, neighbours)``: sorted targets, ``block_items`` to a part."""
    packed = pack_sorted(distinct_edges(edges), ["src"], ["dst"], block_items, counted=edges)
    return packed.select("src", "part", F.col("items.dst").alias("neighbours"))


def split_dangling(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """Ranks with the out-degree of their page; 0 links marks a dangling page."""
    joined = ranks.join(out_degree(edges), "page", "left")
    return joined.withColumn("links", F.coalesce("links", F.lit(0)))


def dangling_mass(ranks: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of the scores of pages without out-links, 0 when there are none."""
    sources = edges.select(F.col("src").alias("page")).distinct()
    loose = ranks.join(sources, "page", "left_anti")
    return loose.agg(F.coalesce(F.sum("score"), F.lit(0.0)).alias("mass"))


def with_titles(ranks: DataFrame, titles: DataFrame) -> DataFrame:
    """Ranks under the title of their page; pages without a title are dropped."""
    return titles.join(ranks, "page").select("title", "score")


def pagerank(
    edges: DataFrame,
    rounds: int = 10,
    d: float = 0.85,
    keep_sourceless: bool = False,
    links_per_shard: int = LINKS_PER_SHARD,
) -> DataFrame:
    """``(page, score)`` after ``rounds`` of (1 - d) + d * (incoming + dangling / N), start 1.0.

    By default only pages that received a contribution live on to the next round, so pages
    without in-links disappear; ``keep_sourceless=True`` keeps them and the scores sum to N.

    The links are stored once, by source, and read in place every round: a round moves only
    one row per page and the partly summed contributions.  The links of a big source are dealt
    over shards of about ``links_per_shard``; its score is repeated once per shard.  Links and all
    rounds but the last are deleted again.
    """
    spark = edges.sparkSession
    n_rows = edges.count()  # repeated links included: an upper bound that needs no shuffle
    parts = min(MAX_PARTS, max(spark.sparkContext.defaultParallelism, -(-n_rows // LINKS_PER_PART)))
    # Keeps the sources with several shards below MAX_HEAVY_KEYS, so their list can be broadcast.
    links_per_shard = max(links_per_shard, math.ceil(n_rows / MAX_HEAVY_KEYS))
    big = edges.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / links_per_shard).cast("int").alias("shards"))
    big = F.broadcast(big.where("shards > 1"))

    dealt = F.pmod(F.xxhash64("dst"), F.coalesce("shards", F.lit(1))).cast("int")
    sharded = edges.join(big, "src", "left").select("src", "dst", dealt.alias("shard"))
    links_path, pages_path = new_path(spark, "links"), new_path(spark, "pages")
    # The exchange that lays the links out also brings the repeated ones together.
    distinct = sharded.repartition(parts, "src", "shard").distinct()
    laid_out = stored_by(distinct, links_path, ["src", "shard"], parts)

    ends = laid_out.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("page"), F.lit(1).alias("link")),
                F.struct(F.col("dst").alias("page"), F.lit(0).alias("link")),
            )
        )
    )
    degrees = ends.groupBy("page").agg(F.sum("link").alias("links"))
    counted = degrees.join(big.withColumnRenamed("src", "page"), "page", "left")
    pages = stored_by(
        counted.select("page", "links", F.coalesce("shards", F.lit(1)).alias("shards")), pages_path, ["page"], parts
    )
    n_pages = pages.count()

    ranks, paths = pages.withColumn("score", F.lit(1.0)), []
    for _ in range(rounds):
        loose = ranks.where(F.col("links") == 0)
        mass = loose.agg(F.coalesce(F.sum("score"), F.lit(0.0))).scalar()
        shares = ranks.where(F.col("links") > 0).select(
            F.col("page").alias("src"),
            F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
            (F.col("score") / F.col("links")).alias("share"),
        )
        # Hashing the shares, one row per source and shard, spares sorting the links every round.
        sent = shares.repartition(parts, "src", "shard").hint("shuffle_hash")
        incoming = (
            laid_out.join(sent, ["src", "shard"])
            .groupBy(F.col("dst").alias("page"))
            .agg(F.sum("share").alias("incoming"))
        )
        received = pages.join(incoming, "page", "left" if keep_sourceless else "inner")
        score = (1 - d) + d * (F.coalesce("incoming", F.lit(0.0)) + mass / n_pages)
        paths.append(new_path(spark, "ranks"))
        ranks = stored(received.select("page", "links", "shards", score.alias("score")), paths[-1])
        if len(paths) > 1:
            remove(spark, paths[-2])
    if paths:
        for path in (links_path, pages_path):
            remove(spark, path)
    return ranks.select("page", "score")

"""Importance resampling towards a target distribution, by hashed n-gram features.

Every run of ``least`` to ``most`` words is a feature, and its CRC-32 modulo ``buckets`` its bucket.
Bucket counts over all documents and over all texts of the target give each bucket a gain, the
logarithm of how much likelier it is in the target.  A document weighs the mean gain of its
features; with Gumbel noise from a hash of its id added, the highest scores are a draw without
replacement, likelier the better a document fits the target.

1. One pass counts buckets: every task adds up its own, so ``buckets`` rows a task are moved.
2. A second pass gives weights; only texts go to Python, and the table without them is written.
3. Scores are counted by value, which tells the score from which on documents are drawn.  Only
   those are sorted, over ranges, and numbered.

Defined cases: texts that are null or have no word have no feature and weight 0.  Rows without an
id count in the statistics, but have no score and are not drawn.  Repeated ids have the same noise;
equal scores go by id, then by place in the written table.  With no target text, or no document,
gains are as the formula has them with zero counts.  Columns named as results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import free_name, without, written
from tallyforge.llm.crcspans import crc32_spans
from tallyforge.llm.wordhash import grouped
from tallyforge.scale import with_position

RESULTS = ["n_words", "n_features", "weight", "score", "rank"]


@dataclass(frozen=True)
class Features:
    """Runs of ``least`` to ``most`` words, hashed into ``buckets``."""

    least: int = 1
    most: int = 1
    buckets: int = 10_000


# Capital letters become small; what separates words, ASCII but letters and digits, becomes 0.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0


def features_of(texts: list[bytes], kind: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature by document, features a document, words a document)."""
    data = _FOLD[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = data > 0
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    borders = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    words = np.diff(borders)
    if kind.most > 1:  # words of a feature are joined by one space
        kept = data[inside[1:-1]]
        sizes = ends - starts
        data = np.full(len(kept) + len(sizes), 32, dtype=np.uint8)
        data[np.arange(len(kept)) + np.repeat(np.arange(len(sizes)), sizes)] = kept
        starts = np.cumsum(sizes) - sizes + np.arange(len(sizes))
        ends = starts + sizes
    left = np.repeat(borders[1:], words) - np.arange(len(starts))  # words from here to the document's end
    at = [np.flatnonzero(left >= n) for n in range(kind.least, kind.most + 1)]
    hashes = [crc32_spans(data, starts[a], ends[a + n - 1]) for n, a in enumerate(at, kind.least)]
    document = np.repeat(np.arange(len(texts)), words)
    if len(at) == 1:
        buckets, owner = hashes[0], document[at[0]]
    else:
        owner = np.concatenate([document[a] for a in at])
        order = np.argsort(owner, kind="stable")
        buckets, owner = np.concatenate(hashes)[order], owner[order]
    return buckets % np.uint32(kind.buckets), np.bincount(owner, minlength=len(texts)), words


def bucket_counts(texts: DataFrame, text: str, kind: Features) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kind.buckets, dtype=np.int64)
        for batch in batches:
            for group in grouped(batch.column(0).to_pylist()):
                total += np.bincount(features_of(group, kind)[0], minlength=kind.buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), pa.array(total[filled])], ["bucket", "n"])

    counted = texts.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(kind.buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(how much likelier a bucket is in the target)), with one added to every count."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def importance_weights(
    docs: DataFrame, target: DataFrame, kind: Features = Features(), text: str = "text", target_text: str = "text"
) -> DataFrame:
    """``docs`` with n_words, n_features and weight."""
    gain = gains(bucket_counts(docs, text, kind), bucket_counts(target, target_text, kind))

    @F.pandas_udf("n_words bigint, n_features bigint, weight bigint")
    def measured(texts: pd.Series) -> pd.DataFrame:
        parts = []
        for group in grouped(texts):
            buckets, n, words = features_of(group, kind)
            ends = np.cumsum(n)
            sums = np.append(0, np.cumsum(gain[buckets]))
            parts.append((words, n, (sums[ends] - sums[ends - n]) // np.maximum(n, 1)))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, dtype=np.int64)] * 3
        return pd.DataFrame(dict(zip(("n_words", "n_features", "weight"), columns)))

    base = without(docs, RESULTS)
    box = free_name(base, "_measured")
    boxed = base.withColumn(box, measured(F.col(f"`{text}`")))
    return boxed.select(*(F.col(f"`{c}`") for c in base.columns), f"{box}.*")


def draw(weighted: DataFrame, percent: int, seed: int, least_words: int = 20, doc_id: str = "doc_id") -> DataFrame:
    """``weighted`` with score, and rank for the drawn share of the documents of ``least_words`` or more."""
    ident = F.col(f"`{doc_id}`")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    table = written(weighted.withColumn("score", F.col("weight") + noise), "weighted")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    # Scores are whole numbers within some 100,000 of zero, so this is a short table.
    by_score = table.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    running = F.sum("n").over(Window.orderBy(F.desc("score")))
    wanted = F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100)
    counted = by_score.select("score", wanted.alias("wanted"), (running - F.col("n")).alias("above"))
    last = counted.where("above < wanted").agg(F.min("score").alias("score"), F.max("wanted").alias("wanted")).first()
    no_rank = F.lit(None).cast("bigint")
    if last.score is None:
        return table.withColumn("rank", no_rank)
    row = free_name(table, "_row")
    near = able & (F.col("score") >= last.score)
    ordered = with_position(
        table.where(near).withColumn(row, F.monotonically_increasing_id()), [F.desc("score"), F.asc(doc_id), F.asc(row)], "rank"
    ).drop(row)
    ranked = ordered.withColumn("rank", F.when(F.col("rank") <= last.wanted, F.col("rank")))
    rest = table.where(~F.coalesce(near, F.lit(False))).withColumn("rank", no_rank)
    return ranked.unionByName(rest)

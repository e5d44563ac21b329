"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.scale import checkpoint_dir, stored


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and continue from the files.

    Cuts the lineage, and fixes whatever is not a function of the rows alone (sampled orders,
    positions inside a partition): every later read sees the same values, also after executors
    were lost.
    """
    return stored(df, scratch_path(df.sparkSession, tag))


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` without the columns of these names: an operator's own columns replace the input's."""
    gone = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in gone]
    return df if len(kept) == len(df.columns) else df.select(*(F.col(f"`{c}`") for c in kept))


def per_text(
    df: DataFrame, text: str, schema: str, measure: Callable[[str | None], tuple]
) -> DataFrame:
    """Add the columns of ``schema``, computed by ``measure`` from each text.

    Only the text goes to Python, in Arrow batches; the other columns stay in the JVM.
    """
    names = [part.split()[0] for part in schema.split(",")]

    @F.pandas_udf(schema)
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=names)

    base = without(df, names)
    box = free_name(base, "_measured")
    boxed = base.withColumn(box, measured(F.col(f"`{text}`")))
    return boxed.select(*(F.col(f"`{c}`") for c in base.columns), *(F.col(f"{box}.{n}") for n in names))


def words_of(text: str | None) -> list[bytes]:
    """The runs of anything but ASCII white space, as UTF-8.

    ``bytes.split`` cuts at exactly the six ASCII white-space characters.
    """
    return [] if text is None else text.encode().split()


def sized(parts: Column, per: int, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.ceil(parts / F.lit(per)))

"""Quality classifier by co-training: one view is the text's content, the other the page's metadata.

A logistic regression on hashed character n-grams sees the content; another sees source, language
and layout (sizes, line shapes, shares of marks and repeated words) in quantile bins.  In each
round both score every document, and each hands unlabelled ones it is surest of, by quantiles of
the score in each source, to the other as pseudo-labels.  Both are then calibrated on labelled
documents that were not fitted on, and their log-odds are averaged to score every document.

What the views see of each document is written once, and read in each round.  Bin edges are
quantiles over all documents.  Only the fit runs on the driver, on ``Settings.labelled`` labelled
documents and ``Settings.pseudo`` more for each view and round, in the order of a hash of the id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm import langid, ngrams
from tallyforge.llm.common import free_name, without, words_of, written
from tallyforge.llm.wordhash import from_planes, planes
from tallyforge.scale import join_unique

KINDS = 64  # buckets of each categorical column
MARKS = "#*$%&|<>"


@dataclass(frozen=True)
class Settings:
    labelled: int = 2400  # most labelled documents used, a quarter of them for calibration
    rounds: int = 4
    share: float = 0.05  # of each source, at either end, from which pseudo-labels are picked in a round
    pseudo: int = 240  # most pseudo-labels that a view hands over in a round
    sure: float = 0.9  # least probability of a pseudo-label
    bits: int = 13
    longest: int = 3
    bins: int = 8
    threshold: float = 0.5  # documents below it are rejected
    ftrl: langid.Settings = langid.Settings(epochs=3, l1=0.005)


def layout(text: str) -> tuple[float, ...]:
    """Measures of a page's shape that do not depend on which words it has."""
    words = words_of(text)
    lines = [line for line in text.split("\n") if line]
    n, m = max(1, len(words)), max(1, len(lines))
    again = sum(map(bytes.__eq__, words, words[1:]))
    capitals = sum(map(str.isupper, text.split()))
    return (
        np.log2(1 + len(text)),
        np.log2(1 + len(words)),
        np.log2(m),
        len(text) / m,
        sum(map(len, words)) / n,
        len(set(words)) / n,
        len(set(lines)) / m,
        again / n,
        capitals / n,
        sum(map(text.count, MARKS)) / n,
        text.count("!") / n,
        (text.count(".") + text.count(",")) / n,
        sum(map(text.count, "0123456789")) / n,
    )


N_LAYOUT = 13


@dataclass
class Model:
    settings: Settings
    edges: np.ndarray  # layout measure x bin edge
    content: np.ndarray  # weight of each bucket for "good", bias last
    metadata: np.ndarray
    scales: tuple[float, float]  # calibration of the two log-odds

    def scores(self, texts: Sequence[str | None], kinds: list[Sequence]) -> np.ndarray:
        """Columns: calibrated probability by content, by metadata, and by both."""
        out = []
        done = 0
        for group in ngrams.slices(texts):
            part = [k[done : done + len(group)] for k in kinds]
            done += len(group)
            row, bucket, value = content_view(group, self.settings)
            by_content = np.bincount(row, value * self.content[bucket], minlength=len(group)) + self.content[-1]
            shape = np.array([layout(t) for t in group])
            at = metadata_view(shape, part, self.edges, self.settings)
            by_metadata = self.metadata[at].sum(axis=1) + self.metadata[-1]
            odds = np.stack([by_content * self.scales[0], by_metadata * self.scales[1]], axis=1)
            out.append(np.column_stack([odds, odds.mean(axis=1)]))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(out), -40, 40))) if out else np.empty((0, 3))


def content_view(texts: list[str], s: Settings):
    """(row, bucket, value): 1 + ln count, rows scaled to length 1."""
    row, bucket, count = ngrams.counts(texts, s.bits, s.longest)
    value = 1 + np.log(count)
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    return row, bucket, value / np.maximum(norm, 1e-12)[row]


def metadata_view(shape: np.ndarray, kinds: list[Sequence], edges: np.ndarray, s: Settings) -> np.ndarray:
    """For each document the index of its bin in every measure and of its bucket in every column."""
    at = [np.searchsorted(edges[j], shape[:, j], side="right") + j * (s.bins + 1) for j in range(N_LAYOUT)]
    base = N_LAYOUT * (s.bins + 1)
    for k, values in enumerate(kinds):
        at.append(np.array([zlib.crc32(str(v).encode()) % KINDS for v in values], dtype=np.int64) + base + k * KINDS)
    return np.stack(at, axis=1)


def binary_fit(examples, labels: np.ndarray, width: int, s: Settings) -> np.ndarray:
    """Weight of each index, and the bias, for the log-odds of label 1."""
    w = langid.fit_ftrl(examples, labels, width, 2, s.ftrl)
    return w[:, 1] - w[:, 0]


def odds_of(examples, w: np.ndarray) -> np.ndarray:
    return np.array([v @ w[i] for i, v in examples]) + w[-1]


def calibration(odds: np.ndarray, labels: np.ndarray) -> float:
    both = np.stack([-odds / 2, odds / 2], axis=1)
    return 1 / langid.fit_temperature(both, labels)


class View:
    """Examples of one view, and the labels it was given: by the table of labels, then by the other view."""

    def __init__(self, examples: dict[int, tuple], labels: dict[int, int], width: int) -> None:
        self.examples, self.labels, self.width = examples, labels, width

    def fit(self, s: Settings) -> np.ndarray:
        rows = sorted(self.labels, key=lambda r: zlib.crc32(str(r).encode()))  # mixes the classes, and fixes the order
        return binary_fit([self.examples[r] for r in rows], np.array([self.labels[r] for r in rows], dtype=np.int64), self.width, s)

    def take(self, examples: dict[int, tuple], labels: dict[int, int]) -> None:
        """Pseudo-labels; what has a label keeps it."""
        for row, label in labels.items():
            if row not in self.labels:
                self.labels[row], self.examples[row] = label, examples[row]


def documents_seen(docs: DataFrame, kinds: Sequence[str], doc_id: str, text: str, s: Settings) -> DataFrame:
    """(row, id, kind0.., shape, buckets, counts): what both views see of each document, written once."""
    names = [f"kind{i}" for i in range(len(kinds))]
    source = docs.where(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("string").alias("id"),
        *(F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("None")).alias(n) for k, n in zip(kinds, names)),
    )

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seen = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            for a in range(0, batch.num_rows, ngrams.SLICE_TEXTS):
                part = batch.slice(a, ngrams.SLICE_TEXTS)
                shapes, buckets, counts = [], [], []
                for group in ngrams.slices(part.column(0).to_pylist()):
                    row, bucket, count = ngrams.counts(group, s.bits, s.longest)
                    cuts = np.searchsorted(row, np.arange(1, len(group)))
                    buckets += [planes(b.astype("<u2")) for b in np.split(bucket, cuts)]
                    counts += [planes(c.astype("<u4")) for c in np.split(count, cuts)]
                    shapes += [layout(t) for t in group]
                rows = pa.array(np.arange(base + seen, base + seen + part.num_rows))
                seen += part.num_rows
                own = [pa.array(shapes, pa.list_(pa.float64())), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())]
                yield pa.RecordBatch.from_arrays([rows, *part.columns[1:], *own], ["row", "id", *names, "shape", "buckets", "counts"])

    fields = "".join(f"{n} string, " for n in names)
    return written(source.mapInArrow(see, f"row long, id string, {fields}shape array<double>, buckets binary, counts binary"), "seen")


def content_of(buckets: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The content view of one document, as ``content_view`` gives it."""
    value = 1 + np.log(from_planes(counts, "<u4"))
    return from_planes(buckets, "<u2"), value / max(float(np.sqrt((value * value).sum())), 1e-12)


def scored_by_views(seen: DataFrame, names: list[str], model: Model) -> DataFrame:
    """(row, id, source, chance0, chance1) of every document: probability of label 1 by content, by metadata."""
    s = model.settings

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = [content_of(b.as_py(), c.as_py()) for b, c in zip(batch.column("buckets"), batch.column("counts"))]
            by_content = odds_of(content, model.content)
            shape = np.asarray(batch.column("shape").flatten()).reshape(-1, N_LAYOUT)
            at = metadata_view(shape, [batch.column(n).to_pylist() for n in names], model.edges, s)
            by_metadata = model.metadata[at].sum(axis=1) + model.metadata[-1]
            chances = [pa.array(1 / (1 + np.exp(-np.clip(odds, -40, 40)))) for odds in (by_content, by_metadata)]
            source = batch.column(names[0]) if names else pa.array([""] * batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), source, *chances], ["row", "id", "source", "chance0", "chance1"])

    schema = "row long, id string, source string, chance0 double, chance1 double"
    return written(seen.mapInArrow(score, schema), "chances")


def surest(scored: DataFrame, given: DataFrame, s: Settings) -> DataFrame:
    """(view, label, row): for each view the unlabelled documents it is surest of, one row for each id.

    Of every source the ``share`` with the least and that with the greatest probability can be picked,
    if sure enough.  At most ``pseudo`` go on for a view, both labels in the proportion in which it
    finds them in all documents, dealt out over the sources in turn.
    """
    edge = lambda v: F.percentile_approx(f"chance{v}", [s.share, 1 - s.share], 10_000).alias(f"edge{v}")
    edges = scored.groupBy("source").agg(edge(0), edge(1))
    found = scored.agg(*(F.avg((F.col(f"chance{v}") < 0.5).cast("int")).alias(f"bad{v}") for v in (0, 1))).first()
    marked = join_unique(scored.where("id is not null"), edges, ["source"])
    picks = []
    for v in (0, 1):
        chance, edge_of = F.col(f"chance{v}"), F.col(f"edge{v}")
        bad = chance <= F.least(edge_of[0], F.lit(1 - s.sure))
        good = chance >= F.greatest(edge_of[1], F.lit(s.sure))
        quota = max(1, round(s.pseudo * found[v])) if found[v] is not None else 1
        limit = F.when(bad, quota).otherwise(max(1, s.pseudo - quota))
        picks.append(marked.where(bad | good).select(F.lit(v).alias("view"), F.when(bad, 0).otherwise(1).alias("label"), "source", "id", "row", limit.alias("quota")))
    every = picks[0].unionByName(picks[1])
    once = every.groupBy("view", "label", "id").agg(F.min(F.struct("row", "source", "quota")).alias("pick")).select("view", "label", "id", "pick.*")
    fresh = once.join(given.select("id"), "id", "left_anti").withColumn("turn", F.xxhash64(F.lit(5), "id"))
    in_source = Window.partitionBy("view", "label", "source").orderBy("turn", "row")
    dealt = fresh.withColumn("nth", F.row_number().over(in_source)).where(F.col("nth") <= s.pseudo)
    of_all = Window.partitionBy("view", "label").orderBy("nth", "turn", "row")
    taken = dealt.withColumn("place", F.row_number().over(of_all)).where(f"place <= {s.pseudo}").where("place <= quota")
    return taken.select("view", "label", "row")


def train(
    docs: DataFrame, labels: DataFrame, kinds: Sequence[str], doc_id: str, text: str, label: str, s: Settings
) -> Model | None:
    """None when no document with a text has a label."""
    given = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{doc_id}`").isNotNull())
    given = given.groupBy(F.col(f"`{doc_id}`").cast("string").alias("id")).agg(F.min(F.col(f"`{label}`")).cast("int").alias("label"))
    seen = documents_seen(docs, kinds, doc_id, text, s)
    names = [f"kind{i}" for i in range(len(kinds))]
    first = seen.where("id is not null").groupBy("id").agg(F.min("row").alias("row"))  # one row for each id
    sample = first.join(given, "id").orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(s.labelled).select("row", "label")
    cuts = [float(q) for q in np.linspace(0, 1, s.bins + 1)[1:-1]]
    edges = seen.agg(*(F.percentile_approx(F.col("shape")[j], cuts, 10_000).alias(f"m{j}") for j in range(N_LAYOUT))).first()
    if edges is None or edges[0] is None:
        return None
    edges = np.array([list(e) for e in edges], dtype=float)

    def fetched(rows: DataFrame) -> tuple[dict, dict, dict]:
        """Examples of both views, and labels, of a bounded number of rows."""
        found = seen.join(F.broadcast(rows), "row").toPandas()
        shape = np.array(found["shape"].tolist(), dtype=float).reshape(-1, N_LAYOUT)
        at = metadata_view(shape, [found[n].tolist() for n in names], edges, s)
        number = found["row"].tolist()
        content = dict(zip(number, map(content_of, found["buckets"], found["counts"])))
        metadata = dict(zip(number, ((row, np.ones(len(row))) for row in at)))
        return content, metadata, dict(zip(number, found["label"].tolist()))

    content, metadata, truth = fetched(sample)
    if not truth:
        return None
    known = sorted(truth, key=lambda r: (zlib.crc32(str(r).encode()), r))
    checked = known[3::4] if len(known) >= 16 else []
    fitted = {r: truth[r] for r in known if r not in set(checked)}
    widths = (1 << s.bits, N_LAYOUT * (s.bins + 1) + KINDS * len(kinds))
    views = [View(dict(examples), dict(fitted), width) for examples, width in zip((content, metadata), widths)]
    weights = [view.fit(s) for view in views]
    for _ in range(s.rounds):
        chances = scored_by_views(seen, names, Model(s, edges, *weights, (1.0, 1.0)))
        picks = surest(chances, given, s).collect()  # at most 2 * pseudo + 2 rows
        if not picks:
            break
        rows = docs.sparkSession.createDataFrame([(r,) for r in sorted({p.row for p in picks})], "row long")
        more = fetched(rows.withColumn("label", F.lit(-1)))
        for v, view in enumerate(views):  # what the other view is sure of
            view.take(more[v], {p.row: p.label for p in picks if p.view == 1 - v})
        weights = [view.fit(s) for view in views]
    scales = (1.0, 1.0)
    if checked:
        y = np.array([truth[r] for r in checked])
        scales = tuple(calibration(odds_of([examples[r] for r in checked], w), y) for examples, w in zip((content, metadata), weights))
    return Model(s, edges, weights[0], weights[1], scales)


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    kinds: Sequence[str] = ("source", "lang"),
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: Settings = Settings(),
) -> DataFrame:
    """All rows with ``content_score``, ``metadata_score``, ``score`` and ``accepted``.

    Scores are probabilities of label 1.  A document without a word (null, empty, white space)
    scores 0 and is rejected; with no labels at all, scores are null and the rest is accepted.
    Repeated rows get equal results; of rows with one id one is fitted, and a label is the least of
    those its id has.  Rows without an id, and ids without a label, are scored alike.  Columns of the
    input with these names are replaced.
    """
    names = ["content_score", "metadata_score", "score", "accepted"]
    base = without(docs, names)
    empty = ~F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kinds = [k for k in kinds if k in base.columns]
    model = train(base, labels, kinds, doc_id, text, label, settings)
    if model is None:
        nothing = {n: F.when(empty, 0.0) for n in names[:3]}
        return base.withColumns({**nothing, "accepted": ~empty})

    @F.pandas_udf("content_score double, metadata_score double, score double, worded boolean")
    def scored(texts: pd.Series, *columns: pd.Series) -> pd.DataFrame:
        values = model.scores(texts.tolist(), [c.tolist() for c in columns])
        worded = np.array([bool(words_of(t)) for t in texts], dtype=bool)
        values[~worded] = 0.0
        return pd.DataFrame({**{n: values[:, i] for i, n in enumerate(names[:3])}, "worded": worded})

    box = free_name(base, "_scores")
    out = base.withColumn(box, scored(F.col(f"`{text}`"), *(F.col(f"`{k}`").cast("string") for k in kinds)))
    return out.select(
        *(F.col(f"`{c}`") for c in base.columns),
        *(F.col(f"{box}.{n}") for n in names[:3]),
        (F.col(f"{box}.worded") & (F.col(f"{box}.score") >= settings.threshold)).alias("accepted"),
    )

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

1. Document frequencies of hashed n-grams over all training documents: every task sums its own,
   one row per bucket leaves it.
2. A bounded sample of training documents, ``per_language`` different texts of each language chosen
   by a hash, is fitted by follow-the-regularised-leader with an elastic net.
3. The part of the sample that was not fitted on sets the temperature of the softmax.
4. All documents are scored where they are read; the model is the only thing sent to the tasks,
   and has at most 2**bits rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm import ngrams
from tallyforge.llm.common import free_name, without

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    bits: int = 14  # n-grams are hashed into 2**bits buckets
    longest: int = 3
    per_language: int = 600  # bound of the fitted sample, for each language
    languages: int = 10_000  # bound of the languages learned, the most frequent ones
    calibration_share: float = 0.25
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # per bucket
    weights: np.ndarray  # bucket (the last one: bias) x language
    temperature: float
    settings: Settings

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for group in ngrams.slices(texts):
            row, bucket, value = features(group, self.idf, self.settings)
            logits = np.empty((len(group), len(self.languages)))
            for k in range(len(self.languages)):
                logits[:, k] = np.bincount(row, value * self.weights[bucket, k], minlength=len(group))
            chances = softmax((logits + self.weights[-1]) / self.temperature)
            for text, chance in zip(group, chances):
                if any(map(str.isalpha, text)):
                    best = int(chance.argmax())
                    names.append(self.languages[best])
                    scores.append(float(min(1.0, chance[best])))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
        return names, scores


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def features(texts: list[str], idf: np.ndarray, settings: Settings):
    """(row, bucket, weight): (1 + ln count) x idf, rows scaled to length 1."""
    row, bucket, count = ngrams.counts(texts, settings.bits, settings.longest)
    value = (1 + np.log(count)) * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    return row, bucket, value / np.maximum(norm, 1e-12)[row]


def document_frequencies(train: DataFrame, text: str, settings: Settings) -> tuple[np.ndarray, int]:
    """Documents with each bucket, and documents in all; exact, over every row."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = np.zeros(1 << settings.bits, dtype=np.int64), 0
        for batch in batches:
            for group in ngrams.slices(batch[text]):
                held += np.bincount(ngrams.counts(group, settings.bits, settings.longest)[1], minlength=len(held))
                rows += len(group)
        hit = np.flatnonzero(held)
        yield pd.DataFrame({"bucket": np.append(hit, -1), "n": np.append(held[hit], rows)})

    parts = train.select(F.col(f"`{text}`").alias(text)).mapInPandas(count, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # 2**bits + 1 rows at most
    by_bucket = dict(zip(sums["bucket"], sums["n"]))
    rows = int(by_bucket.pop(-1, 0))
    out = np.zeros(1 << settings.bits)
    out[list(map(int, by_bucket))] = list(by_bucket.values())
    return out, rows


def fit_ftrl(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, width: int, classes: int, s: Settings):
    """Per-coordinate FTRL-proximal with l1 and l2 over the examples' (bucket, value) arrays."""
    z, n = np.zeros((width + 1, classes)), np.zeros((width + 1, classes))

    def weights(at):
        rate = (s.beta + np.sqrt(n[at])) / s.alpha + s.l2
        return np.where(np.abs(z[at]) <= s.l1, 0.0, -(z[at] - np.sign(z[at]) * s.l1) / rate)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for i in order.permutation(len(examples)):
            at = np.append(examples[i][0], width)
            x = np.append(examples[i][1], 1.0)
            w = weights(at)
            wrong = softmax(x @ w)
            wrong[labels[i]] -= 1.0
            g = x[:, None] * wrong
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, on a grid of factors of 1.1 from 1/20 to 20.

    The targets are smoothed by one example in n + 2, else a faultless sample would ask for a
    temperature of 0.
    """
    best, least = 1.0, np.inf
    n, classes = logits.shape
    target = np.full((n, classes), 1 / (n + 2) / max(1, classes - 1))
    target[np.arange(n), labels] = 1 - 1 / (n + 2)
    for t in 1.1 ** np.arange(-31, 32):
        loss = -(target * np.log(np.maximum(softmax(logits / t), 1e-12))).sum() / n
        if loss < least:
            best, least = float(t), loss
    return best


def sampled(usable: DataFrame, per_language: int, languages: int = Settings.languages) -> DataFrame:
    """(label, text, turn): different texts of each of the most frequent ``languages``, at most ``per_language``, by a hash.

    Copies count once, however many there are.  Texts are thinned by a hash where they are read, to
    some four times those wanted, so that the task which picks a language's sample does not get
    more from a larger corpus.
    """
    texts = F.approx_count_distinct(F.xxhash64("text")).alias("texts")
    counts = usable.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), texts).orderBy(F.desc("rows"), "label").limit(languages)
    chance = F.pmod(F.xxhash64(F.lit(13), "text"), F.lit(1 << 30)) / (1 << 30)
    thin = usable.join(F.broadcast(counts), "label").where(chance < 4 * per_language / F.col("texts"))
    order = Window.partitionBy("label").orderBy(F.xxhash64(F.lit(11), "text"), "text")
    turns = thin.select("label", "text").distinct().withColumn("turn", F.row_number().over(order))
    return turns.where(F.col("turn") <= per_language)


def train(rows: DataFrame, text: str, language: str, settings: Settings = Settings()) -> Model | None:
    """Fit on the rows with text and language; None when there are none."""
    usable = rows.where(F.col(f"`{text}`").isNotNull() & F.col(f"`{language}`").isNotNull()).select(
        F.col(f"`{text}`").alias("text"), F.col(f"`{language}`").cast("string").alias("label")
    )
    held, n_rows = document_frequencies(usable, "text", settings)
    if not n_rows:
        return None
    idf = np.log((1 + n_rows) / (1 + held)) + 1
    sample = sampled(usable, settings.per_language, settings.languages)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = 0
            for group in ngrams.slices(batch["text"]):
                row, bucket, value = features(group, idf, settings)
                part = batch.iloc[done : done + len(group)]
                done += len(group)
                yield pd.DataFrame(
                    {
                        "label": part["label"].to_numpy(),
                        "turn": part["turn"].to_numpy(),
                        "bucket": ngrams.packed(row, bucket.astype(np.int32), len(group)),
                        "value": ngrams.packed(row, value.astype(np.float32), len(group)),
                    }
                )

    schema = "label string, turn int, bucket binary, value binary"
    found = sample.mapInPandas(vectors, schema).toPandas().sort_values(["turn", "label"], kind="stable")
    languages = sorted(found["label"].unique())
    labels = np.searchsorted(languages, found["label"])
    pairs = [(np.frombuffer(b, np.int32), np.frombuffer(v, np.float32)) for b, v in zip(found["bucket"], found["value"])]
    fitted = np.ones(len(pairs), dtype=bool)
    every = max(2, round(1 / settings.calibration_share))
    if len(pairs) >= 4 * every:  # too few: fit on all, leave the temperature at 1
        fitted[found["turn"].to_numpy() % every == 0] = False
    chosen = np.flatnonzero(fitted)
    width = 1 << settings.bits
    weights = fit_ftrl([pairs[i] for i in chosen], labels[chosen], width, len(languages), settings)
    rest = np.flatnonzero(~fitted)
    temperature = 1.0
    if len(rest):
        logits = np.array([pairs[i][1] @ weights[pairs[i][0]] + weights[-1] for i in rest])
        temperature = fit_temperature(logits, labels[rest])
    return Model(languages, idf, weights, temperature, settings)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """All rows with ``lang_pred`` and its calibrated probability ``score``.

    Of languages with equal chances the first by name is predicted.  Texts that are null or have no letter, and all texts when nothing was learned, get ``und``
    and score 0.
    """
    names = ["lang_pred", "score"]
    base = without(docs, names)
    if model is None:
        return base.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(names, model.predict(texts))))

    box = free_name(base, "_language")
    out = base.withColumn(box, predicted(F.col(f"`{text}`")))
    return out.select(*(F.col(f"`{c}`") for c in base.columns), *(F.col(f"{box}.{n}") for n in names))


def held_out(doc_id: Column) -> Column:
    """True unless crc32 of the id as text leaves a remainder by 5 (null ids: true)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def language_id(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", language: str = "lang", settings: Settings = Settings()
) -> DataFrame:
    """Learn from the documents that are not held out, then predict all of them.

    Adds ``held_out``, ``lang_pred`` and ``score`` and keeps every row once, repeated ones too.
    """
    docs = without(docs, ["held_out", "lang_pred", "score"])
    marked = docs.withColumn("held_out", held_out(F.col(f"`{doc_id}`")))
    model = train(marked.where(~F.col("held_out")), text, language, settings)
    return identify(marked, model, text)

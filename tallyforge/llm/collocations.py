"""Phrase collocations, counted by an FM-index per shard.

1. Every task cuts its documents into shards of one language and bounded size: words become
   numbers, pieces of text are parted by 0.  Counts of words are added over shards; a word that is
   not frequent cannot be part of a frequent phrase and becomes a border too.
2. What is left of a shard is written as the two transforms of a bidirectional FM-index.
3. Round k extends the frequent phrases of k - 1 words by one word, at the front and at the end in
   turn, where both phrases of k - 1 words inside are frequent, and adds the counts over shards.
   Frequent phrases get numbers; a phrase of k words is known by those of its two inner ones, so
   equal phrases meet exactly, without hashes, in sorted and packed keys of a few bytes.  Shards
   are told which of their phrases are frequent, and under which number.
4. Frequent phrases meet their inner ones for the counts of all beginnings and ends, which give the
   score, and for the longer ones that make them redundant.

A shard moves once, packed, to be stored by number; counts of phrases move once a round.  The index
stays in its place, and only answers are brought to it.

Defined cases: null texts are empty; a null language is ``und``.  Empty tables and languages below
the limits give no rows.  Counts are exact up to 10**15.  A piece of text stays in one shard.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.llm.common import written
from tallyforge.llm.fmindex import BidirectionalIndex, transforms
from tallyforge.llm.wordhash import BASE, from_planes, mix, planes
from tallyforge.scale import new_path, stored_by

SHARD_BYTES = 8 << 20  # eight for each word
TEXT_BYTES = 1 << 20  # of a text, cut into words at once
BUCKET_BYTES = 12 << 20  # of text whose shards lie in one file
MOST_BUCKETS = 100_000  # Spark's bound; files grow beyond
PART_BYTES = 48 << 20  # of text for each task that adds up counts, on average
SEQUENCE_BITS = 32  # a shard's number is a task's and a count

BORDER = b"\xff"  # in no UTF-8 text
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = range(97, 123)
for _c in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_c] = BORDER[0]
_PLAIN = bytes(_PLAIN)


def tokens_of(text: str) -> Iterator[list[bytes]]:
    """Small-letter words of a text, a BORDER between its pieces, in lists of some TEXT_BYTES."""
    data = text.encode().translate(_PLAIN)
    at = 0
    while at < len(data):
        end = min(len(data), at + TEXT_BYTES)
        while end < len(data) and data[end] not in b" \t\xff":  # not within a word
            end += 1
        yield data[at:end].replace(BORDER, b" \xff ").split()
        at = end


class _Numbers(dict):
    """Words by number of first use; BORDER is 0."""

    def __init__(self) -> None:
        self[BORDER] = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


@dataclass
class _Shard:
    numbers: _Numbers = field(default_factory=_Numbers)
    parts: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, text: str) -> None:
        for tokens in tokens_of(text):
            self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
            self.size += 8 * len(tokens)
        self.parts.append(np.zeros(1, dtype=np.int32))

    def row(self, shard: int, lang: str) -> dict:
        seq = np.concatenate(self.parts)
        counts = np.bincount(seq, minlength=len(self.numbers))[1:]
        order = np.argsort(-counts, kind="stable")  # frequent words get small numbers, which pack well
        number = np.zeros(len(self.numbers), dtype=np.int32)
        number[order + 1] = np.arange(1, len(order) + 1)
        words = list(self.numbers)[1:]
        return {
            "shard": shard,
            "lang": lang,
            "tokens": int(counts.sum()),
            "words": zstandard.compress(b"\n".join([words[i] for i in order.tolist()]), 1),
            "counts": zstandard.compress(planes(counts[order].astype("<u4")), 1),
            "seq": zstandard.compress(planes(number[seq]), 1),
        }


SHARD = "shard bigint, lang string, tokens bigint, words binary, counts binary, seq binary"
_SHARD = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("tokens", pa.int64()), *((c, pa.binary()) for c in ("words", "counts", "seq"))])


def shards_of(docs: DataFrame, text: str, lang: str, shard_bytes: int, buckets: int) -> DataFrame:
    """``docs`` as shards of one language each, stored by number; a task's open shards stay within two full ones."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        open_shards: dict[str, _Shard] = {}

        def close(lang: str) -> pa.RecordBatch:
            nonlocal done
            number, done = (task << SEQUENCE_BITS) + done, done + 1
            return pa.RecordBatch.from_pylist([open_shards.pop(lang).row(number, lang)], schema=_SHARD)

        for batch in batches:
            for said, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = open_shards.setdefault(name, _Shard())
                shard.add(said)
                if shard.size >= shard_bytes:
                    yield close(name)
                elif sum(s.size for s in open_shards.values()) >= 2 * shard_bytes:
                    yield close(max(open_shards, key=lambda n: open_shards[n].size))
        for name in list(open_shards):
            yield close(name)

    read = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"))
    return stored_by(read.where("text != ''").mapInArrow(cut, SHARD), new_path(docs.sparkSession, "shards"), ["shard"], buckets)


# -- adding up over shards ------------------------------------------------------------------------

# A task sends each of its shards' keys to the task of their part, in ascending order of part and
# key; ``base`` numbers the first one within the shard.
SENT = "part int, shard bigint, base int, lang string, keys binary, n binary"
_SENT = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("base", pa.int32()), ("lang", pa.string()), ("keys", pa.binary()), ("n", pa.binary())])
# What comes back: for a shard, places of its frequent keys and their numbers; and the table of these.
FOUND = "shard bigint, local binary, ids binary, id bigint, lang string, phrase string, left bigint, right bigint, total bigint"
_FOUND = pa.schema(
    [("shard", pa.int64()), ("local", pa.binary()), ("ids", pa.binary()), ("id", pa.int64()), ("lang", pa.string())]
    + [("phrase", pa.string()), ("left", pa.int64()), ("right", pa.int64()), ("total", pa.int64())]
)


def _sent(part: int, shard: int, base: int, lang: str | None, keys: bytes, n: np.ndarray) -> pa.RecordBatch:
    counts = planes(n.astype("<u4"))
    return pa.RecordBatch.from_pylist([dict(zip(_SENT.names, (part, shard, base, lang, keys, counts)))], schema=_SENT)


def _dealt(words: bytes, parts: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A shard's words, their order by part, and where each part's begin in that order."""
    said = zstandard.decompress(words).split(b"\n")
    said = [] if said == [b""] else said
    part = np.fromiter(map(zlib.crc32, said), np.int64, len(said)) % parts
    order = np.argsort(part, kind="stable")
    return said, order, np.searchsorted(part[order], np.arange(parts + 1))


def _told(shard: int, local: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    row = {"shard": shard, "local": planes(local.astype("<i4")), "ids": planes(ids.astype("<i8"))}
    return pa.RecordBatch.from_pylist([row], schema=_FOUND)


def _table(**columns) -> Iterator[pa.RecordBatch]:
    """Rows of the table of frequent phrases."""
    n = len(columns["id"])
    for a in range(0, n, 50_000):
        part = {k: v[a : a + 50_000] for k, v in columns.items()}
        m = len(part["id"])
        yield pa.RecordBatch.from_arrays([pa.array(part[f.name], f.type) if f.name in part else pa.nulls(m, f.type) for f in _FOUND], schema=_FOUND)


def _frequent_words(shards: DataFrame, parts: int, min_count: int) -> DataFrame:
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                said, order, cuts = _dealt(row["words"], parts)
                n = from_planes(zstandard.decompress(row["counts"]), "<u4")
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    at = order[cuts[p] : cuts[p + 1]]
                    yield _sent(p, row["shard"], int(cuts[p]), row["lang"], b"\n".join([said[i] for i in at.tolist()]), n[at])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, part, totals = [], 0, {}
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                total = totals.setdefault(row["lang"], {})
                said, n = row["keys"].split(b"\n"), from_planes(row["n"], "<u4").tolist()
                for word, k in zip(said, n):
                    total[word] = total.get(word, 0) + k
                rows.append((row["shard"], row["base"], row["lang"], row["keys"]))
        ids: dict[str, dict[bytes, int]] = {}
        number = 0
        for lang, total in totals.items():
            often = [w for w, k in total.items() if k >= min_count]
            ids[lang] = dict(zip(often, ((number + i) * parts + part for i in range(len(often)))))
            number += len(often)
            phrases = [w.decode() for w in often]
            yield from _table(id=list(ids[lang].values()), lang=[lang] * len(often), phrase=phrases, total=[total[w] for w in often])
        del totals
        for shard, base, lang, keys in rows:
            told = [(i, ids[lang][w]) for i, w in enumerate(keys.split(b"\n")) if w in ids[lang]]
            if told:
                local, number_of = np.array(told, dtype=np.int64).T
                yield _told(shard, local + base, number_of)

    sent = shards.select("shard", "lang", "words", "counts").mapInArrow(send, SENT)
    return written(sent.repartitionById(parts, F.col("part")).mapInArrow(add, FOUND), "frequent_words")


def _answers(frequent: DataFrame, name: str, buckets: int) -> DataFrame:
    """(shard, name): which of a shard's phrases are frequent, and their numbers, in packed lists."""
    told = frequent.where("shard is not null").select("shard", F.struct("local", "ids").alias("told")).repartition(buckets, "shard")
    return told.groupBy("shard").agg(F.collect_list("told").alias(name))


def _answer(told: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Places, in ascending order, and numbers."""
    local = np.concatenate([from_planes(t["local"], "<i4") for t in told]).astype(np.int64)
    ids = np.concatenate([from_planes(t["ids"], "<i8") for t in told])
    order = np.argsort(local)
    return local[order], ids[order]


def _index(shards: DataFrame, words: DataFrame, depth: int, parts: int, buckets: int) -> DataFrame:
    """(shard, names, before, after): the FM-index over each shard's frequent words."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                seq = from_planes(zstandard.decompress(row["seq"]), "<i4")
                local, names = _answer(row["told"])
                said, order, _ = _dealt(row["words"], parts)
                number = np.zeros(len(said) + 1, dtype=np.int32)
                often = order[local]
                by_number = np.argsort(often)
                number[often[by_number] + 1], names = np.arange(1, len(local) + 1), names[by_number]
                seq = np.append(number[seq], np.int32(0))
                # Words without a neighbour are in no phrase, and one border is as good as many.
                filled = np.concatenate([[False], seq > 0, [False]])
                seq = seq[filled[:-2] | (filled[1:-1] & filled[2:])]
                if not seq.any():
                    continue
                before, after = transforms(np.append(seq, np.int32(0)), depth)
                packed = [zstandard.compress(planes(x.astype("<i4")), 1) for x in (before, after)]
                columns = [pa.array([row["shard"]]), *(pa.array([v], pa.binary()) for v in (planes(names), *packed))]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "names", "before", "after"])

    asked = shards.select("shard", "words", "seq").join(_answers(words, "told", buckets), "shard")
    return asked.select("shard", "words", "seq", "told").mapInArrow(build, "shard bigint, names binary, before binary, after binary")


KEY = np.dtype([("left", "<i8"), ("right", "<i8")])


def _frequent_phrases(index: DataFrame, rounds: list[DataFrame], parts: int, buckets: int, min_count: int) -> DataFrame:
    """The phrases one word longer than those of the last round.

    ``left`` and ``right`` number the phrase without the last and without the first word.
    """
    told, longest = index, len(rounds)
    for k, frequent in enumerate(rounds):
        told = told.join(_answers(frequent, f"told{k}", buckets), "shard")
    columns = ["shard", "names", "before", "after", *(f"told{k}" for k in range(longest))]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                before, after = (from_planes(zstandard.decompress(row[c]), "<i4") for c in ("before", "after"))
                names = from_planes(row["names"], "<i8")
                fm = BidirectionalIndex(before, after)
                phrases = fm.words(len(names))
                for k in range(longest + 1):
                    phrases, near, far = fm.extended(phrases, k % 2)
                    left, right = (names[far], names[near]) if k % 2 == 0 else (names[near], names[far])
                    part = (mix(left.astype(np.uint64) * np.uint64(BASE) + right.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                    order = np.lexsort((right, left, part))
                    phrases, left, right, part = phrases.at(order), left[order], right[order], part[order]
                    if k < longest:
                        local, names = _answer(row[f"told{k}"])
                        phrases = phrases.at(local)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    a, b = cuts[p], cuts[p + 1]
                    keys = planes(np.diff(left[a:b], prepend=0)) + planes(right[a:b])
                    yield _sent(p, row["shard"], int(a), None, zstandard.compress(keys, 1), phrases.size[a:b])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, bases, keys, n, part = [], [], [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                shards.append(row["shard"])
                bases.append(row["base"])
                data = zstandard.decompress(row["keys"])
                key = np.empty(len(data) // 16, dtype=KEY)
                key["left"] = np.cumsum(from_planes(data[: len(data) // 2], "<i8"))
                key["right"] = from_planes(data[len(data) // 2 :], "<i8")
                keys.append(key)
                n.append(from_planes(row["n"], "<u4"))
        if not keys:
            return
        many = [len(k) for k in keys]
        every, n = np.concatenate(keys), np.concatenate(n).astype(np.int64)
        del keys
        order = np.lexsort((every["right"], every["left"]))
        every = every[order]
        heads = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        total = np.add.reduceat(n[order], heads)
        often = total >= min_count
        ids = np.full(len(heads), -1, dtype=np.int64)
        ids[often] = np.arange(int(often.sum())) * parts + part
        first = every[heads[often]]
        yield from _table(id=ids[often], left=first["left"], right=first["right"], total=total[often])
        told = np.empty(len(every), dtype=np.int64)
        told[order] = np.repeat(ids, np.diff(np.append(heads, len(every))))
        for shard, base, own in zip(shards, bases, np.split(told, np.cumsum(many)[:-1])):
            local = np.flatnonzero(own >= 0)
            if len(local):
                yield _told(shard, local + base, own[local])

    sent = told.select(*columns).mapInArrow(send, SENT).repartitionById(parts, F.col("part"))
    return written(sent.mapInArrow(add, FOUND), f"frequent_{longest + 2}")


# -- scores ---------------------------------------------------------------------------------------


def _wide(column: str, digits: int) -> F.Column:
    return F.col(column).cast(f"decimal({digits},0)")


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """With the lowest-scoring cut: k, l, r and the score, exact in decimals of up to 37 digits."""
    table = phrases.join(totals, "lang")
    whole = (F.lit(1000).cast("decimal(4,0)") * _wide("total", 16)).cast("decimal(20,0)") * _wide("n", 16)

    def cut(k: F.Column) -> F.Column:
        left, right = F.element_at("heads", k), F.element_at("tails", k + 1)
        both = left.cast("decimal(16,0)") * right.cast("decimal(16,0)")
        return F.struct(F.call_function("div", F.col("_whole"), both).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    cuts = F.transform(F.sequence(F.lit(1), F.size("heads") - 1), cut)
    return table.withColumn("_whole", whole).withColumn("_cut", F.array_min(cuts)).select("lang", "phrase", F.col("total").alias("a"), "_cut.l", "_cut.r", "n", "_cut.score")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = 100,
    max_words: int = 5,
    top: int = 2000,
    absorb_percent: int = 100,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of 2 to ``max_words`` words a language.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts of its lowest-scoring cut, ``n`` the
    language's words.  A phrase inside a longer one with ``absorb_percent`` of its count is left out.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(1, min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))
    shards = shards_of(docs, text, lang, shard_bytes, buckets)
    totals = shards.groupBy("lang").agg(F.sum("tokens").alias("n"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    words = _frequent_words(shards, parts, min_count)
    index = stored_by(_index(shards, words, max_words, parts, buckets), new_path(spark, "fm_index"), ["shard"], buckets, dealt=True)
    array = F.array("total")
    level = words.where("shard is null").select("id", "lang", "phrase", "total", array.alias("heads"), array.alias("tails"))
    levels, rounds = [], []
    for k in range(2, max_words + 1):
        frequent = _frequent_phrases(index, rounds, parts, buckets, min_count)
        rounds.append(frequent)
        own = frequent.where("shard is null").select("id", "left", "right", "total")
        heads = level.select(F.col("id").alias("left"), "lang", "phrase", "heads")
        tails = level.select(F.col("id").alias("right"), F.substring_index("phrase", " ", -1).alias("last"), "tails")
        level = written(
            own.join(heads, "left").join(tails, "right").select(
                "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "total", "left", "right",
                F.concat("heads", F.array("total")).alias("heads"), F.concat(F.array("total"), "tails").alias("tails"),
            ),
            "phrases",
        )
        levels.append(level.withColumn("size", F.lit(k)))
    every = functools.reduce(DataFrame.unionByName, levels)
    inner = [every.select((F.col("size") - 1).alias("size"), F.col(side).alias("id"), F.col("total").alias("longer")) for side in ("left", "right")]
    longer = inner[0].unionByName(inner[1]).groupBy("size", "id").agg(F.max("longer").alias("longer"))
    kept = every.join(longer, ["size", "id"], "left").where(F.expr(f"longer is null or 100 * longer < {absorb_percent} * total"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = _scored(kept, totals).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

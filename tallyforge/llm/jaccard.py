"""Near-duplicate join on word shingles, exact, by prefix filters under several token orders.

Two sets whose Jaccard similarity is at least t share one of the first n - ceil(t n) + 1 tokens of
either, in whatever order all tokens are put.  Candidates must pass that test under several
orders.  All orders put rare tokens first and differ among tokens of about the same frequency.

1. Texts are hashed block by block.  A block sends its tokens once, sorted and packed, to the task
   of their hash range, which counts documents per token and answers with the tokens that occur
   elsewhere too.  A token frequent within a block is sent as a count, so a passage in a third of
   all documents costs its task one number for each block.
2. A document with too many tokens of its own cannot be similar to any other.  For the rest, the
   shared tokens are kept, one copy for each distinct set.
3. Sets meet under the tokens of their prefix in the first order.  In each meeting every set is
   paired with one leader of its size and of the next.  The pairs meet the prefixes of the other
   orders, small columns; only those that share a token in every order are joined with the sets'
   tokens and verified.  Linked sets form components.
4. Meetings whose sets are in different components by then are resolved in full: everything
   outside the main component of the meeting is paired with all others there, the rows of a hot
   token dealt over several tasks.  Pairs that differ too much by what the comparisons with their
   common leader told are left out, which is exact.
5. All links lie within components.  There sets are compared block against block, by products of
   their token matrices, and only counts leave the task: pairs are never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.llm.components import components
from tallyforge.llm import wordhash
from tallyforge.llm.wordhash import from_planes, from_steps, grouped, mix, planes, runs_of, steps, word_arrays
from tallyforge.scale import join_unique, passing

HASH_BITS = 48  # of a token; two of a pair's tokens meet by chance once in 10**14 / (their number)
BLOCK_BYTES = 4 << 20  # text in one block
BLOCK_DOCS = 60_000  # and documents, numbered by 16 bits
BLOCK_HOT = 32  # documents of a block from which on it sends a token as a count
SPREAD_ROWS = 1000  # of a hot token's meeting in one task; its other side is sent to each
LINK_BYTES = 4 << 20  # tokens of the sets of a component that are compared with others at once
PART_BYTES = 8 << 20  # text whose tokens one counting task gets, on average
BROADCAST_IDS = 2_000_000  # ids of 8 bytes each that may be broadcast; more meet by a shuffle

# Kinds of rows between the tasks.
TOKENS, HOT_COUNTS, DOCS, HOT_PLACES, SHARED, HOT_SHARED = range(6)


@dataclass(frozen=True)
class Similarity:
    """Sets are similar when percent * union <= 100 * intersection."""

    width: int = 5  # words in a shingle
    percent: int = 80

    def least_overlap(self, n):
        """Tokens that a set of n shares at least with any similar set."""
        return -(-self.percent * n // 100)

    def similar(self, n_a, n_b, both):
        return 100 * both >= self.percent * (n_a + n_b - both)

    def size_class(self) -> str:
        """SQL for a class of sizes n such that similar sets are in the same or in neighbouring ones."""
        # a little narrower than exact, so that rounding in ln() cannot separate similar sets
        return f"cast(floor(ln(n) / {math.log(100 / self.percent) * 1.0001}) as int)"


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, ASCII capitals lowered.

    A text of 1 to width - 1 words has its whole sequence as the one shingle; without words, none.
    """
    words, first = word_arrays([t.lower() for t in texts])
    runs = runs_of(words, width)
    out = []
    for a, b in zip(first, first[1:]):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            short = runs_of(words[a:b], int(b - a)) * np.uint64(2 * width + 1) + np.uint64(b - a)
            out.append(mix(short))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit numbers for a set, as signed."""
    if not len(tokens):
        return 0, 0
    one = np.add.reduce(mix(tokens + np.uint64(1)), dtype=np.uint64)
    two = np.bitwise_xor.reduce(mix(tokens * np.uint64(wordhash.BASE)))
    return tuple(np.array([one, two], dtype=np.uint64).view(np.int64).tolist())


# -- 1. which tokens occur elsewhere ----------------------------------------------------------


def _pack(*arrays: bytes) -> bytes:
    head = np.array([len(arrays), *map(len, arrays)], dtype="<u4").tobytes()
    return zstandard.compress(head + b"".join(arrays), 1)


def _unpack(data: bytes) -> list[bytes]:
    data = zstandard.decompress(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = 4 * (n + 1) + np.cumsum(np.frombuffer(data, "<u4", n, 4).astype(np.int64))
    return [data[e - s : e] for e, s in zip(ends.tolist(), np.frombuffer(data, "<u4", n, 4).tolist())]


ROW = "part int, kind int, block long, data binary"
ROW_NAMES = ["part", "kind", "block", "data"]


def _block_rows(block: int, ids: list, sets: list[np.ndarray], prints: list[tuple[int, int]], parts: int):
    shift = np.uint64(64 - HASH_BITS)
    known = np.array([i is not None for i in ids], dtype=np.uint8)
    table = _pack(
        np.array([i or 0 for i in ids], dtype="<i8").tobytes(),
        known.tobytes(),
        np.array([len(s) for s in sets], dtype="<u4").tobytes(),
        np.array(prints, dtype="<i8").reshape(-1, 2).tobytes(),
    )
    yield block % parts, DOCS, block, table
    tokens = np.concatenate(sets) >> shift if sets else np.empty(0, dtype=np.uint64)
    place = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, place = tokens[order], place[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = tokens[1:] != tokens[:-1]
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(tokens)))
    hot = np.repeat(count >= BLOCK_HOT, count)
    hot_tokens, hot_count = tokens[heads[count >= BLOCK_HOT]], count[count >= BLOCK_HOT]
    if len(hot_tokens):
        yield block % parts, HOT_PLACES, block, _pack(steps(tokens[hot]), planes(place[hot]))
    tokens, place = tokens[~hot], place[~hot]
    # ranges of equal width; part p takes the tokens from borders[p] on
    borders = np.array([(p << HASH_BITS) // parts for p in range(1, parts)], dtype=np.uint64)
    for kind, values, rest in ((TOKENS, tokens, place), (HOT_COUNTS, hot_tokens, hot_count.astype(np.uint32))):
        cuts = [0, *np.searchsorted(values, borders).tolist(), len(values)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                yield p, kind, block, _pack(steps(values[a:b]), planes(rest[a:b]))


def scatter(parts: int, width: int):
    """The task that reads texts: its blocks' tokens, by part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        number, size = 0, 0
        ids, sets, prints = [], [], []

        def flush() -> pd.DataFrame:
            nonlocal number, size
            rows = list(_block_rows((task << 32) + number, ids, sets, prints, parts))
            number, size = number + 1, 0
            ids.clear(), sets.clear(), prints.clear()
            return pd.DataFrame(rows, columns=ROW_NAMES)

        for batch in batches:
            values = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            at = 0
            for texts in grouped(batch["text"]):
                found = shingle_sets(texts, width)
                ids += values[at : at + len(texts)]
                sets += found
                prints += map(fingerprint, found)
                at += len(texts)
                size += sum(map(len, texts))
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS - 10_000:
                    yield flush()
        if ids:
            yield flush()

    return run


def count_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The task of a hash range: answers each block with its tokens that two or more documents have.

    The answer holds the class of the number of documents: its binary logarithm.
    """
    blocks, kinds, tokens, rests = [], [], [], []
    for batch in batches:
        for part, kind, block, data in zip(batch["part"], batch["kind"], batch["block"], batch["data"]):
            if kind in (DOCS, HOT_PLACES):
                yield pd.DataFrame([(part, kind, block, data)], columns=ROW_NAMES)
                continue
            a, b = _unpack(data)
            blocks.append(block)
            kinds.append(kind)
            tokens.append(from_steps(a))
            rests.append(from_planes(b, np.uint16 if kind == TOKENS else np.uint32))
    if not blocks:
        return
    every = np.concatenate(tokens)
    weight = np.concatenate([np.ones(len(t), dtype=np.int64) if k == TOKENS else r.astype(np.int64) for k, t, r in zip(kinds, tokens, rests)])
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    totals = np.add.reduceat(weight[order], heads)
    frequency = np.empty(len(every), dtype=np.int64)
    frequency[order] = np.repeat(totals, np.diff(np.append(heads, len(ordered))))
    del order, ordered, weight
    at = 0
    for kind, block, t, r in zip(kinds, blocks, tokens, rests):
        own = frequency[at : at + len(t)]
        at += len(t)
        hit = own >= 2
        if hit.any():
            level = np.log2(own[hit]).astype(np.uint8)
            rest = r[hit] if kind == TOKENS else np.empty(0, dtype=np.uint16)
            data = _pack(steps(t[hit]), planes(rest), level.tobytes())
            yield pd.DataFrame([(0, SHARED if kind == TOKENS else HOT_SHARED, block, data)], columns=ROW_NAMES)


DOC = "doc_id long, n int, one long, two long, tokens binary"


def assemble(similarity: Similarity):
    """For one block: its documents, with the shared tokens of those that may have a similar one.

    ``tokens`` are uint64 numbers, (class << HASH_BITS) + hash, ascending.  Of documents with equal
    sets only the block's first carries them.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        by_kind: dict[int, list] = {}
        for kind, data in zip(rows["kind"], rows["data"]):
            by_kind.setdefault(kind, []).append(_unpack(data))
        ids, known, sizes, prints = by_kind[DOCS][0]
        ids, known = np.frombuffer(ids, "<i8"), np.frombuffer(known, np.uint8)
        sizes = np.frombuffer(sizes, "<u4").astype(np.int64)
        prints = np.frombuffer(prints, "<i8").reshape(-1, 2)
        # equal sets: only the one with the smallest id goes on
        rank = pd.DataFrame({"one": prints[:, 0], "two": prints[:, 1], "known": 1 - known.astype(int), "id": ids})
        chosen = ~rank.sort_values(["known", "id"], kind="stable").duplicated(["one", "two"]).sort_index().to_numpy()
        chosen &= known > 0
        tokens, places = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.uint16)]
        for a, b, level in by_kind.get(SHARED, ()):
            place = from_planes(b, np.uint16)
            keep = chosen[place]
            key = from_steps(a)[keep] + (np.frombuffer(level, np.uint8)[keep].astype(np.uint64) << np.uint64(HASH_BITS))
            tokens.append(key)
            places.append(place[keep])
        hot = {}
        for a, _, level in by_kind.get(HOT_SHARED, ()):
            hot.update(zip(from_steps(a).tolist(), np.frombuffer(level, np.uint8).tolist()))
        for a, b in by_kind.get(HOT_PLACES, ()):
            token, place = from_steps(a), from_planes(b, np.uint16)
            value, back = np.unique(token, return_inverse=True)
            level = np.array([hot[v] for v in value.tolist()], dtype=np.uint64)[back]
            keep = chosen[place]
            tokens.append(token[keep] + (level[keep] << np.uint64(HASH_BITS)))
            places.append(place[keep])
        token, place = np.concatenate(tokens), np.concatenate(places)
        order = np.lexsort((token, place))
        token, place = token[order], place[order]
        cuts = np.searchsorted(place, np.arange(len(ids) + 1))
        held = []
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            enough = chosen[i] and sizes[i] and b - a >= similarity.least_overlap(sizes[i])
            held.append(token[a:b].tobytes() if enough else None)
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(known > 0, ids, 0), dtype="Int64").copy(),
                "n": sizes.astype(np.int32),
                "one": prints[:, 0],
                "two": prints[:, 1],
                "tokens": held,
            }
        ).assign(doc_id=lambda d: d["doc_id"].mask(known == 0))

    return run


def document_sets(docs: DataFrame, similarity: Similarity, doc_id: str, text: str) -> DataFrame:
    """Every document with the size and fingerprint of its set, and shared tokens as ``assemble`` says."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    sent = source.mapInPandas(scatter(parts, similarity.width), ROW).repartitionById(parts, F.col("part"))
    answers = sent.mapInPandas(count_tokens, ROW)
    return written(answers.groupBy("block").applyInPandas(assemble(similarity), DOC), "sets")


# -- 2. candidates and links -------------------------------------------------------------------


def in_order(tokens: np.ndarray, order: int) -> np.ndarray:
    """Rank keys of a set's tokens under an order: by class of frequency, then by the order's hash."""
    level = tokens >> np.uint64(HASH_BITS)
    return (level << np.uint64(HASH_BITS)) | (mix(tokens + np.uint64(order << 56)) >> np.uint64(64 - HASH_BITS))


def prefix(tokens: np.ndarray, n: int, order: int, similarity: Similarity) -> np.ndarray:
    """The set's shared tokens among its first n - least_overlap + 1; tokens of its own come before."""
    long = n - int(similarity.least_overlap(n)) + 1 - (n - len(tokens))
    if long >= len(tokens):
        return tokens
    return tokens[np.argpartition(in_order(tokens, order), long - 1)[:long]]


def prefixes(similarity: Similarity):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [prefix(np.frombuffer(t, np.uint64), n, 0, similarity) for t, n in zip(batch["tokens"], batch["n"])]
            many = [len(f) for f in found]
            yield pd.DataFrame(
                {
                    "token": np.concatenate(found).view(np.int64) if found else [],
                    "id": np.repeat(batch["id"].to_numpy(), many),
                    "n": np.repeat(batch["n"].to_numpy(), many),
                    "own": np.repeat(batch["n"].to_numpy() - np.array([len(t) // 8 for t in batch["tokens"]], dtype=np.int32), many),
                }
            )

    return run


ORDERS = (1, 2)  # besides order 0, under which sets meet


SKETCH = 4  # longs of a sketch
_P, _Q = [f"p{i}" for i in range(SKETCH)], [f"q{i}" for i in range(SKETCH)]


def sketch(tokens: np.ndarray) -> list[int]:
    """A bitmap of tokens; sets that differ in a bit differ in a token."""
    bits = np.zeros(64 * SKETCH, dtype=np.uint8)
    bits[(mix(tokens) % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def marks(similarity: Similarity):
    """(id, n, and for each further order the prefix as 32-bit hashes): chance meetings only cost a verification."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.frombuffer(t, np.uint64) for t in batch["tokens"]]
            out = {"id": batch["id"], "n": batch["n"]}
            for k in ORDERS:
                out[f"order{k}"] = [mix(prefix(t, n, k, similarity)).astype(np.uint32).view(np.int32) for t, n in zip(sets, batch["n"])]
            yield pd.DataFrame(out)

    return run


MARKS = "id long, n int, " + ", ".join(f"order{k} array<int>" for k in ORDERS)


def compare(similarity: Similarity):
    """For pairs of sets whether they are ``linked``.

    ``p`` is the sketch of what only the first has, ``q`` of what only the second has.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for id_a, id_b, n_a, n_b, a, b in zip(*(batch[c] for c in ("a", "b", "n_a", "n_b", "tokens_a", "tokens_b"))):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.intersect1d(a, b, assume_unique=True)
                only = [sketch(np.setdiff1d(x, both, assume_unique=True)) for x in (a, b)]
                rows.append((id_a, id_b, bool(similarity.similar(n_a, n_b, both.size)), *only[0], *only[1]))
            yield pd.DataFrame(rows, columns=["a", "b", "linked", *_P, *_Q])

    return run


def candidates(pairs: DataFrame, marked: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (a, b) of possible sizes that share a prefix token in every further order, with n_a and n_b."""
    left = marked.select(F.col("id").alias("a"), F.col("n").alias("n_a"), *(F.col(f"order{k}").alias(f"a{k}") for k in ORDERS))
    right = marked.select(F.col("id").alias("b"), F.col("n").alias("n_b"), *(F.col(f"order{k}").alias(f"b{k}") for k in ORDERS))
    met = pairs.join(left, "a").join(right, "b").where(
        (F.col("n_a") * similarity.percent <= F.col("n_b") * 100) & (F.col("n_b") * similarity.percent <= F.col("n_a") * 100)
    )
    for k in ORDERS:
        met = met.where(F.arrays_overlap(f"a{k}", f"b{k}"))
    return met.select("a", "b", "n_a", "n_b")


def if_few(ids: DataFrame) -> DataFrame:
    """Written ids for a join with long rows, which stay where they are unless there are very many ids."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def compared(pairs: DataFrame, sets: DataFrame, marked: DataFrame, similarity: Similarity) -> DataFrame:
    """The candidates among the distinct pairs (a, b) of set ids, as ``compare`` says; no other set is moved."""
    pairs = written(candidates(pairs, marked, similarity), "candidates")
    used = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets.join(if_few(written(used, "used")), "id", "left_semi")
    left = sets.select(F.col("id").alias("a"), F.col("tokens").alias("tokens_a"))
    right = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tokens_b"))
    met = pairs.join(left, "a").join(right, "b")
    schema = "a long, b long, linked boolean, " + ", ".join(f"{c} long" for c in _P + _Q)
    return written(met.mapInPandas(compare(similarity), schema), "compared")


def ordered_pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def may_be_similar(similarity: Similarity) -> str:
    """SQL: whether sets x and y of one meeting can be similar, by what is known of both.

    ``own`` counts tokens no other set has.  When both were compared with one leader, what x has
    more than the leader and y has not, and what y lacks of the leader and x has not, is in x alone.
    """

    def alone(x: str, y: str) -> str:
        more = " + ".join(f"bit_count({x}.p{i} & ~{y}.p{i}) + bit_count({y}.q{i} & ~{x}.q{i})" for i in range(SKETCH))
        return f"{x}.own + if({x}.leader = {y}.leader, coalesce({more}, 0), 0)"

    both = f"least(x.n - ({alone('x', 'y')}), y.n - ({alone('y', 'x')}))"
    return f"100 * {both} >= {similarity.percent} * (x.n + y.n - {both})"


def set_components(sets: DataFrame, similarity: Similarity) -> DataFrame:
    """(id, component) of the sets that are linked to others."""
    rows = sets.select("id", "n", "tokens").mapInPandas(prefixes(similarity), "token long, id long, n int, own int")
    # A token that a single set has in its prefix brings no pair; counting is cheap and exact.
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    meetings = written(rows.join(shared, "token", "left_semi").withColumn("size", F.expr(similarity.size_class())), "meetings")
    leaders = meetings.groupBy("token", "size").agg(F.min("id").alias("leader"))
    near = leaders.unionByName(leaders.withColumn("size", F.col("size") - 1))
    near = near.groupBy("token", "size").agg(F.collect_set("leader").alias("leaders"))  # two at most
    stars = join_unique(meetings, near, ["token", "size"]).select("id", F.explode("leaders").alias("leader"))
    stars = stars.where("id <> leader").select(*ordered_pair("id", "leader")).distinct()
    marked = written(sets.select("id", "n", "tokens").mapInPandas(marks(similarity), MARKS), "marks")
    seen = compared(stars, sets, marked, similarity)
    links = seen.where("linked").select("a", "b")
    found = components(links)
    # What the stars left open: meetings with several components.
    labelled = meetings.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labelled = written(labelled, "labelled")
    groups = labelled.groupBy("token", "component").agg(F.count(F.lit(1)).alias("m"))
    main = groups.groupBy("token").agg(F.max(F.struct("m", "component")).alias("main"), F.count(F.lit(1)).alias("k"), F.sum("m").alias("m"))
    spread = F.ceil(F.col("m") / SPREAD_ROWS).cast("int").alias("spread")
    main = main.where("k > 1").select("token", F.col("main.component").alias("main"), spread)
    open_rows = join_unique(join_unique(labelled, main, ["token"]), leaders, ["token", "size"])
    # What each set and its leader have alone.
    one = seen.select(F.col("a").alias("id"), F.col("b").alias("leader"), *_P, *_Q)
    two = seen.select(F.col("b").alias("id"), F.col("a").alias("leader"), *(F.col(q).alias(p) for p, q in zip(_P + _Q, _Q + _P)))
    known = open_rows.join(one.unionByName(two), ["id", "leader"], "left")
    known = known.withColumns({c: F.when(F.col("id") == F.col("leader"), F.lit(0)).otherwise(F.col(c)) for c in _P + _Q})
    known = written(known, "open")
    # A hot token's first sides are dealt over tasks, its second sides go to each of them.
    dealt = known.where("component <> main").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("spread")).cast("int"))
    every = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1)))
    cross = dealt.alias("x").join(
        every.alias("y"),
        F.expr("x.token = y.token and x.salt = y.salt and x.component <> y.component and abs(x.size - y.size) <= 1")
        & F.expr(may_be_similar(similarity)),
    )
    more = compared(cross.select(*ordered_pair("x.id", "y.id")).distinct(), sets, marked, similarity)
    return components(links.unionByName(more.where("linked").select("a", "b")))


# -- 3. links ----------------------------------------------------------------------------------


TOKENS_AT_ONCE = 4096


def _shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``a`` shares with each of ``b``: products of matrices, some tokens at a time."""
    out = np.zeros((len(a), len(b)), dtype=np.float32)  # whole numbers below 2**24
    token = np.intersect1d(np.concatenate(a), np.concatenate(b))
    sides = []
    for sets in (a, b):
        row = np.repeat(np.arange(len(sets)), [len(t) for t in sets])
        every = np.concatenate(sets)
        at = np.searchsorted(token, every)
        at[at == len(token)] = 0
        hit = token[at] == every if len(token) else np.zeros(len(every), dtype=bool)
        order = np.argsort(at[hit], kind="stable")
        sides.append((at[hit][order], row[hit][order], len(sets)))
    for first in range(0, len(token), TOKENS_AT_ONCE):
        last = min(len(token), first + TOKENS_AT_ONCE)
        held = []
        for at, row, n in sides:
            lo, hi = np.searchsorted(at, [first, last])
            matrix = np.zeros((n, last - first), dtype=np.float32)
            matrix[row[lo:hi], at[lo:hi] - first] = 1
            held.append(matrix)
        out += held[0] @ held[1].T
    return out


def block_links(similarity: Similarity):
    """For a pair of blocks of one component: (id, links), documents linked with each set.

    ``copies`` counts a set's documents.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first, second = (rows[rows["side"] == k] for k in (0, 1))
        same = not len(second)
        second = first if same else second
        a, b = ([np.frombuffer(t, np.uint64) for t in side["tokens"]] for side in (first, second))
        n_a, n_b = (side["n"].to_numpy(dtype=np.int64) for side in (first, second))
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "links": []}, dtype="int64")
        both = _shared_counts(a, b).astype(np.int64)
        linked = similarity.similar(n_a[:, None], n_b[None, :], both)
        if same:
            np.fill_diagonal(linked, False)
        copies_a, copies_b = (side["copies"].to_numpy(dtype=np.int64) for side in (first, second))
        parts = [pd.DataFrame({"id": first["id"].to_numpy(), "links": linked @ copies_b})]
        if not same:
            parts.append(pd.DataFrame({"id": second["id"].to_numpy(), "links": linked.T @ copies_a}))
        return pd.concat(parts)

    return run


def link_counts(sets: DataFrame, found: DataFrame, similarity: Similarity) -> DataFrame:
    """(id, links) of the sets (id, n, tokens, copies) in components: documents whose set is similar, but not equal.

    A component's sets are dealt over blocks of about LINK_BYTES; every block meets every other.
    """
    least = found.select("component").distinct().select(F.col("component").alias("id"), "component")  # stands for itself
    sizes = sets.join(found.unionByName(least), "id")
    blocks = sizes.groupBy("component").agg(F.ceil(F.sum(F.octet_length("tokens")) / LINK_BYTES).cast("int").alias("blocks"))
    own = join_unique(sizes, blocks, ["component"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")]
    side = F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side")
    met = met.select("component", *pair, side, "id", "n", "tokens", "copies")
    counted = met.groupBy("component", "i", "j").applyInPandas(block_links(similarity), "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def jaccard_components(
    docs: DataFrame, similarity: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text", links: bool = True
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and, with ``links``, n_links.

    The component is the smallest doc_id reachable over links between similar shingle sets, itself
    included; n_links counts the other rows that a row is linked with, equal sets among them.  A
    text without words (null, empty, white space) has an empty set and is linked with nothing.  Rows
    with one doc_id count as one document in components, which has the links of all its rows; rows
    without an id are linked with nothing and have no component.  Ids are read as whole numbers;
    other columns are not carried.
    """
    found = document_sets(docs, similarity, doc_id, text)
    first = Window.partitionBy("one", "two", "n").orderBy("doc_id")
    sets = written(
        found.where("tokens is not null").withColumn("turn", F.row_number().over(first)).where("turn = 1")
        .select(F.col("doc_id").alias("id"), "n", "one", "two", "tokens"), "sets"
    )
    with passing(docs.sparkSession):
        linked_sets = written(set_components(sets, similarity), "linked")
    # Equal sets: one document stands for all.
    worded = found.where("n > 0 and doc_id is not null").groupBy("one", "two", "n").agg(
        F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies")
    )
    component = worded.join(linked_sets, "id", "left")
    n_links = F.lit(0).cast("long")
    if links:
        weighed = sets.join(worded.select("one", "two", "n", "copies"), ["one", "two", "n"]).select("id", "n", "tokens", "copies")
        counts = link_counts(weighed, linked_sets, similarity)
        component = worded.join(linked_sets, "id", "left").join(counts, "id", "left")
        n_links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    component = component.select("one", "two", "n", F.coalesce("component", "id").alias("component_id"), n_links.alias("n_links"))
    alone = found.where("n = 0 or doc_id is null").withColumns({"component_id": F.col("doc_id"), "n_links": F.lit(0).cast("long")})
    rest = join_unique(found.where("n > 0 and doc_id is not null"), component, ["one", "two", "n"])
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", *(["n_links"] if links else [])]
    return rest.select(*columns).unionByName(alone.select(*columns))


def representatives(
    docs: DataFrame, similarity: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the document with its smallest id.

    Of rows with one id one stays, that with the least text; rows without an id all stay.
    """
    with passing(docs.sparkSession):
        found = jaccard_components(docs, similarity, doc_id, text, links=False).where("doc_id is not null")
        known = written(found, "components")
    later = written(known.where("component_id <> doc_id").select(F.col("doc_id").alias("later")).distinct(), "later")
    again = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select(F.col("doc_id").alias("again"))
    again = written(again, "again")
    left = docs.join(if_few(later), docs[doc_id].cast("long") == F.col("later"), "left_anti")
    if again.isEmpty():  # else Spark would move all texts to meet no id
        return left
    key = left[doc_id].cast("long") == F.col("again")
    again = if_few(again)
    once = left.join(again, key, "left_anti")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    merged = left.join(again, key, "left_semi").groupBy(F.col(f"`{doc_id}`")).agg(F.min_by(row, F.struct(F.col(f"`{text}`"))).alias("_row"))
    return once.unionByName(merged.select("_row.*"))

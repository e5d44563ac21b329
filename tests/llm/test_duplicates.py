import hashlib
import re
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import blocks, factors, jaccard, queries, recompression, suffixes
from tallyforge.scale import CLEANUP


def by_row(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (2, 60)])
def test_jaccard_of_nasty_rows(spark, nasty, nasty_table, width, percent):
    found = jaccard.jaccard_components(nasty_table, jaccard.Similarity(width, percent)).collect()
    wanted = brute.jaccard_components(nasty, width, percent)
    links = brute.jaccard_links(nasty, width, percent)
    assert by_row(found) == by_row((i, len(brute.shingle_set(t, width)), wanted.get(i), n) for (i, t), n in zip(nasty, links))


def test_jaccard_when_blocks_are_small_and_tokens_hot(spark, nasty, nasty_table, monkeypatch):
    """Many blocks, tokens sent as counts, leaders that do not reach everyone."""
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(jaccard, "BLOCK_HOT", 2)
    monkeypatch.setattr(jaccard, "PART_BYTES", 3000)
    monkeypatch.setattr(jaccard, "SPREAD_ROWS", 3)
    monkeypatch.setattr(jaccard, "LINK_BYTES", 5000)
    monkeypatch.setattr(jaccard, "TOKENS_AT_ONCE", 50)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(jaccard)
    try:
        found = jaccard.jaccard_components(nasty_table, jaccard.Similarity(3, 70)).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(jaccard)
    wanted = brute.jaccard_components(nasty, 3, 70)
    links = brute.jaccard_links(nasty, 3, 70)
    assert by_row(found) == by_row((i, len(brute.shingle_set(t, 3)), wanted.get(i), n) for (i, t), n in zip(nasty, links))


def test_further_orders_leave_fewer_pairs_to_verify(spark):
    """Of all pairs that meet under the first order, the others drop some, and none that is similar."""
    rng = np.random.default_rng(4)
    similarity = jaccard.Similarity(1, 80)
    core = rng.integers(0, 1 << 40, 30, dtype=np.uint64)
    sets = []
    for k in range(120):
        kept = core[rng.random(30) < rng.choice([0.97, 0.6])]
        sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 40, int(rng.integers(0, 8)), dtype=np.uint64)])))
    table = spark.createDataFrame([(k, len(t), t.tobytes()) for k, t in enumerate(sets)], "id long, n int, tokens binary")
    first = [set(jaccard.prefix(t, len(t), 0, similarity).tolist()) for t in sets]
    sizes = lambda a, b: 80 * len(a) <= 100 * len(b) and 80 * len(b) <= 100 * len(a)
    met = [(a, b) for b in range(120) for a in range(b) if first[a] & first[b] and sizes(sets[a], sets[b])]
    marked = table.mapInPandas(jaccard.marks(similarity), jaccard.MARKS)
    pairs = spark.createDataFrame(met, "a long, b long")
    left = {(r.a, r.b) for r in jaccard.candidates(pairs, marked, similarity).collect()}
    alike = {(a, b) for a, b in met if similarity.similar(len(sets[a]), len(sets[b]), len(np.intersect1d(sets[a], sets[b])))}
    assert alike <= left < set(met) and len(alike) > 100 and len(met) - len(left) > 50


def test_representatives(spark, nasty, nasty_table, empty_table):
    left = jaccard.representatives(nasty_table)
    assert left.columns == nasty_table.columns
    component = brute.jaccard_components(nasty, 5, 80)
    wanted = sorted(i for i in component if component[i] == i)
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == wanted
    assert left.where("doc_id is null").count() == sum(i is None for i, _ in nasty)
    assert jaccard.representatives(empty_table).count() == 0


@pytest.mark.parametrize("width", [13, 3, 30])
def test_repeated_words_of_nasty_rows(spark, nasty, nasty_table, width):
    found = recompression.substring_dedup(nasty_table, width, keep_text=True)
    assert set(found.columns) == set(nasty_table.columns) | {"n_removed", "kept_text"}
    rows = found.collect()
    assert by_row((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in rows) == by_row(brute.cut_words(nasty, width))
    assert sorted((r.row, r.shard) for r in rows) == [(k, "keep") for k in range(len(nasty))]
    for r in rows:
        assert (r.text or "").split(" ") and " ".join(w.decode() for w in brute.words(r.text)) == r.kept_text
        assert (r.text is None) == (nasty[r.row][1] is None)
        assert r.n_removed or r.text == nasty[r.row][1]


def test_equal_passages_have_equal_symbols_inside(spark):
    """Three levels; symbols decided within a passage are the same in each of its places, in any block."""
    import random

    rnd = random.Random(2)
    say = lambda n: [f"w{rnd.randrange(40)}" for _ in range(n)]
    passage = [*say(30), *["again"] * 5, *say(35)]
    texts = [" ".join([*say(20 + i), *passage, *say(30)]) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = recompression.symbol_levels(blocks.text_blocks(docs, buckets=2), 13, 3, 2).collect()
    assert len(rows) == 4
    inside: dict[int, list] = {}
    used = Counter()
    for row in rows:
        state = recompression.State.read(row.state)
        assert len(state.levels) == recompression.ROUNDS == 3
        assert len(state.words) >= 1.2 * len(state.levels[0].name) >= 1.4 * len(state.levels[1].name) >= 1.6 * len(state.levels[2].name)
        for s, (i, first, offset, size) in enumerate(zip(state.ident.tolist(), state.first().tolist(), state.at.tolist(), state.size.tolist())):
            at = first + 20 + i - offset
            if not offset <= 20 + i <= 20 + i + len(passage) <= offset + size:
                continue  # what lies around the passages may be left in pieces, or go
            for k, level in enumerate(state.levels):
                here = (level.stretch == s) & (level.begin >= at) & (level.end <= at + len(passage))
                found = [(b - at, e - at, n) for b, e, n in zip(level.begin[here].tolist(), level.end[here].tolist(), level.name[here].tolist())]
                assert found and recompression.ALONE not in [n for *_, n in found]
                inside.setdefault(k, []).append(found)
        start, stretch, symbol = recompression.represented(state, 13)
        used.update(zip((start - state.first()[stretch] + state.at[stretch] - 20 - state.ident[stretch]).tolist(), symbol.tolist()))
    assert all(len(found) == 12 and f == found[0] for found in inside.values() for f in found)
    places = {p for p, _ in used if 0 <= p <= len(passage) - 13}
    assert len(places) == len(passage) - 12  # every window of the passage is kept, under one symbol
    assert all(used[p, s] == 12 for p, s in used if p in places)
    assert len({s for p, s in used if p in places}) < 0.5 * len(places)


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(recompression, "runs_of", lambda words, width: np.zeros(max(0, len(words) - width + 1), dtype=np.uint64))
    words = np.array([1, 2, 3, 4, 1, 2, 3, 5, 2, 3, 4], dtype=np.int64)  # passages of 4, 4 and 3 words
    symbol, least, n = np.array([7, 7, 7], dtype=np.uint64), np.array([30, 20, 10]), np.array([2, 2, 1])
    assert recompression.smallest_documents(symbol, least, n, words, 3).tolist() == [20, 10, 20, 20, 10]


@pytest.mark.parametrize("length", [100, 81])
def test_repeated_bytes_of_nasty_rows(spark, nasty, nasty_table, length, monkeypatch):
    found = suffixes.suffix_dedup(nasty_table, length)
    rows = found.collect()
    unique = [i for i, _ in nasty if i is None or sum(i == j for j, _ in nasty) == 1]
    mine = by_row((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)
    assert mine == by_row(brute.cut_bytes(nasty, length))
    assert unique and sorted(r.row for r in rows) == list(range(len(nasty)))


def test_hot_anchors_and_long_texts_are_split(spark, nasty, nasty_table, monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", 1)
    monkeypatch.setattr(suffixes, "PIECE_BYTES", 700)
    monkeypatch.setattr(suffixes, "SORT_BYTES", 500)
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 3000)
    for module in (suffixes, blocks):
        cloudpickle.register_pickle_by_value(module)
    try:
        rows = suffixes.suffix_dedup(nasty_table, 100).collect()
    finally:
        for module in (suffixes, blocks):
            cloudpickle.unregister_pickle_by_value(module)
    assert by_row((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows) == by_row(brute.cut_bytes(nasty, 100))


def test_longest_previous_factors():
    """Every suffix's factor against brute force, over random, periodic and repeated bytes."""
    rng = np.random.default_rng(1)
    for length in (16, 17, 24, 40, 64, 100, 130):
        for letters, kind in ((1, "x"), (2, "twice"), (3, "x"), (200, "twice")):
            data = rng.integers(0, letters, 330, dtype=np.uint8)
            if kind == "twice":
                data[165:] = data[:165]
            starts = np.flatnonzero(rng.random(len(data) - length + 1) < 0.8)
            wanted = []
            for k, i in enumerate(starts.tolist()):
                agree = [np.append(data[i : i + length] == data[j : j + length], False).argmin() for j in starts[:k].tolist()]
                wanted.append(max(map(int, agree), default=0))
            assert factors.factors(data, length, starts).tolist() == wanted


def test_nearest_smaller_places():
    for values in (np.random.default_rng(2).permutation(500), np.arange(50), np.arange(50)[::-1], np.array([], dtype=int)):
        v = values.tolist()
        assert factors.previous_smaller(values).tolist() == [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]
        assert factors.next_smaller(values).tolist() == [min((j for j in range(i + 1, len(v)) if v[j] < v[i]), default=-1) for i in range(len(v))]


def test_empty_tables(spark, empty_table):
    assert jaccard.jaccard_components(empty_table).count() == 0
    assert recompression.substring_dedup(empty_table).count() == 0
    assert suffixes.suffix_dedup(empty_table).count() == 0


def test_queries_on_documents(spark, sf_dir, documents):
    digest = lambda data: hashlib.sha256(data).hexdigest()
    component = brute.jaccard_components(documents, 4, 85)
    links = brute.jaccard_links(documents, 4, 85)
    wanted = [(i, len(brute.shingle_set(t, 4)), component[i], n) for (i, t), n in zip(documents, links)]
    assert by_row(queries.op3_ngram_jaccard_join(spark, sf_dir).collect()) == by_row(wanted)
    wanted = [(i, n, m, digest(k.encode())) for i, n, m, k in brute.cut_words(documents, 13)]
    assert by_row(queries.op5_substring_dedup(spark, sf_dir).collect()) == by_row(wanted)
    wanted = [(i, n, m, s, digest(k)) for i, n, m, s, k in brute.cut_bytes(documents, 100)]
    assert by_row(queries.op8_suffix_array_dedup(spark, sf_dir).collect()) == by_row(wanted)


def written_by(spark, run):
    """The kinds of folders that ``run`` leaves below the checkpoint folder."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    run()
    names = [p.name for p in set(folder.iterdir()) - before]
    return sorted(n[:-33] for n in names if re.search(r"[-_][0-9a-f]{32}$", n))


def test_scratch_goes_when_marks_are_written(spark, nasty_table):
    assert written_by(spark, lambda: recompression.substring_dedup(nasty_table).count()) == ["marks", "text_blocks"]
    assert spark.conf.get(CLEANUP) == "false"


def test_only_ids_stay_of_the_search_for_representatives(spark, nasty_table):
    assert written_by(spark, lambda: jaccard.representatives(nasty_table).count()) == ["again", "components", "later"]


def test_representatives_by_broadcast_and_by_shuffle(spark, nasty_table, monkeypatch):
    """Few ids go to the texts, which stay in place, whatever Spark's own threshold; the rows are the same."""
    docs = nasty_table.dropDuplicates(["doc_id", "text"])
    rows = []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most, joins in ((jaccard.BROADCAST_IDS, "BroadcastHashJoin"), (0, "SortMergeJoin")):
            monkeypatch.setattr(jaccard, "BROADCAST_IDS", most)
            left = jaccard.representatives(docs)
            rows.append(by_row(left.collect()))
            assert joins in left._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows[0] == rows[1]


def test_texts_are_not_shuffled_for_lists_of_ids(spark, nasty_table):
    docs = nasty_table.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = jaccard.representatives(docs)
        assert "Exchange hashpartitioning" not in left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Texts of many slices, blocks and shards at once: results cover their whole length."""

import hashlib
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest

from tallyforge.llm import chat, collocations, cotraining, decontamination, jaccard, langid, packing, queries, recompression, resampling, rules, secretscan, sharding, suffixes

ITEM = "one question that only the benchmark asks about a rare and very particular thing"


@pytest.fixture(scope="module")
def long_texts():
    """(doc_id, text): over a million characters, the telling parts at the end; a copy; short ones."""
    rnd = random.Random(6)
    words = ["".join(rnd.choices("abcdefghiklmnoprstuvé", k=rnd.randrange(2, 9))) for _ in range(4000)]
    body = " ".join(rnd.choices(words, k=190_000)).replace(words[7], words[7] + ".\n")
    long = f"{body} {ITEM} password=tail-of-the-text1"
    return [(1, long), (2, "x " + long), (3, "a short text, of a few words"), (4, ITEM), (5, None)]


@pytest.fixture(scope="module")
def table(spark, long_texts):
    rows = [(i, t, "aa" if i < 3 else "bb", "s") for i, t in long_texts]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)


def test_they_are_long(long_texts):
    assert len(long_texts[0][1]) > 1 << 20


def test_sharding(table, long_texts):
    rows = sharding.sharded(table, 2).collect()
    assert {(r.doc_id, r.text) for r in rows} == set(long_texts) and {r["size"] - 16 for r in rows} == {len((t or "").encode()) for _, t in long_texts}


def test_chat(spark, long_texts):
    turns = [(7, k, "assistant" if k % 2 else "user", t) for k, (_, t) in enumerate(long_texts)]
    [row] = chat.read_back(chat.format_conversations(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))).collect()
    assert row.turns_sha256 == brute.turns_digest([(r, t) for _, _, r, t in turns])
    loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
    assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_pairs_and_repeats(table, long_texts):
    found = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.jaccard_components(table).collect()}
    assert found[1] == found[2] == (1, 1) and found[3] == (3, 0)
    wanted = {(i, n, m) for i, n, m, _ in brute.cut_words(long_texts, 13)}
    assert {(r.doc_id, r.n_words, r.n_removed) for r in recompression.substring_dedup(table).collect()} == wanted
    rows = {r.doc_id: r for r in suffixes.suffix_dedup(table).collect()}
    assert bytes(rows[2].kept) in (b"x ", b"x") and rows[2].n_spans == 1 and rows[1].n_removed < 2000 and rows[4].n_removed == 0


def test_leaks(spark, table):
    benchmark = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    found = {r.doc_id: (r.similarity, r.start) for r in decontamination.leaks(table, benchmark).collect()}
    assert found == {1: (1.0, 190_000), 2: (1.0, 190_001), 4: (1.0, 0)}


def test_tokens(table, long_texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    pieces = sorted((r.doc_id, r.start, bytes(r.ids)) for r in packing.pack(table, queries.tokenizer_path()).collect())
    for i, t in long_texts:
        ids = np.frombuffer(b"".join(p for d, _, p in pieces if d == i), "<u4").tolist()
        assert ids == library.encode(t or "", add_special_tokens=False).ids + [packing.END]


def test_measures(table, long_texts):
    rows = {r.doc_id: r for r in rules.quality_rules(table).collect()}
    found = {r.doc_id: r for r in secretscan.secret_scan(table).collect()}
    for i, t in long_texts:
        words = (t or "").split()
        assert rows[i].n_words == len(words) and rows[i].word_chars == sum(map(len, words))
        assert found[i].n_assign == ("password" in (t or ""))
    end = len(long_texts[0][1])
    assert found[1].base_spans == f"assign:{end - 26}:{end}"


def test_models(spark, table):
    rows = {r.doc_id: r.lang_pred for r in langid.language_id(table).collect()}
    assert rows[5] == "und" and {rows[1], rows[2]} <= {"aa", "bb"}
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in cotraining.quality_classifier(table, labels).collect()}
    assert scores[5] == 0 and min(scores[1], scores[2]) > scores[3]


def test_features_and_phrases(spark, table, long_texts):
    kind = resampling.Features()
    weighted = resampling.importance_weights(table, spark.createDataFrame([(ITEM,)], "text string"), kind)
    counts = resampling.bucket_counts(table, "text", kind)
    wanted = Counter(zlib.crc32(w) % 10_000 for _, t in long_texts for w in (t or "").encode().replace(b".", b" ").replace(b"=", b" ").replace(b"-", b" ").replace(b",", b" ").split())
    assert {b: int(n) for b, n in enumerate(counts) if n} == wanted
    assert {r.doc_id: r.n_features for r in weighted.collect()}[4] == len(ITEM.split())
    found = collocations.collocations(table, min_count=2, top=10**6, shard_bytes=100_000)
    phrases = {(r.lang, r.phrase): r.a for r in found.where("lang = 'aa'").collect()}
    assert phrases["aa", "rare and very particular thing"] == 2

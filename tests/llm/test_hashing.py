import random

import numpy as np

from tallyforge.llm import symbols, wordhash
from tallyforge.llm.common import free_name
from tallyforge.llm.components import components


def test_words_are_those_of_bytes_split(monkeypatch):
    rnd = random.Random(1)
    for chunk in (7, 50, 1 << 19):
        monkeypatch.setattr(wordhash, "CHUNK", chunk)
        for n in (0, 1, 9, 3000):
            data = bytes(rnd.choice(b"ab \n\t\r\x0b\x0c\xc3\xa9") for _ in range(n))
            hashes, starts, ends = wordhash.hash_words(data)
            assert [data[a:b] for a, b in zip(starts, ends)] == data.split()
            by_word = dict(zip(data.split(), hashes.tolist()))
            assert hashes.tolist() == [by_word[w] for w in data.split()]
            assert len(set(by_word.values())) == len(by_word)


def test_hashes_do_not_depend_on_place():
    words, first = wordhash.word_arrays([b"some words here", b"", b"and some words here"])
    assert first.tolist() == [0, 3, 3, 7]
    assert words[0:3].tolist() == words[4:7].tolist()


def test_packed_numbers_come_back():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64))
    assert (wordhash.from_steps(wordhash.steps(values)) == values).all()
    assert wordhash.from_steps(wordhash.steps(values[:0])).size == 0


def test_components(spark):
    rnd = random.Random(5)
    links = [(i, i + 1) for i in range(0, 400)]  # a long path
    links += [(1000, i) for i in range(1001, 1400)]  # a star
    links += [(rnd.randrange(2000, 2200), rnd.randrange(2000, 2200)) for _ in range(150)]
    rnd.shuffle(links)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    table = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = dict(map(tuple, components(table).collect()))
    assert found == {x: find(x) for x in parent if find(x) != x}
    assert components(table.limit(0)).count() == 0


def test_free_name(spark):
    assert free_name(spark.createDataFrame([(1, 2)], "x int, X_ int"), "x") == "x__"


def test_distinct_words_of_any_hash(monkeypatch):
    """Words are told apart by their bytes, also when nearly all have one hash."""
    rng = np.random.default_rng(8)
    words = [bytes(rng.choice([0, 97, 98, 255], int(n)).astype(np.uint8)) for n in rng.choice([1, 2, 7, 8, 9, 16, 17, 64, 65, 80], 60)]
    words += [b"x" * 70, b"x" * 71, b"x" * 70 + b"y", b"x" * 70 + b"z"]
    texts = [b" ".join(words[i] for i in rng.integers(0, len(words), n)) for n in (0, 1, 40, 300, 0)] + [b" \t", b"a\n"]
    split = [t.split() for t in texts]
    hash_words = wordhash.hash_words
    for most in (2**63, 3):
        monkeypatch.setattr(wordhash, "hash_words", lambda data: (hash_words(data)[0] % np.uint64(most), *hash_words(data)[1:]))  # noqa: B023
        found = symbols.Words.of_texts(texts, 5)
        distinct = found.joined.split(b"\n")[:-1]
        assert sorted(distinct) == sorted(set(sum(split, [])))
        assert [distinct[i] for i in found.of] == sum(split, [])
        assert found.text.tolist() == [i for i, t in enumerate(split) for _ in t]
        assert found.many.tolist() == [min(2, sum(w in t for t in split)) for w in distinct]
        assert len(found.cuts) == 6 and found.cuts[-1] == len(distinct)
    assert len(symbols.Words.of_texts([], 5).of) == len(symbols.Words.of_texts([b"", b" "], 5).many) == 0

import os
import random
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.join(os.path.dirname(os.path.dirname(HERE)), "tools")]

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the small documents table."""
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nasty():
    """(doc_id, text): nulls, empty and blank texts, copies, near copies, shared passages, long runs."""
    rnd = random.Random(3)
    vocabulary = ["a", "of", "the", "é", "Übung", "x<|y", "　", "word"] + [f"w{i}" for i in range(60)]
    say = lambda n: " ".join(rnd.choices(vocabulary, k=n))
    passage, long = say(70), say(3000)
    near = say(200).split()
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "one"), (5, "One two"), (6, "the " * 300), (7, "the " * 41)]
    rows += [(10 + i, say(30) + "\n" + passage + "\n" + say(25)) for i in range(6)]
    rows += [(20 + i, long if i < 3 else long + " end") for i in range(4)]
    for i in range(12):
        other = list(near)
        other[(17 * i) % 200] = f"edit{i}"
        rows.append((40 + i, " ".join(other)))
    rows += [(60, passage), (60, passage), (61, say(40)), (61, say(40)), (None, passage), (None, long), (-5, passage + " tail")]
    rows += [(70 + i, say(rnd.randrange(1, 120))) for i in range(25)]
    rows += [(100, "ab" * 400), (101, "zzz" + "ab" * 300), (102, "abc" * 200 + "é" * 150), (103, "é" * 200)]
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def nasty_table(spark, nasty):
    """The same with extra columns named like results and helpers."""
    rows = [(i, t, "en", "s", None, k, "keep", k % 3 == 0) for k, (i, t) in enumerate(nasty)]
    schema = "doc_id long, text string, lang string, source string, n_words int, row int, shard string, kept boolean"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty_table(nasty_table):
    return nasty_table.limit(0)

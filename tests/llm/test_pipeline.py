import brute
import pytest

import corpus_pipeline
from tallyforge.llm import queries
from tallyforge.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage got and gave."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, sf_dir), name)
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_are_the_five():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "packing",
    ]


def test_all_but_the_last_return_documents(stages):
    for name, (docs, result) in list(stages.items())[:-1]:
        assert result.dtypes == docs.dtypes, name


def test_quality(spark, sf_dir, stages):
    docs, result = stages["quality_classifier"]
    gone = set(texts(docs)) - set(texts(result))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    bad = {i for i, q in labels.items() if q == 0}
    assert len(bad & gone) >= 0.7 * len(bad) and not gone & {i for i, q in labels.items() if q == 1}


def test_one_of_each_group_stays(stages):
    docs, result = stages["ngram_jaccard_join"]
    component = brute.jaccard_components(list(texts(docs).items()), 5, 80)
    assert texts(result) == {i: t for i, t in texts(docs).items() if component[i] == i}


def test_repeats_are_cut(stages):
    docs, result = stages["substring_dedup"]
    left = texts(result)
    for i, n, removed, kept in brute.cut_words(list(texts(docs).items()), corpus_pipeline.REPEAT_WORDS):
        if n and removed == n:
            assert i not in left
        else:
            assert " ".join(w.decode() for w in brute.words(left[i])) == kept
    assert all(r.n_chars == len(r.text) for r in result.collect())


def test_leaking_documents_go(spark, sf_dir, stages):
    docs, result = stages["benchmark_decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(docs), texts(result)
    whole = lambda t: " ".join(t.lower().split())
    holds = {i for i, t in before.items() if any(whole(x) in whole(t) for _, x in items)}
    assert not holds & set(after)
    suspects = [(i, t) for i, t in before.items() if i not in after]
    assert {d for d, _ in brute.leaks(suspects, items)} == {i for i, _ in suspects}


def test_all_tokens_are_packed(stages):
    docs, result = stages["packing"]
    rows = result.collect()
    total = {r.doc_id: r.doc_tokens for r in rows}
    assert set(total) == set(texts(docs))
    assert sum(r.length for r in rows) == sum(total.values())


def test_nasty_documents_pass(spark, sf_dir, nasty_table):
    docs = nasty_table.withColumn("n_chars", nasty_table["row"].cast("long")).withColumnRenamed("kept", "accepted")
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert result.columns == docs.columns
        docs = result


@pytest.fixture(scope="module")
def con(sf_dir):
    import check_oracle

    return check_oracle.oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    import check_oracle

    assert check_oracle.compare(spark, con, sf_dir, name, queries.QUERIES[name], queries.SQL[name]) == ""

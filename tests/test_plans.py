"""The physical plans the operators are written for."""

import re

import pytest
from pyspark.sql import functions as F

from tallyforge import scale
from tallyforge.operators import keyvalue, pageviews, social, songs, textmodels
from tallyforge.plans import tables as t

SF_DIR = "/root/testdata/sf0.001"


def plan(df, run=False):
    execution = df._jdf.queryExecution()
    if run:
        execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(n, None) for n in names]
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, old in zip(names, before):
        spark.conf.unset(n) if old is None else spark.conf.set(n, old)


def test_scan_reads_only_needed_columns(spark):
    text = plan(pageviews.total_views(t.pagecounts(spark, SF_DIR)))
    assert re.search(r"ReadSchema: struct<value:double>", text)


def test_filter_reaches_the_scan(spark):
    df = songs.column_contains(t.table(spark, SF_DIR, "supplier"), "s_name", "0001")
    assert "StringContains(s_name,0001)" in plan(df)


def test_article_filter_stays_in_generated_code(spark):
    text = plan(t.articles(spark, SF_DIR))
    assert "RLIKE" not in text and re.search(r"\*\(1\) Filter", text)


def test_stored_tables_are_read_in_place(spark, no_broadcast, tmp_path):
    path = scale.new_path(spark, "t-est")
    left = scale.stored_by(spark.range(1000), path, ["id"], 5)
    joined = left.join(spark.range(500).repartition(5, "id").hint("shuffle_hash"), "id")
    text = plan(joined)
    assert text.count("Exchange") == 1 and "Sort [" not in text and joined.count() == 500
    scale.remove(spark, path)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("t_est")]


def test_counting_once_in_tfidf(spark):
    final = plan(textmodels.tfidf(t.titled_docs(spark, SF_DIR)).select("word"), run=False)
    assert "Union" in final
    df = textmodels.tfidf(t.titled_docs(spark, SF_DIR))
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    whole = execution.executedPlan().toString()
    assert whole.count("ReusedExchange [word") >= 3


def test_next_word_reads_the_counts_once(spark, no_broadcast):
    counts = textmodels.min_count_prune(textmodels.ngram_count(t.lines(spark, SF_DIR)))
    text = plan(textmodels.next_word_prob(counts), run=True)
    assert "ReusedExchange [phrase" in text


def test_language_model_has_one_exchange_after_the_count(spark):
    text = plan(textmodels.language_model(t.lines(spark, SF_DIR)))
    assert text.count("Exchange hashpartitioning") == 3
    assert "WindowGroupLimit" in text and "Join" not in text


def test_top_one_needs_no_sort(spark):
    assert "TakeOrderedAndProject" in plan(pageviews.most_popular(t.daily(spark, SF_DIR)))
    assert "TakeOrderedAndProject" in plan(songs.nth_group(t.songs(spark, SF_DIR), ["artist_id"]))


def test_range_lookup_is_an_equi_join(spark, no_broadcast):
    requests = t.table(spark, SF_DIR, "orders").select(F.col("o_custkey").alias("id"))
    text = plan(keyvalue.range_lookup(requests, t.targets(spark, SF_DIR)))
    assert "SortMergeJoin [block" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_no_python_workers(spark):
    for df in (t.ngram_counts(spark, SF_DIR), textmodels.tfidf(t.titled_docs(spark, SF_DIR))):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_day_axis_shares_the_daily_exchange(spark):
    df = pageviews.longest_increasing_run(t.daily(spark, SF_DIR))
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    assert "ReusedExchange [title" in execution.executedPlan().toString()


@pytest.fixture
def small_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, old in before.items():
        spark.conf.unset(k) if old is None else spark.conf.set(k, old)


def _hot(spark, n=400_000):
    """A third of the rows under one key, written by several tasks."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("key"), F.col("id").alias("row")
    )


def test_hot_track_is_split_by_the_join(spark, small_skew_limits):
    sales = _hot(spark).selectExpr("cast(key as string) as track_id", "row as sales_count")
    catalog = spark.range(5000).selectExpr("cast(id as string) as track_id", "uuid() as title")
    for how in ("inner", "left"):
        assert "skew=true" in plan(songs.join_sales_songs(sales, catalog, how), run=True)


def test_popular_user_is_looked_up_by_the_feed_join(spark, small_skew_limits):
    """The profiles were joined by user before, which the adaptive skew join cannot split."""
    follows = _hot(spark).selectExpr("row as userid", "key as followed")
    users = spark.range(5000).selectExpr("id as userid", "uuid() as username", "uuid() as password")
    images = spark.range(5000).selectExpr("id as userid", "uuid() as time", "uuid() as url")
    text = plan(social.feed_join(follows, users, images, min_rows=50_000))
    assert "Union" in text and "BroadcastHashJoin [followed" in text


def test_hot_requester_is_split_by_the_credential_join(spark, small_skew_limits):
    asked = _hot(spark).selectExpr("key as userid", "'p' as password", "row as request")
    users = spark.range(5000).selectExpr("id as userid", "uuid() as username", "'p' as password")
    assert "skew=true" in plan(social.credential_join(asked, users), run=True)


def test_feed_is_joined_once(spark, monkeypatch):
    """What runs before the feed's own job looks at the follow table alone."""
    looked_at = []
    plain = scale.heavy_keys

    def noted(df, *args, **options):
        looked_at.append(plan(df))
        return plain(df, *args, **options)

    feed = social.feed_join(t.follows(spark, SF_DIR), t.userinfo(spark, SF_DIR), t.userimage(spark, SF_DIR))
    monkeypatch.setattr(scale, "heavy_keys", noted)
    social.feed_json(feed, 3, t.userinfo(spark, SF_DIR), t.follows(spark, SF_DIR))
    assert len(looked_at) == 1 and "Join" not in looked_at[0]

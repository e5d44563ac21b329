"""Small inline inputs for the rules the shared fixtures cannot show."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import predicates, text
from tallyforge.operators import graph, keyvalue, loadtest, pageviews, social, songs, textmodels

D = dt.date


@pytest.fixture(scope="module")
def daily(spark):
    def views(title, *counts):
        return [(title, D(2024, 1, 1) + dt.timedelta(days=i), n) for i, n in enumerate(counts) if n is not None]

    return spark.createDataFrame(
        views("open", 5, 1, 2, 3) + views("shut", 1, 2, 1, 1) + views("gap", None, 7, None, 7) + views("late", None, 1, 1, 1),
        "title string, day date, views long",
    )


@pytest.mark.parametrize(
    "title, kept",
    [
        ("Talk:Page", False), ("Talkative", True), ("Talk", True), ("User_talk:X", False), ("Userland:X", True),
        ("lower", False), ("Élan", True), ("1999", True), ("", False), ("A.jpg", False), ("A.JPG", False),
        ("A.Jpg", True), ("A.jpg.old", True), ("A.txt", False), (".ico", False), ("Main_Page", False),
        ("Main_Page2", True), ("404_error/", False), ("404_error", True), ("Search", False), ("Search:", True),
        ("jpg", False), ("Xjpg", True), ("Special:Search", False), ("Help:A:B", False), ("A:Help:B", True),
    ],
)
def test_is_article(spark, title, kept):
    df = spark.createDataFrame([(title,)], "title string").where(predicates.is_article("title"))
    assert (df.count() == 1) is kept


def test_filter_articles_project_is_exact(spark):
    counts = spark.createDataFrame([("en", "A", 1), ("en.b", "A", 2), ("EN", "A", 3)], "project string, title string, views long")
    assert [r["views"] for r in pageviews.filter_articles(counts).collect()] == [1]


def test_runs(daily, rows):
    # "open" rises 1, 2, 3 up to the last day; "gap" reads 0, 7, 0, 7.
    assert rows(pageviews.rising_runs(daily)) == [("gap", 2), ("late", 2), ("open", 3), ("shut", 2)]
    assert rows(pageviews.longest_increasing_run(daily)) == [(3, 1)]
    assert rows(pageviews.longest_increasing_run(daily, drop_open_run=True)) == [(2, 3)]
    open_run = pageviews.rising_runs(daily, drop_open_run=True).where("title = 'open'")
    assert rows(open_run) == [("open", 1)]
    days = [D(2024, 1, 1), D(2024, 1, 2)]
    assert rows(pageviews.longest_increasing_run(daily, days=days)) == [(2, 3)]


def test_dense_days(daily, rows):
    gap = pageviews.dense_days(daily).where("title = 'gap'")
    assert [r[2] for r in rows(gap)] == [0, 7, 0, 7]
    assert pageviews.dense_days(daily, [D(2024, 1, 1)]).count() == 4


def test_stray_dates_and_repeated_days(spark, daily, rows):
    stray = daily.unionByName(spark.createDataFrame([("odd", D(1, 1, 1), 5)], daily.schema))
    with pytest.raises(Exception, match="name the days to report"):
        pageviews.dense_days(stray).count()
    assert pageviews.dense_days(stray, [D(2024, 1, 1)]).count() == 5
    twice = daily.unionByName(daily)
    doubled = daily.withColumn("views", daily["views"] * 2)
    assert rows(pageviews.dense_days(twice)) == rows(pageviews.dense_days(doubled))


def test_peak_takes_the_earliest_day(daily, rows):
    assert rows(pageviews.peak_day(daily, "gap")) == [("gap", D(2024, 1, 2), 7)]
    assert rows(pageviews.days_a_beats_b(daily, "open", "gap")) == [(2,)]
    assert rows(pageviews.days_a_beats_b(daily, "open", "nobody")) == [(4,)]
    assert rows(pageviews.top_with_zero_first_day(daily)) == [("gap", 14)]


def test_ranks_count_absent_titles_as_zero(spark, daily, rows):
    titles = spark.createDataFrame([("absent",), ("gap",), ("open",), ("gap",)], "title string")
    assert rows(pageviews.rank_by_total(daily, titles)) == [(1, "gap", 14), (2, "open", 11), (3, "absent", 0)]
    assert rows(pageviews.rank_by_peak(daily, titles)) == [(1, "gap", 7), (2, "open", 5), (3, "absent", 0)]


def test_thresholds_are_strict(daily, rows):
    assert rows(pageviews.having_total(daily, 11)) == [("gap", 14)]
    assert rows(pageviews.count_over(daily, 5)) == [(2,)]
    assert rows(pageviews.max_views(daily, "ga")) == [(7,)]
    assert rows(pageviews.max_views(daily, "none")) == [(None,)]


def test_month_total_is_the_sum_of_days(daily, rows):
    dense = pageviews.dense_days(daily).groupBy("title").agg(F.sum("views").alias("total"))
    assert rows(dense) == rows(pageviews.month_total(daily))


def test_packed_score(spark, rows):
    packed = spark.createDataFrame(
        [("a", "2021-06-02,100,100,100;2021-06-03,1,5,2;2022-01-09,2,3,9;2022-01-10,100,100,100"), ("b", "2013-01-01,1,1,1")],
        "id string, packed string",
    )
    assert rows(pageviews.packed_score(packed, "2021-06-03", "2022-01-09")) == [("a", 3 + 5 + 9), ("b", 0)]


def test_drop_bad_numbers(spark, rows):
    df = spark.createDataFrame([("1",), ("x",), ("1.5",), ("",), ("-3",), (None,)], "n string")
    assert rows(pageviews.drop_bad_numbers(df, "n")) == [(-3,), (1,)]


def test_average_blanks(spark, rows):
    df = spark.createDataFrame([(2.0,), (4.0,), (None,)], "d double")
    assert rows(songs.average(df, "d")) == [(3.0,)]
    assert rows(songs.average(df, "d", blanks_as_zero=True)) == [(2.0,)]


def test_song_searches(spark, rows):
    df = spark.createDataFrame(
        [("1", "The Beatles", None), ("2", "the beatles", "x"), ("3", None, "The Beatles live")],
        "track_id string, artist_name string, title string",
    )
    assert songs.grep_any_column(df, "The Beatles").count() == 2
    assert songs.like_any(df, ["artist_name", "title"], "%The Beatles%").count() == 2
    assert songs.like_any(df, ["artist_name", "title"], "%The Beatles%", ci=True).count() == 3
    assert songs.equals_ignore_case(df, "artist_name", "THE Beatles").count() == 2
    assert songs.column_contains(df, "artist_name", "The").count() == 1


def test_sales_joins(spark, rows):
    sales = spark.createDataFrame([("1", 60), ("1", 70), ("9", 80)], "track_id string, sales_count long")
    catalog = spark.createDataFrame(
        [("1", "A", "AR1", 3.0), ("2", "B", "AR2", 3.0)],
        "track_id string, artist_name string, artist_id string, duration double",
    )
    assert songs.join_sales_songs(sales, catalog).count() == 2
    assert songs.join_sales_songs(sales, catalog, "left").count() == 3
    assert rows(songs.songs_selling(catalog, sales).select("track_id")) == [("1",)]
    assert rows(songs.artist_sales(sales, catalog, "AR1")) == [(130,)]
    assert songs.max_rows(catalog, "duration").count() == 2
    assert rows(songs.top_artist(songs.join_sales_songs(sales, catalog))) == [("A", 130)]
    assert rows(songs.nth_group(catalog, ["artist_id"], 2)) == [("AR2", 1)]
    assert rows(songs.nth_group(catalog, ["artist_id"], 3)) == []


def test_clean_text_and_ngrams(spark, rows):
    df = spark.createDataFrame([("Don't  stop-NOW 42!",), ("42",), ("",)], "t string")
    cleaned = df.select(text.clean_text("t").alias("c"))
    assert [r["c"] for r in cleaned.collect()] == ["don t stop now", "", ""]
    grams = spark.createDataFrame([(["a", "b", "a"],), ([],)], "w array<string>").select(text.ngrams("w", 2).alias("g"))
    assert [sorted(r["g"]) for r in grams.collect()] == [["a", "a", "a b", "b", "b a"], []]
    assert rows(df.select(text.strip_tags(F.lit("<b>x</b>y")).alias("s")).limit(1)) == [(" x y",)]


def test_ngram_rows_are_the_phrases_of_each_line(spark, rows):
    lines = spark.createDataFrame([(1, "a b, A"), (2, "a b"), (2, "1"), (3, ""), (4, None)], "k int, value string")
    found = rows(textmodels.ngram_rows(lines, 2, keep=["k"]))
    assert found == [(1, "a b"), (1, "a"), (1, "a"), (1, "b a"), (1, "b"), (2, "a b"), (2, "a"), (2, "b")]


def test_ngram_rows_clean_each_line_once(spark):
    lines = spark.createDataFrame([("a b",)], "value string")
    plan = textmodels.ngram_rows(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1 and plan.count("Generate explode") == 2


def test_ngram_count_keeps_lines_apart_and_copies(spark, rows):
    lines = spark.createDataFrame([("a b",), ("a b",), ("A b!",), ("b a b c d e f",), ("1",), ("",)], "value string")
    counts = dict(rows(textmodels.ngram_count(lines)))
    assert counts["a b"] == 4 and counts["b"] == 5 and counts["b a"] == 1
    assert counts["b a b c d"] == 1 and "b a b c d e" not in counts and "" not in counts
    assert sum(counts.values()) == 3 * 3 + 7 + 6 + 5 + 4 + 3


def test_language_model_parts_agree(spark, rows):
    words = ["x y", "x y", "x y", "x z", "x z", "x z", "x w", "y"] * 2 + ["q r"] * 2
    lines = spark.createDataFrame([(w,) for w in words], "value string")
    model = {r["prefix"]: r["predictor"] for r in textmodels.language_model(lines, k=2).collect()}
    assert model == {"x": {"y": 0.43, "z": 0.43}}
    counts = textmodels.min_count_prune(textmodels.ngram_count(lines))
    parts = textmodels.model_wide(textmodels.top_k_next_word(textmodels.next_word_prob(counts), 2))
    assert {r["prefix"]: r["predictor"] for r in parts.collect()} == model
    probs = textmodels.next_word_prob(counts).groupBy("prefix").agg(F.sum(F.col("n") / F.col("base")).alias("p"))
    assert all(r["p"] <= 1 for r in probs.collect())


def test_word_count_keeps_case(spark, rows):
    lines = spark.createDataFrame([("  The the\tThe. ",), ("",)], "value string")
    assert rows(textmodels.word_count(lines)) == [("The", 1), ("The.", 1), ("the", 1)]


def test_tfidf_counts_letterless_documents(spark, rows):
    docs = spark.createDataFrame(
        [("a", "cloud<b>cloud</b>\\ncloud"), ("b", "rain cloud"), ("c", "123"), ("d", "rain")], "title string, text string"
    )
    term = {r["title"]: (r["tf"], r["df"], round(r["tfidf"], 6)) for r in textmodels.tfidf(docs, term="cloud").collect()}
    assert term == {"a": (3, 2, 0.90309), "b": (1, 2, 0.30103)}
    everything = textmodels.tfidf(docs).where("word = 'cloud'")
    assert rows(everything) == rows(textmodels.tfidf(docs, term="cloud"))
    tagged = spark.createDataFrame([("a", "x <cloud> y"), ("b", "sun")], "title string, text string")
    assert textmodels.tfidf(tagged, term="cloud").count() == 0
    assert [r["tf"] for r in textmodels.tfidf(tagged, term="cloud", strip_markup=False).collect()] == [1]
    three = docs.where("title <> 'd'")
    whole = {r["title"]: round(r["tfidf"], 6) for r in textmodels.tfidf(three, integer_idf=True).where("word = 'cloud'").collect()}
    assert whole == {"a": 0.0, "b": 0.0}


@pytest.fixture(scope="module")
def edges(spark):
    # 1 has no in-links, 4 has no out-links; the link 1 -> 2 occurs twice.
    return spark.createDataFrame([(1, 2), (1, 2), (2, 3), (3, 2), (3, 4)], "src long, dst long")


def test_graph_ends(edges, rows):
    assert rows(graph.dangling_pages(edges)) == [(4,)]
    assert rows(graph.sourceless_pages(edges)) == [(1,)]
    assert rows(graph.out_degree(edges)) == [(1, 1), (2, 1), (3, 2)]
    assert graph.all_pages(edges).count() == 4


def test_pagerank_first_round(edges):
    scores = {r["page"]: r["score"] for r in graph.pagerank(edges, rounds=1).collect()}
    dangling = 1 / 4
    assert scores == pytest.approx(
        {2: 0.15 + 0.85 * (1 + 0.5 + dangling), 3: 0.15 + 0.85 * (1 + dangling), 4: 0.15 + 0.85 * (0.5 + dangling)}
    )


def test_pagerank_mass(edges):
    total = graph.pagerank(edges, keep_sourceless=True).agg(F.sum("score")).first()[0]
    assert total == pytest.approx(4)
    leaking = graph.pagerank(edges)
    assert leaking.count() == 3 and leaking.agg(F.sum("score")).first()[0] < 4


def test_pagerank_bounds_the_links_of_a_task(spark, monkeypatch):
    class Stored(Exception):
        pass

    def stored_by(df, path, keys, buckets, dealt=False):
        raise Stored(buckets)

    monkeypatch.setattr(graph, "stored_by", stored_by)
    edges = spark.range(40_000_000).selectExpr("id % 1000000 as src", "id as dst")
    with pytest.raises(Stored) as found:
        graph.pagerank(edges)
    assert found.value.args[0] >= 40


def test_pagerank_without_links(spark):
    assert graph.pagerank(spark.createDataFrame([], "src long, dst long"), rounds=2).count() == 0


def test_pagerank_with_text_ids(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    assert {r["page"]: r["score"] for r in graph.pagerank(edges, rounds=2).collect()} == pytest.approx({"a": 1, "b": 1})


def test_dangling_mass_may_be_zero(spark, rows):
    ranks = spark.createDataFrame([(1, 0.5), (2, 0.5)], "page long, score double")
    edges = spark.createDataFrame([(1, 2), (2, 1)], "src long, dst long")
    assert rows(graph.dangling_mass(ranks, edges)) == [(0.0,)]


def test_feed_join_needs_an_image_not_a_name(spark, rows):
    follows = spark.createDataFrame([(1, 2), (1, 3), (1, 4)], "userid long, followed long")
    info = spark.createDataFrame([(1, "me", "p"), (2, "two", "p")], "userid long, username string, password string")
    images = spark.createDataFrame([(2, "t", "u2"), (3, "t", "u3")], "userid long, time string, url string")
    assert rows(social.feed_join(follows, info, images)) == [(1, 2, "two", "t", "u2"), (1, 3, None, "t", "u3")]


def test_credentials(spark, rows):
    info = spark.createDataFrame([(1, "me", "p")], "userid long, username string, password string")
    asked = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p"), (1, None)], "userid long, password string")
    assert sorted(r["name"] for r in social.credential_join(asked, info).collect()) == ["Unauthorized"] * 3 + ["me"]


def test_range_lookup_equals_range_join(spark, rows):
    requests = spark.createDataFrame([(i,) for i in (0, 5, 79, 80, 499, 500, 501, 620, 620)], "id long")
    targets = spark.range(700).select(F.col("id").alias("target_id"), F.lit("x").alias("line"))
    lo = F.expr("case when id < 500 then id else id - 79 end")
    plain = requests.distinct().join(targets, F.col("target_id").between(lo, lo + 79))
    found = keyvalue.range_lookup(requests, targets, split_at=500)
    assert rows(found.select("id", "target_id")) == rows(plain.select("id", "target_id"))


def test_point_lookup_list(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "target_id long, line string")
    assert rows(keyvalue.point_lookup(df, [2, 3], "target_id")) == [(2, "b")]


def test_alarm_needs_existing_periods(spark):
    start = dt.datetime(2024, 1, 1)
    rows_in = [(start + dt.timedelta(minutes=m), v) for m, v in [(0, 90.0), (1, 88.0), (2, 10.0), (4, 95.0), (5, 95.0), (6, 95.0)]]
    df = spark.createDataFrame(rows_in, "ts timestamp, cpu double")
    out = loadtest.alarm_consecutive(df, "ts", "cpu", 88, "60 seconds", 2).orderBy("period_start").collect()
    assert [r["alarm"] for r in out] == [False, True, False, False, True, True]
    low = loadtest.alarm_consecutive(df, "ts", "cpu", 10, "60 seconds", 1, below=True)
    assert low.where("alarm").count() == 1
    three = loadtest.alarm_consecutive(df, "ts", "cpu", 88, "60 seconds", 3)
    assert three.where("alarm").count() == 1


@pytest.fixture
def hot_phrases_at_once(monkeypatch):
    """Looks for hot phrases in small inputs, and finds many of them."""
    monkeypatch.setattr(textmodels, "PART_CHARS", 50)
    monkeypatch.setattr(textmodels, "HOT_CHARS", 20)


def _counted(lines, max_n=5):
    found = {}
    for line in lines:
        words = re.sub("[^a-z]+", " ", line.lower()).split()
        for i in range(len(words)):
            for k in range(1, min(max_n, len(words) - i) + 1):
                phrase = " ".join(words[i : i + k])
                found[phrase] = found.get(phrase, 0) + 1
    return sorted(found.items(), key=repr)


@pytest.mark.parametrize("hot_chars", [1, 10, 60, 8192])
def test_ngram_count_with_hot_phrases(spark, rows, monkeypatch, hot_chars):
    monkeypatch.setattr(textmodels, "PART_CHARS", 50)
    monkeypatch.setattr(textmodels, "HOT_CHARS", hot_chars)
    pick = random.Random(5)
    lines = [" ".join(pick.choice(["a", "ab", "a", "az", "b", "a b", "q7", "zebra"]) for _ in range(pick.randrange(9))) for _ in range(200)]
    lines += ["a a a a a a a a", "the same line of words"] * 30
    df = spark.createDataFrame([(x,) for x in lines] + [(None,)], "value string")
    assert bool(textmodels._layout(df, 5, "value")[1]) == (hot_chars > 1)
    assert rows(textmodels.ngram_count(df)) == _counted(lines)
    assert rows(textmodels.ngram_count(df, 2)) == _counted(lines, 2)


def test_ngram_count_moves_windows_not_phrases(spark):
    lines = spark.createDataFrame([("a b c d e f",)], "value string")
    plan = textmodels.ngram_count(lines)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Exchange hashpartitioning(phrase" not in plan
    assert plan.count("HashAggregate") == 2


def test_next_words_with_hot_phrases(spark, rows, hot_phrases_at_once):
    words = ["x y", "x y", "x y", "x z", "x z", "x z", "x w", "y", "x y z"] * 6
    lines = spark.createDataFrame([(w + " " + str(i),) for i, w in enumerate(words)], "value string")
    counts = dict(_counted(words))
    found = textmodels.next_word_prob(textmodels.min_count_prune(textmodels.ngram_count(lines)))
    want = [(*p.rsplit(" ", 1), n, counts[p.rsplit(" ", 1)[0]]) for p, n in counts.items() if " " in p]
    assert rows(found.select("prefix", "word", "n", "base")) == sorted(want, key=repr)

"""The heavy-key paths, forced by small thresholds, against the plain computation."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge import scale
from tallyforge.operators.graph import collect_neighbours, pagerank
from tallyforge.operators.keyvalue import asof_read, latest_by_key, point_lookup
from tallyforge.operators.pageviews import join_list
from tallyforge.operators.social import adjacency_line, feed_join, feed_json, feed_sort


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows of which key 0 holds a third."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.col("id").alias("n"),
    )


def test_heavy_keys_lists_only_the_hot_one(skewed, rows):
    assert rows(scale.heavy_keys(skewed, ["k"], min_rows=500)) == [(0,)]
    assert rows(scale.heavy_keys(skewed, ["k"])) == []


def test_heavy_keys_are_fewer_than_max_keys(skewed):
    for most in (1, 2, 10, 60):
        assert scale.heavy_keys(skewed, ["k"], min_rows=0, max_keys=most).count() < max(most, 2)


def test_position_numbers_all_rows(skewed, rows):
    placed = scale.with_position(skewed, [F.desc("k"), F.asc("n")])
    expected = skewed.withColumn("position", F.row_number().over(Window.orderBy(F.desc("k"), F.asc("n"))))
    assert rows(placed.select("k", "n", "position")) == rows(expected)


def test_pack_sorted_splits_the_hot_key_in_order(skewed, rows):
    packed = scale.pack_sorted(skewed, ["k"], ["n"], 300, min_rows=500)
    assert rows(packed) == rows(scale.pack_sorted(skewed, ["k"], ["n"], 300))
    hot = packed.where("k = 0").orderBy("part").collect()
    assert [len(r["items"]) for r in hot] == [300, 300, 300, 100]
    assert [r["part"] for r in hot] == [0, 1, 2, 3]
    assert [i["n"] for r in hot for i in r["items"]] == list(range(0, 3000, 3))
    assert packed.where("k <> 0 and part <> 0").count() == 0
    flat = packed.select("k", F.explode("items").alias("i")).select("k", "i.n")
    assert rows(flat) == rows(skewed)


def test_lists_are_bounded_whatever_counts_as_heavy(spark, rows):
    """Three keys of 1,000 rows, none of them above a share: lists of 10 all the same."""
    three = spark.range(3000).selectExpr("id % 3 as k", "id as n")
    packed = scale.pack_sorted(three, ["k"], ["n"], 10)
    assert {len(r["items"]) for r in packed.collect()} == {10} and packed.count() == 300
    numbered = scale.numbered(three, ["k"], ["n"], min_rows=100)
    assert rows(numbered) == rows(three.selectExpr("k", "n", "(n - k) div 3 as position"))
    assert rows(scale.numbered(three, ["k"], ["n"], min_rows=100, counted=three)) == rows(numbered)


def test_carry_forward_equals_one_window(skewed, rows):
    df = skewed.withColumn("put", F.when(F.xxhash64("n") % 40 == 0, F.col("n")))
    upto = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("value", F.last("put", True).over(upto))
    heavy = scale.carry_forward(df, ["k"], ["n"], "put", "value", min_rows=40)
    assert rows(heavy.select(*plain.columns)) == rows(plain)


def test_lookup_by_weight_equals_join(spark, skewed, rows):
    table = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    for most in (1, 3, 10, 1000):
        found = scale.lookup_by_weight(skewed, table, "k", "w", max_keys=most)
        assert rows(found.select("k", "n", "w")) == rows(skewed.join(table, "k").select("k", "n", "w"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_join_unique_equals_join(spark, skewed, rows, how):
    table = skewed.where("k <> 7").groupBy("k").agg(F.max("n").alias("top"))
    plain = skewed.join(table, "k", how)
    assert rows(scale.join_unique(skewed, table, ["k"], how, min_rows=500).select(*plain.columns)) == rows(plain)
    assert rows(scale.join_unique(skewed, table, ["k"], how).select(*plain.columns)) == rows(plain)


def test_feed_and_point_lookup_hot_key(spark, skewed, rows):
    follows = skewed.selectExpr("n as userid", "k as followed")
    users = spark.range(40).selectExpr("id as userid", "concat('u', id) as username", "'p' as password")
    images = spark.range(10, 51).selectExpr("id as userid", "'t' as time", "concat('i', id) as url")
    for pictures in (images, images.selectExpr("userid - 10 as userid", "time", "url")):
        plain = feed_join(follows, users, pictures)
        assert rows(feed_join(follows, users, pictures, min_rows=500)) == rows(plain)
    wanted = spark.createDataFrame([(0,), (3,), (3,)], "k long")
    assert rows(point_lookup(skewed, wanted, "k", min_rows=500)) == rows(skewed.where("k in (0, 3)"))


def test_asof_read_hot_key(spark, rows):
    log = spark.range(600).select(
        F.col("id").alias("seq"), (F.col("id") / 3).cast("int").cast("timestamp").alias("ts"),
        F.when(F.col("id") % 3 < 2, 1).otherwise(F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 4 == 0, "PUT").otherwise("GET").alias("op"),
    ).withColumn("v", F.when(F.col("op") == "PUT", F.col("seq") * 1.5))
    assert rows(asof_read(log, min_rows=20)) == rows(asof_read(log))


def test_latest_by_key_tie_on_time(spark, rows):
    log = spark.createDataFrame(
        [(1, 10, "a", "PUT", 1.0, 1), (2, 10, "a", "PUT", 2.0, 2), (3, 11, "a", "GET", None, 1)],
        "seq long, ts int, k string, op string, v double, loc int",
    )
    assert rows(latest_by_key(log)) == [("a", 2.0)]
    assert rows(latest_by_key(log, by_loc=True)) == [("a", 1, 1.0), ("a", 2, 2.0)]


def test_long_lists_get_parts(spark, rows):
    follows = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9)], "userid long, followed long")
    assert rows(adjacency_line(follows, 5)) == [(1, 0, "1\t0:1:2:3:4"), (2, 0, "2\t9")]
    assert rows(adjacency_line(follows, 2)) == [
        (1, 0, "1\t0:1"), (1, 1, "1\t2:3"), (1, 2, "1\t4"), (2, 0, "2\t9"),
    ]
    edges = follows.toDF("src", "dst").unionAll(follows.toDF("src", "dst"))
    assert rows(collect_neighbours(edges, 3)) == [(1, 0, [0, 1, 2]), (1, 1, [3, 4]), (2, 0, [9])]


def test_feed_parts(spark, rows):
    feed = spark.createDataFrame(
        [(1, "t2", "b", "u2"), (1, "t1", None, "u1"), (1, "t1", "a", "u0")],
        "userid long, time string, name string, url string",
    )
    parts = feed_sort(feed, 2).orderBy("part").collect()
    assert [[p["url"] for p in r["photos"]] for r in parts] == [["u1", "u0"], ["u2"]]
    owners = spark.createDataFrame([(1, "me"), (2, "other")], "userid long, username string")
    assert rows(feed_json(feed, 9, owners)) == [
        (1, 0, '{"name":"me","photos":[{"url":"u1","time":"t1","name":null},'
               '{"url":"u0","time":"t1","name":"a"},{"url":"u2","time":"t2","name":"b"}]}'),
        (2, 0, '{"name":"other","photos":[]}'),
    ]
    assert feed_json(feed, 2).count() == 2


def test_join_list_parts(spark, rows):
    ranked = spark.createDataFrame([(i + 1, f"t{i}") for i in range(5)], "rank long, title string")
    assert rows(join_list(ranked, 5)) == [(0, "t0,t1,t2,t3,t4")]
    assert rows(join_list(ranked, 2)) == [(0, "t0,t1"), (1, "t2,t3"), (2, "t4")]


def test_pagerank_with_sharded_hub(spark):
    hub = [(0, i) for i in range(1, 40)] + [(i, 0) for i in range(1, 20)] + [(50, 1)]
    edges = spark.createDataFrame(hub, "src long, dst long")
    plain = {r["page"]: r["score"] for r in pagerank(edges, rounds=3).collect()}
    sharded = {r["page"]: r["score"] for r in pagerank(edges, rounds=3, links_per_shard=4).collect()}
    assert plain.keys() == sharded.keys()
    assert all(abs(plain[p] - sharded[p]) < 1e-9 for p in plain)


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    """A session without spark.checkpoint.dir."""

    def __init__(self, master):
        self.sparkContext = _Context(master)
        self.conf = {}


def test_checkpoint_folder_is_temporary_only_on_a_local_master():
    local = _Session("local[2]")
    folder = scale.checkpoint_dir(local)
    assert folder and scale.checkpoint_dir(local) == folder == local.sparkContext.folder
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scale.checkpoint_dir(_Session(master))


def test_checkpoint_folder_comes_from_the_session(spark):
    assert scale.checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")

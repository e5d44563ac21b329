"""Social feed: follow lists, image imports, credential checks, feeds and their JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import friends_array as friends_of
from tallyforge.scale import HEAVY_ROWS, join_unique, pack_sorted

# Field and record separators of the import format.
FIELD_SEP = "\x03"
RECORD_SEP = "\x02"


def adjacency_line(follows: DataFrame, block_items: int) -> DataFrame:
    """``(userid, part, line)`` with line = ``userid TAB a:b:c``, followed ids ascending.

    Every line has ``block_items`` ids, but for the last of a user; lines are numbered by part.
    """
    packed = pack_sorted(follows, ["userid"], ["followed"], block_items)
    ids = F.array_join(F.col("items.followed").cast("array<string>"), ":")
    return packed.select("userid", "part", F.concat_ws("\t", F.col("userid").cast("string"), ids).alias("line"))


def friends_array(adjacency: DataFrame) -> DataFrame:
    """``(userid, part, friends)`` from adjacency lines, friends as an array of ``{userid}``."""
    return adjacency.select(
        "userid", "part", friends_of(F.substring_index("line", "\t", -1)).alias("friends")
    )


def typed_import_line(images: DataFrame) -> DataFrame:
    """Import lines ``url 0x03 {"s":...} 0x02 userid 0x03 {"n":...} 0x02 time 0x03 {"s":...}``."""

    def field(name: str, kind: str):
        value = F.to_json(F.struct(F.col(name).cast("string").alias(kind)))
        return F.concat(F.lit(name + FIELD_SEP), value)

    line = F.concat_ws(RECORD_SEP, field("url", "s"), field("userid", "n"), field("time", "s"))
    return images.select(line.alias("line"))


def credential_join(requests: DataFrame, userinfo: DataFrame) -> DataFrame:
    """The user name of each (userid, password) request, ``Unauthorized`` when they do not match."""
    known = userinfo.select("userid", "password", "username")
    joined = requests.join(known, ["userid", "password"], "left")
    return joined.withColumn("name", F.coalesce("username", F.lit("Unauthorized"))).drop("username")


def name_json(requests: DataFrame, userinfo: DataFrame) -> DataFrame:
    """``(request, doc)``: the name each login gets, as ``{"name":...}``."""
    named = credential_join(requests, userinfo)
    return named.select("request", F.to_json(F.struct("name")).alias("doc"))


def friends_json(adjacency: DataFrame) -> DataFrame:
    """``(userid, part, doc)``: ``{"friends":[{"userid":...},...]}`` for each adjacency line."""
    listed = friends_array(adjacency)
    return listed.select("userid", "part", F.to_json(F.struct("friends")).alias("doc"))


def image_json(userimage: DataFrame) -> DataFrame:
    """``(userid, doc)``: each user's own image as ``{"time":...,"url":...}``."""
    return userimage.select("userid", F.to_json(F.struct(F.col("time").cast("string").alias("time"), "url")).alias("doc"))


def requested_feed_json(requests: DataFrame, userinfo: DataFrame, documents: DataFrame) -> DataFrame:
    """``(request, userid, part, doc)``: the feed documents of each request that may see them.

    ``documents`` has (userid, part, doc).  A request with a wrong password gets the name
    ``Unauthorized`` and no photos.
    """
    named = credential_join(requests, userinfo).select("request", "userid", "name")
    allowed = named.where(F.col("name") != "Unauthorized")
    none = F.from_json(F.lit("[]"), "array<struct<url: string>>").alias("photos")
    refused = named.where(F.col("name") == "Unauthorized")
    return allowed.join(documents, "userid").select("request", "userid", "part", "doc").unionByName(
        refused.select("request", "userid", F.lit(0).cast("bigint").alias("part"), F.to_json(F.struct("name", none)).alias("doc"))
    )


def feed_join(
    follows: DataFrame, userinfo: DataFrame, userimage: DataFrame, min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """``(userid, followed, name, time, url)``: the image of everyone a user follows.

    Names and images are joined first, one row per user each, so the follow table is moved once;
    users followed by very many are looked up without moving their followers.
    Followed users without an image are left out; a missing name stays null.
    """
    profile = userimage.join(userinfo.select("userid", F.col("username").alias("name")), "userid", "left")
    profile = profile.select(F.col("userid").alias("followed"), "name", "time", "url")
    pairs = follows.select("userid", "followed")
    return join_unique(pairs, profile, ["followed"], min_rows=min_rows).select(
        "userid", "followed", "name", "time", "url"
    )


def feed_sort(feed: DataFrame, block_items: int, follows: DataFrame | None = None) -> DataFrame:
    """``(userid, part, photos)``: photos by time, name, url, ``block_items`` to a part.

    ``follows``, which the feed was joined from, tells how long a feed can be, and spares a run of
    the join to find that out.
    """
    packed = pack_sorted(feed, ["userid"], ["time", "name", "url"], block_items, counted=follows)
    return packed.withColumnRenamed("items", "photos")


def feed_json(
    feed: DataFrame, block_items: int, owners: DataFrame | None = None, follows: DataFrame | None = None
) -> DataFrame:
    """``(userid, part, doc)``: the sorted feed as JSON, ``block_items`` photos to a document.

    With ``owners`` (userid, username) the document also names its user, and a user without
    photos gets an empty list.
    """
    photo = lambda p: F.struct(p["url"].alias("url"), p["time"].cast("string").alias("time"), p["name"].alias("name"))
    photos = feed_sort(feed, block_items, follows).withColumn("photos", F.transform("photos", photo))
    keep_nulls = {"ignoreNullFields": "false"}
    if owners is None:
        return photos.select("userid", "part", F.to_json(F.struct("photos"), keep_nulls).alias("doc"))
    named = owners.select("userid", F.col("username").alias("name")).join(photos, "userid", "left")
    none = F.from_json(F.lit("[]"), photos.schema["photos"].dataType)
    body = F.struct("name", F.coalesce("photos", none).alias("photos"))
    return named.select(
        "userid", F.coalesce("part", F.lit(0)).alias("part"), F.to_json(body, keep_nulls).alias("doc")
    )

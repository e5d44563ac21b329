"""Registered catalogue and sales queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import songs as sg
from tallyforge.plans import tables as t
from tallyforge.plans.catalog import Catalog, rounded, text_days

SONG = "track_id, title, release, artist_id, artist_name, duration, artist_hotttnesss, year"
NAMES = ["title", "release", "artist_name"]


def per_track(s, d):
    return sg.join_sales_songs(sg.sales_per_track(t.sales(s, d)), t.songs(s, d))


def known_years(s, d):
    """Songs whose year is null where it is not known."""
    return t.songs(s, d).withColumn("year", F.nullif("year", F.lit(0)))


def relisted_songs(s, d):
    """Songs of known year; those of even years are listed a second time, under another release."""
    songs = t.songs(s, d).where("year <> 0").withColumn("listing", F.lit(1))
    again = songs.where("year % 2 = 0").withColumns({"release": F.concat(F.lit("again "), "release"), "listing": F.lit(2)})
    return songs.unionByName(again)


def register(c: Catalog) -> None:
    c.add(
        "grep_any_column",
        lambda s, d: sg.grep_any_column(t.songs(s, d), "Brand#2"),
        f"""select {SONG} from songs where contains(concat_ws(',', track_id, title, release, artist_id, artist_name,
        duration, artist_hotttnesss, year), 'Brand#2')""",
    )
    c.add(
        "column_contains",
        lambda s, d: sg.column_contains(t.songs(s, d), "artist_name", "00005"),
        f"select {SONG} from songs where contains(artist_name, '00005')",
    )
    c.add(
        "column_matches",
        lambda s, d: sg.column_matches(t.songs(s, d), "release", "brand#[12][3-5]$", ci=True),
        f"select {SONG} from songs where regexp_matches(release, 'brand#[12][3-5]$', 'i')",
    )
    c.add(
        "column_matches_cs",
        lambda s, d: sg.column_matches(t.songs(s, d), "artist_name", "^Supplier#0+[1-3]$"),
        f"select {SONG} from songs where regexp_matches(artist_name, '^Supplier#0+[1-3]$')",
    )
    c.add(
        "average_blanks",
        lambda s, d: rounded(sg.average(known_years(s, d), "year", blanks_as_zero=True), "average"),
        "select round(avg(cast(year as double)), 6) as average from songs",
    )
    c.add(
        "lookup_left_last",
        lambda s, d: text_days(sg.lookup_last(t.sales(s, d), relisted_songs(s, d), "listing"), "sale_date"),
        """select sa.track_id, cast(sa.sale_date as varchar) as sale_date, sa.sales_count, so.title,
        case when so.year % 2 = 0 then 'again ' || so.release else so.release end as release, so.artist_id, so.artist_name,
        so.duration, so.artist_hotttnesss, so.year from sales sa left join (select * from songs where year <> 0) so on so.track_id = sa.track_id""",
    )
    c.add(
        "range_and_threshold",
        lambda s, d: sg.range_and_threshold(t.songs(s, d), 1970, 1989, 0.3),
        f"select {SONG} from songs where year between 1970 and 1989 and artist_hotttnesss > 0.3",
    )
    c.add(
        "equals_ignore_case",
        lambda s, d: sg.equals_ignore_case(t.songs(s, d), "artist_name", "SUPPLIER#000000003"),
        f"select {SONG} from songs where lower(artist_name) = 'supplier#000000003'",
    )
    like = " or ".join(f"{n} {{op}} '%{{what}}%'" for n in NAMES)
    c.add(
        "like_any_cs",
        lambda s, d: sg.like_any(t.songs(s, d), NAMES, "%Brand#1%").agg(F.count("track_id").alias("n")),
        f"select count(track_id) as n from songs where {like.format(op='like', what='Brand#1')}",
    )
    c.add(
        "like_any_ci",
        lambda s, d: sg.like_any(t.songs(s, d), NAMES, "%bRAND#1%", ci=True).agg(F.count("track_id").alias("n")),
        f"select count(track_id) as n from songs where {like.format(op='ilike', what='bRAND#1')}",
    )
    joined = """select sa.track_id, cast(sa.sale_date as varchar) as sale_date, sa.sales_count, so.title, so.release,
        so.artist_id, so.artist_name, so.duration, so.artist_hotttnesss, so.year from sales sa {how} join {songs} so on so.track_id = sa.track_id"""
    c.add(
        "join_sales_songs",
        lambda s, d: text_days(sg.join_sales_songs(t.sales(s, d), t.songs(s, d)), "sale_date"),
        joined.format(how="inner", songs="songs"),
    )
    c.add(
        "lookup_left",
        lambda s, d: text_days(
            sg.join_sales_songs(t.sales(s, d), t.songs(s, d).where(F.col("year") != 0), how="left"), "sale_date"
        ),
        joined.format(how="left", songs="(select * from songs where year <> 0)"),
    )
    c.add(
        "semi_in_artist",
        lambda s, d: sg.artist_sales(t.sales(s, d), t.songs(s, d), "AR3"),
        """select cast(sum(sales_count) as bigint) as total_sales from sales
        where track_id in (select track_id from songs where artist_id = 'AR3')""",
    )
    c.add(
        "semi_in_sales",
        lambda s, d: sg.songs_selling(t.songs(s, d), t.sales(s, d), 49),
        f"select {SONG} from songs where track_id in (select track_id from sales where sales_count > 49)",
    )
    c.add(
        "scalar_max_rows",
        lambda s, d: sg.max_rows(t.songs(s, d), "duration").select("track_id", "duration"),
        "select track_id, duration from songs where duration = (select max(duration) from songs)",
    )
    c.add(
        "average",
        lambda s, d: rounded(sg.average(t.songs(s, d), "duration"), "average"),
        "select round(avg(duration), 6) as average from songs",
    )
    c.add(
        "sum_sales_artist",
        lambda s, d: sg.sum_sales_artist(per_track(s, d)),
        """select artist_id, max(artist_name) as artist_name, cast(sum(sales_count) as bigint) as sales
        from sales join songs using (track_id) group by artist_id""",
    )
    c.add(
        "group_count",
        lambda s, d: sg.group_count(t.songs(s, d), ["artist_id"], "artist_name"),
        "select artist_id, max(artist_name) as artist_name, count(*) as n from songs group by artist_id",
    )
    c.add(
        "nth_group",
        lambda s, d: sg.nth_group(t.songs(s, d).where(F.col("year") != 0), ["year"]),
        "select year, count(*) as n from songs where year <> 0 group by year order by n desc, year limit 1 offset 2",
    )
    c.add(
        "nth_group_artist",
        lambda s, d: sg.nth_group(t.songs(s, d), ["artist_id"], label="artist_name"),
        """select artist_id, max(artist_name) as artist_name, count(*) as n from songs
        group by artist_id order by n desc, artist_id limit 1 offset 2""",
    )
    c.add(
        "nth_group_selling",
        lambda s, d: sg.nth_group(sg.songs_selling(t.songs(s, d), t.sales(s, d), 49), ["artist_name"]),
        """select artist_name, count(*) as n from songs where track_id in (select track_id from sales where sales_count > 49)
        group by artist_name order by n desc, artist_name limit 1 offset 2""",
    )
    c.add(
        "top_artist",
        lambda s, d: sg.top_artist(per_track(s, d)),
        """select max(artist_name) as artist_name, cast(sum(sales_count) as bigint) as sales
        from sales join songs using (track_id) group by artist_id order by sales desc, artist_id limit 1""",
    )

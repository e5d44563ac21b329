"""Registered page-view queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyforge.operators import pageviews as pv
from tallyforge.plans import tables as t
from tallyforge.plans.catalog import Catalog, text_days, written
from tallyforge.scale import with_position
from tallyforge.sinks.writers import month_line, month_pivot
from tallyforge.sources import files
from tallyforge.sources.records import parse_day_fields

MONTH = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
LO, HI = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


def customer_titles(s, d):
    return t.table(s, d, "customer").selectExpr("'Page_' || cast(c_custkey as string) as title")


def film_titles(s, d):
    return t.pagecounts(s, d).where(F.col("title").contains("(film)")).select("title").distinct()


def raw_pagecounts(s, d):
    """Four fields a line, three for error events."""
    return t.table(s, d, "events").selectExpr(
        t.PROJECT, t.TITLE, "cast(floor(value) as bigint) as views", "event_id", "event_type"
    ).selectExpr(
        "' ' || concat_ws(' ', project, title, views, case when event_type <> 'error' then event_id end) || '  ' as value"
    )


def raw_tsv(s, d):
    """``type, id, value`` lines; the value is missing for error events."""
    return t.table(s, d, "events").selectExpr(
        "concat_ws('\t', event_type, event_id, case when event_type <> 'error' then user_id end) as value"
    )


def title_file(s, d):
    """Titles in order of the key, a file for each range, every one with white space around and a blank line after."""
    return t.table(s, d, "customer").orderBy("c_custkey").selectExpr("' ' || c_name || ' \n ' as value")


def count_texts(s, d):
    """Titles with a count that is sometimes not an integer."""
    return t.table(s, d, "events").selectExpr(
        "'Page_' || cast(user_id as string) as title",
        "case event_type when 'error' then 'n/a' when 'click' then cast(event_id as string) || '.5' "
        "else cast(event_id as string) end as views",
    )


def register(c: Catalog) -> None:
    # Sources
    c.add(
        "read_pagecounts",
        lambda s, d: files.read_pagecounts(s, written(s, "pagecounts", lambda p: raw_pagecounts(s, d).write.text(p))),
        f"""select {t.PROJECT.replace("string", "varchar")}, {t.TITLE.replace("string", "varchar")},
        cast(floor(value) as bigint) as views, event_id as nbytes from events where event_type <> 'error'""",
    )
    c.add(
        "read_tsv",
        lambda s, d: files.read_tsv(
            s, written(s, "tsv-lines", lambda p: raw_tsv(s, d).write.text(p)), {"kind": 0, "id": 1, "who": 2}
        ),
        """select event_type as kind, cast(event_id as varchar) as id, cast(user_id as varchar) as who
        from events where event_type <> 'error'""",
    )
    c.add(
        "read_lines",
        lambda s, d: files.read_lines(s, written(s, "lines", lambda p: t.lines(s, d).write.text(p))),
        "select value from lines",
    )
    c.add(
        "read_title_list",
        lambda s, d: with_position(
            files.read_title_list(s, written(s, "titles", lambda p: title_file(s, d).write.text(p))), ["position"], "place"
        ).select("place", "title"),
        "select row_number() over (order by c_custkey) as place, c_name as title from customer",
    )
    c.add(
        "parse_day_fields",
        lambda s, d: text_days(parse_day_fields(month_line(t.daily(s, d)))),
        "select title, cast(day as varchar) as day, views from dense",
    )
    # Output shapes
    c.add(
        "month_line",
        lambda s, d: month_line(t.daily(s, d), min_total=500),
        """select title, sum(views)::bigint || chr(9) || title || chr(9)
        || string_agg(strftime(day, '%Y%m%d') || ':' || views || chr(9), '' order by day) as line
        from dense group by title having sum(views) > 500""",
    )
    c.add(
        "month_pivot",
        lambda s, d: month_pivot(t.daily(s, d), MONTH),
        "select title, "
        + ", ".join(f"""cast(sum(case when day = date '{m}' then views else 0 end) as bigint) as "{m}" """ for m in MONTH)
        + " from daily group by title",
    )
    # Filters
    c.add(
        "filter_articles",
        lambda s, d: text_days(pv.filter_articles(t.pagecounts(s, d)).select("title", "day", "views")),
        "select title, cast(day as varchar) as day, views from articles",
    )
    c.add(
        "project_title_views",
        lambda s, d: pv.project_title_views(t.articles(s, d)),
        "select title, views from articles",
    )
    c.add(
        "having_total",
        lambda s, d: pv.having_total(t.daily(s, d), 500),
        "select title, cast(sum(views) as bigint) as total from daily group by title having sum(views) > 500",
    )
    c.add(
        "count_over",
        lambda s, d: pv.count_over(t.articles(s, d), 100),
        "select count(*) as n from articles where views > 100",
    )
    c.add(
        "drop_bad_numbers",
        lambda s, d: pv.drop_bad_numbers(count_texts(s, d), "views"),
        """select 'Page_' || cast(user_id as varchar) as title, event_id as views
        from events where event_type not in ('error', 'click')""",
    )
    c.add(
        "date_range_filter",
        lambda s, d: text_days(pv.date_range_filter(t.daily(s, d), LO, HI)),
        f"select title, cast(day as varchar) as day, views from daily where day between date '{LO}' and date '{HI}'",
    )
    # Aggregates
    c.add(
        "line_count",
        lambda s, d: pv.line_count(t.pagecounts(s, d)).withColumn("stage", F.lit("before"))
        .unionByName(pv.line_count(t.articles(s, d)).withColumn("stage", F.lit("after"))),
        """select count(*) as lines, 'before' as stage from pagecounts
        union all select count(*), 'after' from articles""",
    )
    c.add(
        "total_views",
        lambda s, d: pv.total_views(t.pagecounts(s, d)),
        "select cast(sum(views) as bigint) as views from pagecounts",
    )
    c.add(
        "sum_by_title_day",
        lambda s, d: text_days(pv.sum_by_title_day(t.articles(s, d))),
        "select title, cast(day as varchar) as day, views from daily",
    )
    c.add(
        "month_total",
        lambda s, d: pv.month_total(t.daily(s, d)),
        "select title, cast(sum(views) as bigint) as total from daily group by title",
    )
    c.add(
        "max_views",
        lambda s, d: pv.max_views(t.articles(s, d), "(film)"),
        "select max(views) as views from articles where contains(title, '(film)')",
    )
    c.add(
        "packed_score",
        lambda s, d: pv.packed_score(t.packed_daily(s, d), LO.strftime("%Y%m%d"), HI.strftime("%Y%m%d")),
        f"""select title, cast(coalesce(sum(c1) filter (keep), 0) + coalesce(max(c2) filter (keep), 0)
          + coalesce(max(c3) filter (keep), 0) as bigint) as score
        from (select title, day between date '{LO}' and date '{HI}' as keep, sum(views) as c1, max(views) as c2, count(*) as c3
          from articles group by title, day) group by title""",
    )
    # Sequences and ranks
    c.add(
        "days_a_beats_b",
        lambda s, d: pv.days_a_beats_b(t.daily(s, d), "Page_1", "Page_2"),
        """select count(*) filter (va > vb) as days from (select day, sum(case when title = 'Page_1' then views else 0 end) as va,
        sum(case when title = 'Page_2' then views else 0 end) as vb from daily group by day)""",
    )
    c.add(
        "peak_day",
        lambda s, d: text_days(pv.peak_day(t.daily(s, d))),
        """select title, cast(day as varchar) as day, views from daily
        qualify row_number() over (partition by title order by views desc, day) = 1""",
    )
    c.add(
        "rank_by_peak",
        lambda s, d: pv.rank_by_peak(t.daily(s, d), film_titles(s, d)),
        """select row_number() over (order by coalesce(m, 0) desc, title) as rank, title, coalesce(m, 0) as views
        from (select distinct title from pagecounts where contains(title, '(film)')) l
        left join (select title, max(views) as m from daily group by title) using (title)""",
    )
    total_rank = """select row_number() over (order by coalesce(m, 0) desc, title) as rank, title,
        cast(coalesce(m, 0) as bigint) as views
        from (select 'Page_' || cast(c_custkey as varchar) as title from customer) l
        left join (select title, sum(views) as m from daily group by title) using (title)"""
    c.add("rank_by_total", lambda s, d: pv.rank_by_total(t.daily(s, d), customer_titles(s, d)), total_rank)
    c.add(
        "list_join",
        lambda s, d: pv.list_join(customer_titles(s, d), pv.month_total(t.daily(s, d)), "total"),
        f"select title, views as total from ({total_rank})",
    )
    c.add(
        "concat_join_list",
        lambda s, d: pv.join_list(pv.rank_by_total(t.daily(s, d), customer_titles(s, d)), 40),
        f"select (rank - 1) // 40 as part, string_agg(title, ',' order by rank) as line from ({total_rank}) group by 1",
    )
    c.add(
        "top_with_zero_first_day",
        lambda s, d: pv.top_with_zero_first_day(t.daily(s, d)),
        """select title, cast(sum(views) as bigint) as total from daily group by title
        having coalesce(sum(views) filter (day = (select min(day) from daily)), 0) = 0 order by total desc, title limit 1""",
    )
    runs = """with steps as (select title, day, views,
          coalesce(views > lag(views) over (partition by title order by day), false) as up from dense),
        marked as (select title, day, sum(case when up then 0 else 1 end) over (partition by title order by day) as run from steps),
        best as (select title, max(n) as run_days from (select title, run, count(*) as n from marked group by title, run) group by title)
        """
    c.add(
        "closed_run",
        lambda s, d: pv.longest_increasing_run(t.daily(s, d), drop_open_run=True),
        runs.replace("best as (select", "ends as (select title, max(run) as open from marked group by title), best as (select").replace(
            "from marked group by title, run)", "from marked where run < (select open from ends where ends.title = marked.title) group by title, run)"
        )
        + "select cast(max(run_days) as int) as run_days, count(*) as titles from best where run_days = (select max(run_days) from best)",
    )
    c.add(
        "longest_increasing_run",
        lambda s, d: pv.longest_increasing_run(t.daily(s, d)),
        runs + "select cast(max(run_days) as int) as run_days, count(*) as titles from best where run_days = (select max(run_days) from best)",
    )
    c.add(
        "dense_days",
        lambda s, d: text_days(pv.dense_days(t.daily(s, d))),
        "select title, cast(day as varchar) as day, views from dense",
    )
    c.add(
        "sort_views",
        lambda s, d: text_days(pv.sort_views(t.articles(s, d))),
        "select title, cast(day as varchar) as day, views from articles order by views, title, day",
    )
    c.add(
        "most_popular",
        lambda s, d: pv.most_popular(t.daily(s, d)),
        "select title, cast(sum(views) as bigint) as total from daily group by title order by total desc, title limit 1",
    )

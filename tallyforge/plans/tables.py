"""Input views over the TPC-H-like parquet tables, for Spark and as SQL text for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions.predicates import FILE_ENDINGS, NAMESPACES, RESERVED_TITLES
from tallyforge.operators.pageviews import filter_articles, sum_by_title_day
from tallyforge.operators.textmodels import ngram_count, split_lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TITLE = """case when event_id % 19 = 5 then 'Main_Page'
       when event_id % 23 = 7 then '404_error/'
       else (case event_id % 13 when 0 then 'Talk:' when 1 then 'x_' when 2 then 'File:' else '' end)
            || 'Page_' || cast(user_id as string)
            || (case event_id % 17 when 0 then '.jpg' when 1 then '_(film)' when 2 then '.txt' else '' end)
  end as title"""
PROJECT = "case when event_id % 10 = 9 then 'fr' else 'en' end as project"


def pagecounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        PROJECT, TITLE, "cast(floor(value) as bigint) as views", "cast(ts as date) as day"
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_articles(pagecounts(spark, sf_dir)).select("title", "day", "views")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_by_title_day(articles(spark, sf_dir))


def packed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per title ``yyyymmdd,views,max,rows`` items joined by ``;`` - one item per day."""
    per_day = articles(spark, sf_dir).groupBy("title", "day").agg(
        F.sum("views").alias("c1"), F.max("views").alias("c2"), F.count(F.lit(1)).alias("c3")
    )
    item = F.concat_ws(",", F.date_format("day", "yyyyMMdd"), *[F.col(c).cast("string") for c in ("c1", "c2", "c3")])
    return per_day.groupBy("title").agg(
        F.array_join(F.sort_array(F.collect_list(item)), ";").alias("packed")
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    return part.join(supplier, F.col("s_suppkey") == F.col("p_partkey") % 7).selectExpr(
        "'T' || cast(p_partkey as string) as track_id", "p_name as title", "p_brand as release",
        "'AR' || cast(s_suppkey as string) as artist_id", "s_name as artist_name",
        "p_retailprice as duration", "cast(p_size as double) / 50 as artist_hotttnesss",
        "case when p_partkey % 5 = 0 then 0 else 1960 + p_size end as year",
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'T' || cast(l_partkey as string) as track_id", "cast(l_shipdate as date) as sale_date",
        "cast(l_quantity as bigint) as sales_count",
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part to order, some links more than once.  Orders above the part ids are dangling, parts
    without such an order have no in-links."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_partkey as src", "l_orderkey as dst")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).distinct()


def userinfo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as userid", "c_name as username", "c_mktsegment as password"
    )


def follows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("(o_orderkey * 7) % 150 <> o_custkey")
        .selectExpr("o_custkey as userid", "(o_orderkey * 7) % 150 as followed")
        .distinct()
    )


def userimage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("userid")).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.expr("max_by('img' || cast(o_orderkey as string) || '.png', o_orderkey)").alias("url"),
    )


KVLOG = (
    "event_id as seq", "ts", "user_id as k",
    "case when event_type = 'view' then 'GET' else 'PUT' end as op",
    "case when event_type = 'view' then null else value end as v",
    "cast(event_id % 3 + 1 as int) as loc",
)


def kvlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*KVLOG)


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as target_id", "'Target ' || cast(c_custkey as string) || ' ' || c_name as line"
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_lines(table(spark, sf_dir, "documents"))


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_count(lines(spark, sf_dir))


def titled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("title"), "text")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as documents: texts with tags."""
    return table(spark, sf_dir, "pages").selectExpr("page_id as title", "html as text")


# The same views as SQL for the oracle, in the order they build on each other.
VIEWS = {
    "pagecounts": f"""select {PROJECT.replace("string", "varchar")}, {TITLE.replace("string", "varchar")},
  cast(floor(value) as bigint) as views, cast(ts as date) as day from events""",
    "articles": f"""select title, day, views from pagecounts where project = 'en'
  and not regexp_matches(title, '^({"|".join(NAMESPACES)}):')
  and regexp_matches(title, '^[^a-z]')
  and not regexp_matches(title, '[.]({"|".join(FILE_ENDINGS)})$')
  and title not in ({", ".join(f"'{x}'" for x in RESERVED_TITLES)})""",
    "daily": "select title, day, cast(sum(views) as bigint) as views from articles group by title, day",
    "axis": "select unnest(generate_series(min(day), max(day), interval 1 day))::date as day from daily",
    "dense": """select t.title, a.day, coalesce(d.views, 0) as views
  from (select distinct title from daily) t cross join axis a left join daily d on d.title = t.title and d.day = a.day""",
    "packed_daily": """select title, string_agg(strftime(day, '%Y%m%d') || ',' || c1 || ',' || c2 || ',' || c3, ';' order by day) as packed
  from (select title, day, cast(sum(views) as bigint) c1, max(views) c2, count(*) c3 from articles group by title, day) group by title""",
    "songs": """select 'T' || cast(p_partkey as varchar) as track_id, p_name as title, p_brand as release,
  'AR' || cast(s_suppkey as varchar) as artist_id, s_name as artist_name, p_retailprice as duration,
  cast(p_size as double) / 50 as artist_hotttnesss, case when p_partkey % 5 = 0 then 0 else 1960 + p_size end as year
  from part join supplier on s_suppkey = p_partkey % 7""",
    "sales": """select 'T' || cast(l_partkey as varchar) as track_id, cast(l_shipdate as date) as sale_date,
  cast(l_quantity as bigint) as sales_count from lineitem""",
    "edges": "select distinct l_partkey as src, l_orderkey as dst from lineitem",
    "pages_in_graph": "select src as page from edges union select dst from edges",
    "userinfo": "select c_custkey as userid, c_name as username, c_mktsegment as password from customer",
    "follows": """select distinct o_custkey as userid, (o_orderkey * 7) % 150 as followed
  from orders where (o_orderkey * 7) % 150 <> o_custkey""",
    "userimage": """select o_custkey as userid, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as time,
  max_by('img' || cast(o_orderkey as varchar) || '.png', o_orderkey) as url from orders group by o_custkey""",
    "kvlog": """select event_id as seq, ts, user_id as k, case when event_type = 'view' then 'GET' else 'PUT' end as op,
  case when event_type = 'view' then null else value end as v, cast(event_id % 3 + 1 as int) as loc from events""",
    "targets": """select c_custkey as target_id,
  'Target ' || cast(c_custkey as varchar) || ' ' || c_name as line from customer""",
    "lines": "select unnest(string_split(text, chr(10))) as value from documents",
    "cleaned": "select trim(regexp_replace(lower(value), '[^a-z]+', ' ', 'g')) as line from lines",
    "line_tokens": "select string_split(line, ' ') as tk from cleaned where line <> ''",
    "ngrams": """select phrase, count(*) as n from (select unnest(flatten(list_transform(range(1, least(5, len(tk)) + 1),
  lambda k: list_transform(range(1, len(tk) - k + 2), lambda i: array_to_string(tk[i:i + k - 1], ' '))))) as phrase
  from line_tokens) group by phrase""",
    "pruned": "select phrase, n from ngrams where n > 2",
    "pairs": """select regexp_replace(phrase, ' [^ ]+$', '') as prefix, regexp_extract(phrase, ' ([^ ]+)$', 1) as word, n
  from pruned where contains(phrase, ' ')""",
    "doc_words": """select doc_id as title, unnest(string_split(trim(regexp_replace(lower(
  replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\\n', chr(10))), '[^a-z]+', ' ', 'g')), ' ')) as word from documents""",
    "tf": "select word, title, count(*) as tf from doc_words where word <> '' group by word, title",
    "df": "select word, count(*) as df from tf group by word",
    "follow_blocks": """select userid, followed, (row_number() over (partition by userid order by followed) - 1) // 4 as part
  from follows""",
    "raw_tf": """select word, title, count(*) as tf from (select page_id as title,
  unnest(string_split(trim(regexp_replace(lower(replace(html, '\\n', chr(10))), '[^a-z]+', ' ', 'g')), ' ')) as word from pages)
  where word <> '' group by word, title""",
    "plain_tf": """select word, title, count(*) as tf from (select page_id as title, unnest(string_split(trim(regexp_replace(lower(
  replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\n', chr(10))), '[^a-z]+', ' ', 'g')), ' ')) as word from pages)
  where word <> '' group by word, title""",
    "feed": """select f.userid, f.followed, u.username as name, i.time, i.url from follows f
  join userimage i on i.userid = f.followed left join userinfo u on u.userid = f.followed""",
    "feed_blocks": """select *, (row_number() over (partition by userid order by time, name, url) - 1) // 3 as part from feed""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it needs, as common table expressions."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                needed.add(name)
                need(VIEWS[name])

    need(sql)
    # Views with a count or a row number behind them are read in several places: computed once.
    ctes = [f"{name} as materialized ({text})" for name, text in VIEWS.items() if name in needed]
    if not ctes:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {', '.join(ctes)}, {body[5:]}"
    return f"with {', '.join(ctes)} {body}"

"""Registered link-graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import graph as g
from tallyforge.operators.textmodels import count_distinct
from tallyforge.plans import tables as t
from tallyforge.plans.catalog import Catalog, rounded


def degree_scores(s, d):
    """Some score per page: its number of in-links plus one half."""
    return t.edges(s, d).groupBy(F.col("dst").alias("page")).agg((F.count(F.lit(1)) + 0.5).alias("score"))


def page_titles(s, d):
    return t.table(s, d, "part").selectExpr("p_partkey as page", "p_name as title")


def pagerank_sql(rounds: int = 10, keep_sourceless: bool = False) -> str:
    """Chained rounds, one table each."""
    steps = [
        "deg as materialized (select src as page, count(*) as links from edges group by src)",
        "total as materialized (select count(*) as n from pages_in_graph)",
        "r0 as materialized (select page, 1.0::double as score from pages_in_graph)",
    ]
    for i in range(rounds):
        prev = f"r{i}"
        steps.append(
            f"m{i} as materialized (select coalesce(sum(score), 0) as mass from {prev} "
            "where page not in (select page from deg))"
        )
        steps.append(
            f"i{i} as materialized (select e.dst as page, sum(r.score / g.links) as incoming from edges e "
            f"join {prev} r on r.page = e.src join deg g on g.page = e.src group by e.dst)"
        )
        source = f"(select p.page, i.incoming from pages_in_graph p left join i{i} i using (page))" if keep_sourceless else f"i{i}"
        steps.append(
            f"r{i + 1} as materialized (select x.page, 0.15 + 0.85 * (coalesce(x.incoming, 0) "
            f"+ (select mass from m{i}) / (select n from total)) as score from {source} x)"
        )
    return f"with {', '.join(steps)} select page, round(score, 6) as score from r{rounds}"


def register(c: Catalog) -> None:
    c.add("distinct_edges", lambda s, d: g.distinct_edges(t.links(s, d)), "select src, dst from edges")
    c.add("all_pages", lambda s, d: g.all_pages(t.links(s, d)), "select page from pages_in_graph")
    c.add(
        "count_distinct_pages",
        lambda s, d: count_distinct(g.all_pages(t.edges(s, d)), "page"),
        "select count(*) as n from pages_in_graph",
    )
    degrees = "select src as page, count(*) as links from edges group by src"
    c.add("out_degree", lambda s, d: g.out_degree(t.links(s, d)), degrees)
    c.add(
        "dangling_pages",
        lambda s, d: g.dangling_pages(t.edges(s, d)),
        "select dst as page from edges except select src from edges",
    )
    c.add(
        "sourceless_pages",
        lambda s, d: g.sourceless_pages(t.edges(s, d)),
        "select src as page from edges except select dst from edges",
    )
    c.add(
        "collect_neighbours",
        lambda s, d: g.collect_neighbours(t.links(s, d), 20).withColumn(
            "neighbours", F.array_join(F.col("neighbours").cast("array<string>"), ",")
        ),
        """select src, part, string_agg(cast(dst as varchar), ',' order by dst) as neighbours
        from (select src, dst, (row_number() over (partition by src order by dst) - 1) // 20 as part from edges) group by src, part""",
    )
    scores = "(select dst as page, count(*) + 0.5::double as score from edges group by dst)"
    c.add(
        "rank_outer_adjacency",
        lambda s, d: g.split_dangling(degree_scores(s, d), t.edges(s, d)),
        f"select page, score, coalesce(links, 0) as links from {scores} left join ({degrees}) using (page)",
    )
    c.add(
        "dangling_mass",
        lambda s, d: rounded(g.dangling_mass(degree_scores(s, d), t.edges(s, d)), "mass"),
        f"select round(coalesce(sum(score), 0), 6) as mass from {scores} where page not in (select src from edges)",
    )
    c.add(
        "rank_title_join",
        lambda s, d: g.with_titles(degree_scores(s, d), page_titles(s, d)),
        f"select p_name as title, score from part join {scores} on page = p_partkey",
    )
    c.add("pagerank", lambda s, d: rounded(g.pagerank(t.links(s, d)), "score"), pagerank_sql())
    c.add(
        "pagerank_keep_sourceless",
        lambda s, d: rounded(g.pagerank(t.links(s, d), keep_sourceless=True), "score"),
        pagerank_sql(keep_sourceless=True),
    )

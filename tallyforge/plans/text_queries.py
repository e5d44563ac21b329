"""Registered text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions.text import clean_text, strip_tags, unescape_newline
from tallyforge.operators import textmodels as tm
from tallyforge.plans import tables as t
from tallyforge.plans.catalog import Catalog, rounded


def term_counts(s, d):
    return tm.term_freq(tm.tokens(t.titled_docs(s, d)))


def counted(s, d):
    return tm.min_count_prune(t.ngram_counts(s, d))


def predictor_text(df):
    """The map as ``word=percent`` entries, best word first."""
    percent = lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 100).cast("int").cast("string"))
    return df.withColumn("predictor", F.array_join(F.transform(F.map_entries("predictor"), percent), " "))


RANKED = """select prefix, word, n, row_number() over (partition by prefix order by n desc, word) as rnk from pairs"""
WIDE = f"""select r.prefix, string_agg(r.word || '=' || cast(round(round(r.n / p.n, 2) * 100) as int), ' ' order by r.rnk) as predictor
    from ({RANKED}) r join pruned p on p.phrase = r.prefix where r.rnk <= 5 group by r.prefix"""


def register(c: Catalog) -> None:
    c.add(
        "clean_text",
        lambda s, d: t.table(s, d, "documents").select("doc_id", clean_text("text").alias("cleaned")),
        "select doc_id, trim(regexp_replace(lower(text), '[^a-z]+', ' ', 'g')) as cleaned from documents",
    )
    c.add(
        "strip_tags",
        lambda s, d: t.table(s, d, "pages").select("page_id", strip_tags("html").alias("plain")),
        "select page_id, regexp_replace(html, '<[^>]*>', ' ', 'g') as plain from pages",
    )
    c.add(
        "unescape_newline",
        lambda s, d: t.table(s, d, "documents")
        .withColumn("escaped", F.replace("text", F.lit("\n"), F.lit("\\n")))
        .select("doc_id", unescape_newline("escaped").alias("plain")),
        "select doc_id, text as plain from documents",
    )
    c.add(
        "ngrams",
        lambda s, d: tm.ngram_rows(t.lines(s, d)),
        """select unnest(flatten(list_transform(range(1, least(5, len(tk)) + 1), lambda k:
        list_transform(range(1, len(tk) - k + 2), lambda i: array_to_string(tk[i:i + k - 1], ' '))))) as phrase from line_tokens""",
    )
    c.add(
        "word_count",
        lambda s, d: tm.word_count(t.lines(s, d)),
        r"""select word, count(*) as n from (select unnest(regexp_split_to_array(value, '[ \t\n\x0b\f\r]+')) as word from lines)
        where word <> '' group by word""",
    )
    c.add("ngram_count", t.ngram_counts, "select phrase, n from ngrams")
    c.add("min_count_prune", counted, "select phrase, n from pruned")
    c.add(
        "split_prefix_last",
        lambda s, d: tm.split_prefix_last(counted(s, d)),
        "select prefix, word, n from pairs",
    )
    c.add(
        "next_word_prob",
        lambda s, d: tm.next_word_prob(counted(s, d)),
        """select a.prefix, a.word, a.n, p.n as base, round(a.n / p.n, 2) as prob
        from pairs a join pruned p on p.phrase = a.prefix""",
    )
    c.add(
        "top_k_next_word",
        lambda s, d: tm.top_k_next_word(tm.split_prefix_last(counted(s, d))),
        f"select prefix, word, n, cast(rnk as int) as rnk from ({RANKED}) where rnk <= 5",
    )
    c.add(
        "model_wide",
        lambda s, d: predictor_text(
            tm.model_wide(tm.top_k_next_word(tm.next_word_prob(counted(s, d))))
        ),
        WIDE,
    )
    c.add("language_model", lambda s, d: predictor_text(tm.language_model(t.lines(s, d))), WIDE)
    c.add("term_freq", term_counts, "select word, title, tf from tf")
    c.add("doc_freq", lambda s, d: tm.doc_freq(term_counts(s, d)), "select word, df from df")
    c.add(
        "count_distinct_docs",
        lambda s, d: tm.count_distinct(t.titled_docs(s, d), "title"),
        "select count(distinct doc_id) as n from documents",
    )

    def with_df(join):
        def run(s, d):
            tf = term_counts(s, d)
            return join(tf, tm.doc_freq(tf)).select("word", "title", "tf", "df")

        return run

    tf_df = "select tf.word, tf.title, tf.tf, df.df from tf join df on df.word = tf.word"
    c.add("tf_join_df", with_df(tm.tf_join_df), tf_df)
    c.add("df_lookup", with_df(tm.df_lookup), tf_df)
    score = """select tf.word, tf.title, tf.tf, df.df, round(tf.tf * log10({ratio}), 6) as tfidf
        from tf join df on df.word = tf.word cross join (select count(distinct doc_id) as total from documents)"""
    c.add(
        "tfidf",
        lambda s, d: rounded(tm.tfidf(t.titled_docs(s, d)), "tfidf"),
        score.format(ratio="total / df.df"),
    )
    c.add(
        "tfidf_all",
        lambda s, d: rounded(tm.tfidf(t.titled_docs(s, d), integer_idf=True), "tfidf"),
        score.format(ratio="total // df.df"),
    )
    # On pages, where it matters whether tags count.
    tagged = """select tf.word, tf.title, tf.tf, df.df, round(tf.tf * log10(total / df.df), 6) as tfidf from {tf} tf
        join (select word, count(*) as df from {tf} group by word) df on df.word = tf.word
        cross join (select count(distinct page_id) as total from pages)"""
    c.add(
        "tfidf_term",
        lambda s, d: rounded(tm.tfidf(t.pages(s, d), term="div", strip_markup=False), "tfidf"),
        tagged.format(tf="raw_tf") + " where tf.word = 'div'",
    )
    c.add("tfidf_all_tagged", lambda s, d: rounded(tm.tfidf(t.pages(s, d)), "tfidf"), tagged.format(tf="plain_tf"))

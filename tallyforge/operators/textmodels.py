"""Word and n-gram counts, next-word language model, TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyforge.functions.text import (
    clean_text,
    leading_phrases,
    split_words,
    strip_tags,
    unescape_newline,
    word_windows,
)
from tallyforge.scale import lookup_by_weight

# Characters of lines whose windows one task counts and the most parts, characters of the sample in which hot phrases
# are looked for, and the characters for each occurrence below which a phrase is hot.
PART_CHARS = 4_000_000
MAX_PARTS = 100_000
SAMPLE_CHARS = 4_000_000
HOT_CHARS = 8192


def split_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Multi-line texts to one row per line, as ``(value)``."""
    return docs.select(F.explode(F.split(text, "\n")).alias("value"))


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whitespace tokens, case and punctuation kept, with their counts."""
    found = lines.select(F.explode(split_words(column)).alias("word")).where(F.col("word") != "")
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def ngram_rows(lines: DataFrame, max_n: int = 5, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """``(keep.., phrase)``: every run of 1 to ``max_n`` words of each cleaned line, one row each.

    Two generators, one after the other, so each line is cleaned once and no list of all its
    phrases is built.  Empty lines give one empty window.  Dropping it here rather than the line
    beforehand keeps the cleaning expression out of the scan, where it would run once more.
    """
    windows = lines.select(*keep, F.explode(word_windows(clean_text(column), max_n)).alias("win"))
    return windows.where(F.col("win") != "").select(*keep, F.explode(leading_phrases("win", max_n)).alias("phrase"))


def _layout(lines: DataFrame, max_n: int, column: str) -> tuple[int | None, list[str]]:
    """Number of parts for the windows of ``lines`` (None: leave it to the session), and the phrases
    found more than once in ``HOT_CHARS`` characters of a sample, fewer than ``HOT_CHARS`` of each length.

    Both only decide which task counts what; counts never depend on them.
    """
    total = lines.agg(F.coalesce(F.sum(F.length(column)), F.lit(0))).first()[0]
    if total <= PART_CHARS:
        return None, []
    fraction = min(1.0, SAMPLE_CHARS / total)
    counts = ngram_rows(lines.sample(fraction, 7), max_n, column).groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    common = counts.where(F.col("n") > fraction * total / HOT_CHARS).select("phrase")
    hot = {r["phrase"] for r in common.collect()}
    return min(MAX_PARTS, -(-total // PART_CHARS)), sorted(hot)


def ngram_count(lines: DataFrame, max_n: int = 5, column: str = "value") -> DataFrame:
    """Counts of 1 to ``max_n`` word phrases inside each cleaned line.

    Equal lines are merged first.  Then one window of up to ``max_n`` words is moved per word, not
    its phrases, to the task of its ``key``: its shortest beginning that is no hot phrase.  In the
    order of their windows the occurrences of a phrase follow each other, so its count is the
    difference of two running counts, and memory is that of a sort.  Hot phrases, whose windows lie
    in many tasks, are summed from partial counts.
    """
    parts, hot = _layout(lines, max_n, column)
    merged = lines.groupBy(F.col(column).alias("line")).agg(F.count(F.lit(1)).alias("copies"))
    words = merged.select("copies", F.split(clean_text("line"), " ").alias("words"))
    placed = words.select("copies", "words", F.posexplode("words").alias("pos", "word"))
    after = [F.get("words", F.col("pos") + k) for k in range(1, max_n)]
    windows = placed.where(F.col("word") != "").select("copies", F.concat_ws(" ", "word", *after).alias("win"))
    heads = [F.substring_index("win", " ", k) for k in range(1, max_n + 1)]
    # Phrases hold letters and single spaces only.
    among = "false" if not hot else "{} in (" + ", ".join(f"'{p}'" for p in hot) + ")"
    is_hot = [F.expr(among.format(f"substring_index(win, ' ', {k})")) for k in range(1, max_n + 1)]
    key = F.coalesce(*[F.when(~h, p) for h, p in zip(is_hot, heads)], F.col("win")) if hot else heads[0]
    dealt = windows.repartition(key) if parts is None else windows.repartition(parts, key)

    order = Window.partitionBy("key").orderBy(F.desc("win"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.select("copies", "win", key.alias("key")).select(
        "key", "win", F.sum("copies").over(upto).alias("upto"), F.lead("win").over(order).alias("next")
    )
    # The last of equal windows has the count of all.  It ends the runs of its phrases longer than
    # the words it shares with the next; at the end of a key those that are not hot.
    last = run.where(F.col("next").isNull() | (F.col("next") != F.col("win")))
    following = F.concat("next", F.lit(" "))
    shares = F.lit(max_n - 1)
    for k in range(max_n - 2, 0, -1):
        shares = F.when(~F.startswith(following, F.concat(heads[k], F.lit(" "))), F.lit(k)).otherwise(shares)
    key_words = F.octet_length("key") - F.octet_length(F.replace("key", F.lit(" "), F.lit("")))
    if hot:
        key_words = F.when(F.expr(among.format("win")), F.lit(max_n)).otherwise(key_words)
    shared = F.when(F.col("next").isNull(), key_words).otherwise(shares)
    marked = last.select("key", "win", "upto", shared.alias("shared"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = range(1, max_n + 1)
    before = [F.max(F.when(F.col("shared") < k, F.col("upto"))).over(earlier).alias(f"base{k}") for k in levels]
    based = marked.select("win", "upto", "shared", *before)
    found = []
    for k in levels:
        own = F.col("shared") < k
        if k > 1:
            own &= F.octet_length(heads[k - 2]) < F.octet_length("win")
        n = F.col("upto") - F.coalesce(f"base{k}", F.lit(0))
        found.append(F.when(own, F.struct(heads[k - 1].alias("phrase"), n.alias("n"))))
    counts = based.select(F.explode(F.array(*found)).alias("c")).where(F.col("c").isNotNull()).select("c.phrase", "c.n")
    if not hot:
        return counts
    common = [heads[0]]
    for k in range(1, max_n):
        common.append(F.when(is_hot[k] & (F.octet_length(heads[k]) > F.octet_length(heads[k - 1])), heads[k]))
    common = F.when(is_hot[0], F.array(*common)).otherwise(F.array().cast("array<string>"))
    partial = dealt.select("copies", F.explode(common).alias("phrase")).where(F.col("phrase").isNotNull())
    return counts.unionByName(partial.groupBy("phrase").agg(F.sum("copies").alias("n")))


def min_count_prune(counts: DataFrame, min_count: int = 2) -> DataFrame:
    """Phrases counted more than ``min_count`` times."""
    return counts.where((F.col("phrase") != "") & (F.col("n") > min_count))


def split_prefix_last(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more as ``(prefix, word, n)``.

    Written as a generator, not a filter: a filter on the phrase would be pushed below its
    count, and the count could then not be shared with other readers of ``counts``.
    """
    word = F.substring_index("phrase", " ", -1)
    prefix = F.substring(F.col("phrase"), F.lit(1), F.length("phrase") - F.length(word) - 1)
    pair = F.array(F.struct(prefix.alias("prefix"), word.alias("word")))
    some = F.when(F.col("phrase").contains(" "), pair).otherwise(
        F.array().cast("array<struct<prefix:string,word:string>>")
    )
    return counts.select("n", F.inline(some)).select("prefix", "word", "n")


def top_k_next_word(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most frequent next words of each prefix, ties by word, with ``rnk``.

    A rank filter on row_number is cut to ``k`` rows per prefix before the shuffle as well.
    """
    order = Window.partitionBy("prefix").orderBy(F.desc("n"), "word")
    return pairs.withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= k)


def next_word_prob(counts: DataFrame) -> DataFrame:
    """``(prefix, word, n, base, prob)`` with prob = n / count of the prefix, 2 decimals.

    A prefix has at most as many next words as it has occurrences, so its own count tells which
    prefixes may be heavy.  Bringing the counts to their phrases once (there is one row for each)
    lets all readers below share that exchange, so nothing before it is run again.
    """
    counts = counts.groupBy("phrase").agg(F.max("n").alias("n"))
    base = counts.select(F.col("phrase").alias("prefix"), F.col("n").alias("base"))
    found = lookup_by_weight(split_prefix_last(counts), base, "prefix", "base")
    return found.withColumn("prob", F.round(F.col("n") / F.col("base"), 2))


def model_wide(model: DataFrame) -> DataFrame:
    """One row per prefix with a map from next word to probability, best word first.

    At most k rows per prefix reach this point, so the collected list is bounded.
    """
    ranked = F.array_sort(F.collect_list(F.struct("rnk", "word", "prob")))
    entries = F.transform(ranked, lambda e: F.struct(e["word"], e["prob"]))
    return model.groupBy("prefix").agg(F.map_from_entries(entries).alias("predictor"))


def language_model(
    lines: DataFrame, max_n: int = 5, min_count: int = 2, k: int = 5, column: str = "value"
) -> DataFrame:
    """Wide next-word model of text lines, as ``model_wide`` of the ``k`` best words per prefix.

    The counts are read once: each phrase is sent to its own key, where it is the base, and to
    the key of its prefix, where it is a candidate.  Ranking the base before the candidates and
    keeping k + 1 rows per key cuts the data before the only shuffle after the count.
    """
    counts = min_count_prune(ngram_count(lines, max_n, column), min_count)
    word = F.substring_index("phrase", " ", -1)
    prefix = F.substring(F.col("phrase"), F.lit(1), F.length("phrase") - F.length(word) - 1)
    own = F.struct(F.col("phrase").alias("prefix"), F.lit(None).cast("string").alias("word"))
    sent = F.struct(prefix.alias("prefix"), word.alias("word"))
    both = F.when(F.col("phrase").contains(" "), F.array(own, sent)).otherwise(F.array(own))
    roles = counts.select("n", F.inline(both))
    order = Window.partitionBy("prefix").orderBy(F.isnotnull("word"), F.desc("n"), "word")
    top = roles.withColumn("rnk", F.row_number().over(order)).where(F.col("rnk") <= k + 1)
    candidate = F.when(F.isnotnull("word"), F.struct("rnk", "word", "n"))
    grouped = top.groupBy("prefix").agg(
        F.max(F.when(F.isnull("word"), F.col("n"))).alias("base"),
        F.sort_array(F.collect_list(candidate)).alias("best"),
    )
    # A key without a base row may have kept one candidate too many, but pruned counts always
    # hold the prefix of a phrase they hold.
    entries = F.transform(
        F.slice("best", 1, k), lambda e: F.struct(e["word"], F.round(e["n"] / F.col("base"), 2))
    )
    kept = grouped.where((F.size("best") > 0) & F.col("base").isNotNull())
    return kept.select("prefix", F.map_from_entries(entries).alias("predictor"))


def tokens(
    docs: DataFrame, title: str = "title", text: str = "text", term: str | None = None, strip_markup: bool = True
) -> DataFrame:
    """``(word, title)`` per word of the cleaned text, or per occurrence of ``term`` only.

    Escaped newlines are removed, and tags with ``strip_markup``; else tags give words as well.
    """
    cleaned = clean_text(unescape_newline(strip_tags(text) if strip_markup else F.col(text)))
    wanted = F.col("word") != "" if term is None else F.col("word") == term
    # No alias on top of an equal name: it would survive in one branch of a self-join only and
    # make two equal exchanges look different.
    name = F.col(title) if title == "title" else F.col(title).alias("title")
    return docs.select(F.explode(F.split(cleaned, " ")).alias("word"), name).where(wanted)


def term_freq(tokens_df: DataFrame) -> DataFrame:
    return tokens_df.groupBy("word", "title").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(tf: DataFrame) -> DataFrame:
    """Documents per word; ``tf`` has one row per (word, title).

    Counting by ``tf`` (never 0) keeps that column in the plan, so the exchange behind ``tf`` is
    the same one its other readers use and is run once.
    """
    return tf.groupBy("word").agg(F.count_if(F.col("tf") > 0).alias("df"))


def count_distinct(df: DataFrame, column: str) -> DataFrame:
    """Exact number of distinct values."""
    return df.agg(F.count_distinct(column).alias("n"))


def tf_join_df(tf: DataFrame, df: DataFrame) -> DataFrame:
    """Term counts with the document count of their word.

    A common word occurs in most documents.  Its weight is the document count itself, so the
    frequent words are looked up by broadcast and only rare ones are shuffled.
    """
    return lookup_by_weight(tf, df, "word", "df")


def df_lookup(tf: DataFrame, df: DataFrame) -> DataFrame:
    """Document counts looked up for every row of ``tf``: the frequent part of the table is held
    by every executor, nothing is collected on the driver."""
    return lookup_by_weight(tf, df, "word", "df")


def tfidf(
    docs: DataFrame,
    term: str | None = None,
    integer_idf: bool = False,
    title: str = "title",
    text: str = "text",
    strip_markup: bool = True,
) -> DataFrame:
    """``(word, title, tf, df, tfidf)`` with tfidf = tf * log10(N / df), N = distinct titles.

    ``integer_idf`` drops the fraction of N / df.  With ``term`` only that word is counted;
    N still covers all documents.  ``strip_markup=False`` counts the words inside tags too.
    """
    # A literal one-row aggregate, evaluated once and used as a constant.
    total = docs.agg(F.count_distinct(title)).scalar()
    if term is not None:
        # Cleaning never joins letters, so other texts cannot have the word.
        docs = docs.where(F.lower(text).contains(term))
    tf = term_freq(tokens(docs, title, text, term, strip_markup))
    if term is not None:
        scored = tf.withColumn("df", tf.agg(F.count_if(F.col("tf") > 0)).scalar())
    else:
        scored = tf_join_df(tf, doc_freq(tf))
    ratio = F.expr("total div df") if integer_idf else F.col("total") / F.col("df")
    return (
        scored.withColumn("total", total)
        .withColumn("tfidf", F.col("tf") * F.log10(ratio))
        .select("word", "title", "tf", "df", "tfidf")
    )

"""TF-IDF over a collection of (title, body) articles.

Semantics kept from the original job: the title is the document identity
(articles sharing a title merge), N is the number of distinct titles,
idf = log10(N / df) without smoothing, w = tf * idf, entities are not decoded,
and an empty body contributes one empty word.

Plan shape (see ``tests/test_plans.py``): tokens are exploded inside the scan
stage; tf is a two-phase aggregate (partial counts per task before the
shuffle, so a stop-word never moves row by row); df aggregates the tf rows the
same way; tf joins df on ``word``, where AQE splits a hot word's partition
(or broadcasts df when its runtime size is small). Each article also gives one
row under a marker that no tokenizer produces, counted as 0: N is the number
of its titles, a scalar subquery over the same tf rows, so a body without
words (or a null one) still counts and no title is shuffled for N. All
branches share one tf shuffle and the corpus is tokenized once. A single-term lookup
(:func:`term_weights`) skips the explode: it counts the term inside each
article's token array and aggregates by title. ``split_hot`` does the skew
split in the plan itself (:func:`salted_weights`), whatever adaptive execution
is set to; :mod:`quillrank.operators.keyed` keeps weights for many lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.functions.text import token_array, token_array_glued
from quillrank.operators.topk import top_k

FULL = "full"
BEFORE_COMMA = "before_comma"
# Stands for an article itself among its words; words have letters only.
MARKER = "#"
# A word is hot where it alone has more than one part in so many of a partition's even share of rows.
HOT_PART = 16


def tokens(articles: DataFrame, keep_empty: bool = True) -> DataFrame:
    """(title, word): one row per word occurrence."""
    out = articles.select("title", F.explode(token_array("body")).alias("word"))
    return out if keep_empty else out.where(F.col("word") != "")


def tokens_glued(articles: DataFrame) -> DataFrame:
    """(title, word) with the second tokenizer (tags glue neighbouring text)."""
    return articles.select("title", F.explode(token_array_glued("body")).alias("word"))


def term_freq(toks: DataFrame) -> DataFrame:
    """(word, title, tf)."""
    return toks.groupBy("word", "title").agg(F.count(F.lit(1)).alias("tf"))


def marked_term_freq(articles: DataFrame) -> DataFrame:
    """(word, title, tf) with one more row per title: the marker, of tf 0.

    ``where("tf > 0")`` gives the words, :func:`titles_in` the number of titles.
    """
    words = F.coalesce(F.concat(token_array("body"), F.array(F.lit(MARKER))), F.array(F.lit(MARKER)))
    toks = articles.select("title", F.explode(words).alias("word"))
    return toks.groupBy("word", "title").agg(F.count(F.when(F.col("word") != MARKER, True)).alias("tf"))


def _present(tf: DataFrame):
    # tf > 0 always holds; counting through it keeps the tf aggregate whole,
    # so df, N and the join share one tf shuffle (ReusedExchange) instead of
    # Catalyst pruning the count away and tokenizing the corpus again.
    return F.col("tf") > 0


def doc_freq(tf: DataFrame) -> DataFrame:
    """(word, df): number of titles containing the word."""
    return tf.groupBy("word").agg(F.count(F.when(_present(tf), True)).alias("df"))


def titles_in(marked: DataFrame) -> DataFrame:
    """One row (n): distinct titles of a :func:`marked_term_freq` table, sharing its shuffle."""
    return marked.agg(F.count(F.when(F.col("tf") == 0, F.col("title"))).alias("n"))


def doc_count(articles: DataFrame) -> DataFrame:
    """One row (n): the number of distinct titles."""
    return articles.agg(F.countDistinct("title").alias("n"))


def idf(df: DataFrame, n: DataFrame) -> DataFrame:
    """(word, df, n, idf) with idf = log10(n / df); ``n`` is a one-row frame
    used as a scalar subquery."""
    n_value = n.select("n").scalar()
    return df.select("word", "df", n_value.alias("n"), F.log10(n_value / F.col("df")).alias("idf"))


def _output_title(title_key: str):
    if title_key == FULL:
        return F.col("title")
    if title_key == BEFORE_COMMA:
        return F.substring_index(F.col("title"), ",", 1)
    raise ValueError("title_key must be 'full' or 'before_comma'")


def tfidf(articles: DataFrame, *, keep_empty: bool = True, title_key: str = FULL,
          term: str | None = None, split_hot: bool = False) -> DataFrame:
    """(word, title, tf, df, w) for every word and title, or for one ``term``.

    N counts the titles of all articles, null bodies included (they have no
    words); a null title is no title. ``split_hot`` splits the rows of frequent
    words by a salt, for sessions whose adaptive execution does not.
    """
    if term is not None:
        return term_weights(articles, term, keep_empty=keep_empty, title_key=title_key)
    marked = marked_term_freq(articles)
    tf = marked.where(F.col("tf") > 0)
    if not keep_empty:
        tf = tf.where(F.col("word") != "")
    return (salted_weights if split_hot else weights)(tf, titles_in(marked), title_key=title_key)


def term_weights(articles: DataFrame, term: str, *, keep_empty: bool = True,
                 title_key: str = FULL) -> DataFrame:
    """(word, title, tf, df, w) for one term, in a single pass.

    Each article counts the term inside its token array (no explode), one
    two-phase aggregate by title gives tf per title, and the same aggregate
    gives df (titles with hits) and N (all titles), so the corpus is read
    and tokenized once.
    """
    if term == "" and not keep_empty:
        hits = F.lit(0)
    else:
        hits = F.coalesce(F.size(F.filter(token_array("body"), lambda w: w == F.lit(term))), F.lit(0))
        hits = F.greatest(hits, F.lit(0))  # size of null is -1 where ANSI mode is off
    per_title = (
        articles.select("title", hits.cast("long").alias("hits"))
        .groupBy("title")
        .agg(F.sum("hits").alias("tf"))
    )
    # One struct-valued scalar subquery over the same per-title aggregate. It
    # reads tf, so Catalyst keeps the aggregate whole and reuses its shuffle.
    stats = per_title.agg(
        F.struct(F.count("title").alias("n"), F.count(F.when(_present(per_title), True)).alias("df"))
    ).scalar()
    n, df = stats.getField("n"), stats.getField("df")
    return per_title.where(F.col("tf") > 0).select(
        F.lit(term).alias("word"),
        _output_title(title_key).alias("title"),
        "tf",
        df.alias("df"),
        (F.col("tf") * F.log10(n / df)).alias("w"),
    )


def weights(tf: DataFrame, n: DataFrame, *, title_key: str = FULL) -> DataFrame:
    """(word, title, tf, df, w) from a tf table and the one-row corpus size
    (used as a scalar subquery, computed once per query)."""
    n_value = n.select("n").scalar()
    return tf.join(doc_freq(tf), "word").select(
        "word",
        _output_title(title_key).alias("title"),
        "tf",
        "df",
        (F.col("tf") * F.log10(n_value / F.col("df"))).alias("w"),
    )


def hot_words(df: DataFrame, partitions: int) -> DataFrame:
    """(word, salts): words of a (word, df) table with many rows, and the number of salts of each.

    A word's df is its number of tf rows. Hot is what has more than ``1 /
    (HOT_PART * partitions)`` of all rows, so there are at most ``HOT_PART *
    partitions`` such words and twice as many salts, whatever the corpus.
    """
    share = df.agg(F.greatest(F.sum("df") / F.lit(HOT_PART * partitions), F.lit(1.0)).alias("s")).scalar()
    return df.where(F.col("df") > share).select("word", F.ceil(F.col("df") / share).cast("int").alias("salts"))


def salted_weights(tf: DataFrame, n: DataFrame, *, title_key: str = FULL, partitions: int | None = None) -> DataFrame:
    """As :func:`weights`, with the rows of hot words split by a salt.

    Hot words come from the df aggregate, so the tf shuffle is shared with it.
    A tf row of a hot word takes one of the word's salts by its title, and the
    word's df row is there once per salt; every other word has the one salt 0.
    The list of hot words, of a length bounded by the number of partitions, is
    broadcast to the tf side.
    """
    partitions = partitions or int(tf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = doc_freq(tf)
    hot = F.broadcast(hot_words(df, partitions))
    of_title = F.pmod(F.xxhash64("title"), F.coalesce("salts", F.lit(1)).cast("long")).cast("int")
    rows = tf.join(hot, "word", "left").select("word", "title", "tf", of_title.alias("salt"))
    salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    spread = df.join(hot, "word", "left").select("word", "df", salts)
    n_value = n.select("n").scalar()
    return rows.join(spread, ["word", "salt"]).select(
        "word",
        _output_title(title_key).alias("title"),
        "tf",
        "df",
        (F.col("tf") * F.log10(n_value / F.col("df"))).alias("w"),
    )


def tfidf_term(articles: DataFrame, term: str, **kw) -> DataFrame:
    """All (word, title, tf, df, w) rows of one term; stays distributed."""
    return tfidf(articles, term=term, **kw)


def tfidf_topk(articles: DataFrame, term: str = "cloud", k: int = 100, *,
               title_key: str = FULL, keep_empty: bool = True, digits: int | None = None) -> DataFrame:
    """(title, w): the k titles with the highest weight for ``term``.

    Ties go to the larger title. With ``before_comma`` several titles can
    share an output title; the largest weight is kept.
    """
    scored = tfidf(articles, term=term, title_key=title_key, keep_empty=keep_empty).select("title", "w")
    if title_key == BEFORE_COMMA:
        scored = scored.groupBy("title").agg(F.max("w").alias("w"))
    return top_k(scored, "w", "title", k=k, digits=digits)

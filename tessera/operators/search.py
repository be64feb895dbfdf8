"""Vectorisation and evaluation of similarity search (survey 2H).

Vectors are kept in long form ``(id, term, weight)``; the top-k search over
them is :mod:`tessera.operators.bounded_search`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as TX


# H01 ---------------------------------------------------------------------------
def term_counts(docs: DataFrame, id_col: str, text_col: str = "text",
                stop_words: list[str] | None = None, tokens: Column | None = None) -> DataFrame:
    """``(id, term, tf)``: vectoriser tokens (≥2 word chars, lower case),
    stop words removed, counted per document."""
    tok = tokens if tokens is not None else TX.word_tokens(text_col)
    if stop_words:
        tok = TX.remove_words(tok, stop_words)
    exploded = explode_terms(docs.select(F.col(id_col).alias("id"), tok.alias("_t")), "_t")
    return exploded.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def explode_terms(df: DataFrame, arr: str, keep: tuple = ()) -> DataFrame:
    """``explode`` written as ``explode_outer`` + NULL filter: a plain
    ``explode`` makes Catalyst infer ``size(arr) > 0`` and push it below the
    scan-side exchange, which would evaluate the whole tokeniser twice."""
    out = df.select("id", *keep, F.explode_outer(arr).alias("term"))
    return out.filter(F.col("term").isNotNull())


def doc_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def n_docs(docs: DataFrame) -> Column:
    """Corpus size as a scalar subquery (lazy)."""
    return docs.agg(F.count(F.lit(1))).scalar()


def _l2(weights: DataFrame) -> DataFrame:
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return weights.withColumn("w", F.col("w") / norm)


def idf_table(tf: DataFrame, n: int, form: str = "smooth") -> DataFrame:
    """Per-term idf.  ``smooth`` (sklearn): ``ln((1+n)/(1+df)) + 1``;
    ``log2`` (gensim): ``log2(n/df)``."""
    return idf_of(doc_frequency(tf), n, form)


def idf_of(d: DataFrame, n: int, form: str = "smooth") -> DataFrame:
    """:func:`idf_table` of document frequencies ``(term, df)``."""
    nn = n if isinstance(n, Column) else F.lit(n)
    if form == "smooth":
        idf = F.ln((F.lit(1.0) + nn) / (F.lit(1.0) + F.col("df"))) + 1
    elif form == "log2":
        idf = F.log2(nn.cast("double") / F.col("df"))
    else:
        raise ValueError(form)
    return d.select("term", "df", idf.alias("idf"))


# H02 / H04 ---------------------------------------------------------------------
def tfidf(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """``(id, term, w)`` with ``w = tf·idf``, L2-normalised per id; terms not
    in ``idf`` are dropped (unknown query terms).  Terms with weight 0 (a
    gensim idf of 0) are dropped too."""
    # No explicit broadcast: the vocabulary grows with the corpus.  AQE turns
    # this into a broadcast join at run time when the materialised vocabulary
    # is under the broadcast threshold (a measured, not guessed, size).
    return _l2(weights(tf, idf))


def weights(tf: DataFrame, idf: DataFrame) -> DataFrame:
    """``(id, term, tf·idf)``, not normalised; weights of 0 are dropped."""
    j = tf.join(idf.select("term", "idf"), "term")
    return j.select("id", "term", (F.col("tf") * F.col("idf")).alias("w")).filter(F.col("w") != 0)


def corpus_tfidf(docs: DataFrame, id_col: str, text_col: str = "text", form: str = "smooth",
                 stop_words: list[str] | None = None, max_features: int | None = None,
                 tokens: Column | None = None):
    """Fit on the corpus: returns ``(doc_vectors, idf)``."""
    tf = term_counts(docs, id_col, text_col, stop_words, tokens)
    if max_features:
        tf = tf.join(top_terms(tf, max_features), "term", "left_semi")
    n = docs.select(id_col).distinct().agg(F.count(F.lit(1))).scalar()   # lazy scalar
    idf = idf_table(tf, n, form)
    return tfidf(tf, idf), idf


# H03 ---------------------------------------------------------------------------
def top_terms(tf: DataFrame, n: int) -> DataFrame:
    """The ``n`` terms with the largest corpus count (ties by term).  A
    global top-n: Spark takes a per-partition top-n before the final one."""
    tot = tf.groupBy("term").agg(F.sum("tf").alias("cnt"))
    return tot.orderBy(F.desc("cnt"), F.asc("term")).limit(n).select("term")


# Ranking -----------------------------------------------------------------------
def top_k(scores: DataFrame, k: int, score: str = "score", ascending: bool = False,
          key: str = "query_id", item: str = "doc_id") -> DataFrame:
    """Rank 1..k per key by score (ties by item id)."""
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = Window.partitionBy(key).orderBy(order, F.col(item).asc())
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# H14 ---------------------------------------------------------------------------
def token_sets(docs: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """``(id, term)`` distinct tokens per text, plus the set size."""
    sets = docs.select(F.col(id_col).alias("id"), F.array_distinct(tokens).alias("_s"))
    sets = sets.withColumn("n", F.size("_s").cast("long"))
    return explode_terms(sets, "_s", keep=("n",))


# H15 ---------------------------------------------------------------------------
def pair_cosine(a_vec: DataFrame, b_vec: DataFrame) -> DataFrame:
    """Row-wise cosine of paired vectors sharing an id (no search)."""
    a = a_vec.select("id", "term", F.col("w").alias("wa"))
    b = b_vec.select("id", "term", F.col("w").alias("wb"))
    return a.join(b, ["id", "term"]).groupBy("id").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("cosine"))


# H24 ---------------------------------------------------------------------------
def evaluate_hits(results: DataFrame, truth: DataFrame, queries: DataFrame,
                  key: str = "query_id", item: str = "doc_id") -> DataFrame:
    """Per row of *queries*: ``Matching`` (correct item ranked 1), ``In top``
    or ``No result`` (also where truth has no item at all); truth is
    ``(key, item)`` (a query may have several correct items)."""
    hit = results.join(truth, [key, item]).groupBy(key).agg(F.min("rank").alias("best_rank"))
    q = queries.select(key).distinct().join(hit, key, "left")
    return q.withColumn("outcome", F.when(F.col("best_rank") == 1, "Matching")
                        .when(F.col("best_rank").isNotNull(), "In top")
                        .otherwise("No result"))


def hit_rate(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(
        F.count(F.lit(1)).alias("queries"),
        F.count_if(F.col("outcome") == "Matching").alias("top1"),
        F.count_if(F.col("outcome") != "No result").alias("topk"),
        (F.count_if(F.col("outcome") != "No result") / F.count(F.lit(1))).alias("hit_rate"))

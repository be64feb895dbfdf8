"""Search workloads over the driver tables (survey §3 L3).

Corpus = ``documents``; query batch = ``benchmark`` passages; the correct
answer of a query is every document that contains the passage verbatim.
Feedback search: look-ups of the feedback pairs against all their questions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as TX
from tessera.operators import bounded_search as B
from tessera.operators import search as S
from tessera.operators import term_vectors as TV
from tessera.operators.joins import maybe_broadcast
from tessera.sources import views as V
from tessera.session import written
from tessera.sources.tables import Tables

# Fixed value: a short English stop list (a parameter of the count vectoriser).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in",
              "is", "it", "its", "of", "on", "or", "that", "the", "to", "was", "were", "with"]
SCORE_DIGITS = 10   # scores are rounded so that exact ties break by id in any engine


def tfidf_vectors(t: Tables, form: str = "smooth", max_features: int | None = None,
                  stop_words: list[str] | None = None):
    docs = V.search_corpus(t)
    if max_features:
        d_vec, idf = S.corpus_tfidf(docs, "doc_id", form=form, max_features=max_features,
                                    stop_words=stop_words)
    else:
        counts, idf = corpus_counts(t, form, stop_words)
        d_vec = TV.unit_vectors(counts, idf)
    q_tf = S.term_counts(V.search_queries(t), "query_id", stop_words=stop_words)
    return d_vec, S.tfidf(q_tf, idf), idf


def corpus_counts(t: Tables, form: str = "smooth", stop_words: list[str] | None = None):
    """The documents' term counts, a row a document, and the idf table; both written."""
    docs = V.search_corpus(t)
    counts = TV.counted(docs, "doc_id", stop_words)
    n = docs.select("doc_id").distinct().agg(F.count(F.lit(1))).scalar()
    return counts, written(S.idf_of(TV.doc_frequency(counts), n, form), "idf")


def count_vectors(t: Tables):
    """Count vectors without stop words (H06): the documents' counts, and the
    queries' unit vectors of known terms."""
    counts = TV.counted(V.search_corpus(t), "doc_id", STOP_WORDS)
    q_tf = S.term_counts(V.search_queries(t), "query_id", stop_words=STOP_WORDS)
    q_tf = q_tf.join(TV.doc_frequency(counts).select("term"), "term", "left_semi")
    return counts, S._l2(q_tf.select("id", "term", F.col("tf").cast("double").alias("w")))


def tfidf_weights(t: Tables):
    """The documents' term counts, the idf table and the queries' unit vectors."""
    counts, idf = corpus_counts(t)
    return counts, idf, S.tfidf(S.term_counts(V.search_queries(t), "query_id"), idf)


def _cosine(counts: DataFrame, idf: DataFrame | None, q_vec: DataFrame, k: int) -> DataFrame:
    return B.cosine_top_k(q_vec, None, k, lambda terms: TV.cosine_postings(counts, idf, terms))


def _always_k(t: Tables, found: DataFrame, known: DataFrame, with_terms: DataFrame, k: int,
              value: str = "score", **values) -> DataFrame:
    """*found* with always k rows a query; *known* has the ids of queries with
    a known term, *with_terms* the ids of documents with terms."""
    known = known.select(F.col("id").alias("query_id")).distinct().withColumn("_k", F.lit(True))
    queries = (V.search_queries(t).select("query_id").distinct().join(known, "query_id", "left")
               .select("query_id", F.coalesce("_k", F.lit(False)).alias("known")))
    docs = V.search_corpus(t).select("doc_id")
    zero = docs.join(with_terms.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_anti")
    return B.filled(found, queries, docs, k, zero, value, **values)


def cosine_top_k(t: Tables, k: int = 5) -> DataFrame:
    counts, idf, q_vec = tfidf_weights(t)
    return _always_k(t, _cosine(counts, idf, q_vec, k), q_vec, counts, k,
                     plain=0.0, zero=0.0, zero_zero=0.0)


def count_cosine_top_k(t: Tables, k: int = 5) -> DataFrame:
    counts, q_vec = count_vectors(t)
    return _always_k(t, _cosine(counts, None, q_vec, k), q_vec, counts, k,
                     plain=0.0, zero=0.0, zero_zero=0.0)


def euclid_top_k(t: Tables, k: int = 5) -> DataFrame:
    """Nearest unit vectors: ``sqrt(2 - 2 cos)``, which falls as the cosine
    rises.  A query or document without a known term is the zero vector, at
    distance 1 from a unit vector and 0 from another zero vector."""
    counts, idf, q_vec = tfidf_weights(t)
    found = _cosine(counts, idf, q_vec, k).withColumn("distance", F.round(
        F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))), SCORE_DIGITS))
    return _always_k(t, found, q_vec, counts, k, "distance", ascending=True,
                     plain=round(2 ** 0.5, SCORE_DIGITS), zero=1.0, zero_zero=0.0)


def jaccard_sets(t: Tables):
    sets = V.search_corpus(t).select(F.col("doc_id").alias("id"), F.array_distinct(
        TX.split_words(TX.clean_full("text"))).alias("_s"))
    sets = written(sets.withColumn("n", F.size("_s").cast("long")).filter("n > 0"), "sets")
    d = S.explode_terms(sets, "_s", keep=("n",))
    q = S.token_sets(V.search_queries(t), "query_id", TX.split_words(TX.clean_full("text")))
    return d, q, sets.select("id")


def jaccard_top_k(t: Tables, k: int = 5) -> DataFrame:
    d, q, with_tokens = jaccard_sets(t)
    return _always_k(t, B.jaccard_top_k(q, d, k), q, with_tokens, k, plain=0.0, zero=0.0, zero_zero=0.0)


#: Characters of the strings under which passages without an inner token are looked up.
GRAM = 4


def _rarest(wanted: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, term): of a query's keys ``(query_id, term)`` the one that
    fewest documents ``(doc_id, term)`` have."""
    df = (terms.join(wanted.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return (wanted.join(df, "term", "left").groupBy("query_id")
            .agg(F.min_by("term", F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term"))
                 .alias("term")))


def _substrings(col: str, width: int):
    """The distinct substrings of a width; a shorter text has none."""
    if width == 0:
        return F.array(F.lit(""))
    places = F.sequence(F.lit(1), F.greatest(F.char_length(col) - width + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substr(F.col(col), i, F.lit(width))))


def containment_truth(t: Tables) -> DataFrame:
    """(query_id, doc_id) where the document contains the passage verbatim.

    A document that contains a passage holds every *inner* token of it (the
    first and last may be cut words), so each passage is looked up under one
    key, its rarest inner token.  A passage without an inner token is looked
    up under its rarest substring of ``GRAM`` characters (itself, if it is
    shorter).  The documents found there are verified with ``instr``."""
    toks = TX.split_words(TX.clean_full("text"))
    queries = V.search_queries(t).select(
        "query_id", F.col("text").alias("qtext"),
        F.when(F.size(toks) > 2, F.slice(toks, 2, F.size(toks) - 2)).alias("inner"))
    docs = V.search_corpus(t).select("doc_id", F.col("text").alias("dtext"))
    terms = (docs.select("doc_id", F.explode(F.array_distinct(TX.split_words(TX.clean_full("dtext"))))
                         .alias("term")))
    wanted = (queries.filter(F.col("inner").isNotNull())
              .select("query_id", F.explode(F.array_distinct("inner")).alias("term")))
    # Only the passages' terms are written, so the texts are tokenised once.
    terms = written(terms.join(maybe_broadcast(wanted.select("term").distinct()), "term", "left_semi"),
                    "passage-terms")
    # A passage with a key that no document has is contained nowhere.
    found = terms.join(_rarest(wanted, terms), "term").select("query_id", "doc_id")
    bare = (queries.filter(F.col("inner").isNull() & F.col("qtext").isNotNull())
            .withColumn("width", F.least(F.char_length("qtext"), F.lit(GRAM))))
    for (width,) in bare.select("width").distinct().collect():       # GRAM + 1 values at most
        wanted = bare.filter(F.col("width") == width).select(
            "query_id", F.explode(_substrings("qtext", width)).alias("term"))
        grams = docs.select("doc_id", F.explode(_substrings("dtext", width)).alias("term"))
        found = found.unionByName(grams.join(_rarest(wanted, grams), "term").select("query_id", "doc_id"))
    return (found.join(queries.select("query_id", "qtext"), "query_id").join(docs, "doc_id")
            .filter(F.instr("dtext", F.col("qtext")) > 0).select("query_id", "doc_id"))


def search_evaluation(t: Tables, k: int = 5) -> DataFrame:
    """Outcome per benchmark query of the TF-IDF cosine top-k; a query
    without any correct document has no result."""
    ev = S.evaluate_hits(cosine_top_k(t, k), containment_truth(t),
                         V.search_queries(t).select("query_id"))
    return ev.select("query_id", "best_rank", "outcome")


def search_hit_rate(t: Tables, k: int = 5) -> DataFrame:
    """The report over all queries."""
    return S.hit_rate(search_evaluation(t, k))


# Dense spaces over the top terms -----------------------------------------
DENSE_TERMS = 1200
LSI_TOPICS = 100


def dense_tfidf(t: Tables, n_terms: int = DENSE_TERMS, form: str = "smooth"):
    """Corpus and query TF-IDF unit vectors ``(id, terms, values)`` over the
    ``n_terms`` most frequent terms, the vectoriser's max_features, and their
    dimension.  The terms' places in the texts are written once; the passes
    over the vectors weigh them as they read."""
    from tessera.operators import lsa

    docs, queries = V.search_corpus(t), V.search_queries(t)
    tokens = TX.word_tokens("text")
    counts = (S.explode_terms(docs.select(F.col("doc_id").alias("id"), tokens.alias("_t")), "_t")
              .groupBy("term").agg(F.count(F.lit(1)).alias("tf")))
    terms = [r[0] for r in S.top_terms(counts, n_terms).collect()]            # n_terms at most
    places = written(lsa.term_places(docs, "doc_id", terms, tokens), "places")
    held = (places.select("id", F.explode(F.array_distinct("terms")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    n = docs.select("doc_id").distinct().count()
    idf = np.zeros(n_terms)
    for row in S.idf_of(held, n, form).collect():
        idf[row["term"]] = row["idf"]
    return (lsa.unit_vectors(places, idf),
            lsa.unit_vectors(lsa.term_places(queries, "query_id", terms, tokens), idf), n_terms)


def pca_top_k(t: Tables, k_components: int = 10, k: int = 5, metric: str = "cosine") -> DataFrame:
    from tessera.operators import lsa

    docs, queries, dim = dense_tfidf(t)
    pca = lsa.fit_pca(docs, k_components, dim)
    return lsa.dense_top_k(lsa.project(queries, pca.components, pca.mean, dim),
                           lsa.project(docs, pca.components, pca.mean, dim), k, metric)


def lsi_top_k(t: Tables, topics: int = LSI_TOPICS, k: int = 5) -> DataFrame:
    from tessera.operators import lsa

    docs, queries, dim = dense_tfidf(t, form="log2")
    axes = lsa.fit_lsi(docs, topics, dim)
    res = lsa.dense_top_k(lsa.project(queries, axes, dim=dim), lsa.project(docs, axes, dim=dim), k, "cosine")
    return res.withColumn("score", F.round(F.col("score") * 100, 2))

"""Registered queries: one per operator of the survey inventory.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables.  The DuckDB oracle for the same key lives in
``tessera/oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tessera.plans import extracts as X
from tessera.sources import views as V
from tessera.sources.tables import Tables

FLAGSHIP = "e04_all_horizons"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# ---- 2A / 2B / 2C / 2D: the five extracts --------------------------------------
@query("d01_payment_extract")
def _d01(spark, sf):
    return X.payment_extract(_t(spark, sf))


@query("c05_payment_extract_min_by")
def _c05(spark, sf):
    return X.payment_extract(_t(spark, sf), first_pay_join=False)


@query("a02_user_child_extract")
def _a02(spark, sf):
    return X.user_child_extract(_t(spark, sf))


@query("d02_daily_event_log")
def _d02(spark, sf):
    return X.daily_event_log(_t(spark, sf))


@query("d03_engagement_extract")
def _d03(spark, sf):
    return X.engagement_extract(_t(spark, sf))


@query("d04_user_child_brand")
def _d04(spark, sf):
    return X.user_child_brand_extract(_t(spark, sf))


@query("d05_learning_detail")
def _d05(spark, sf):
    return X.learning_detail_extract(_t(spark, sf))


@query("b01_cohort_narrow")
def _b01(spark, sf):
    return X.payment_extract(_t(spark, sf), start="2023-12-31", end="2024-01-01")


@query("a04_usage_union")
def _a04(spark, sf):
    return (X.usage_records_all(_t(spark, sf))
            .groupBy("ActionType").agg(F.count(F.lit(1)).alias("n"),
                                       F.round(F.sum("UsageTime"), 6).alias("usage")))


def _new_folder(spark, name):
    import uuid

    from tessera.session import scratch_path

    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("a01_a02_csv_extract")
def _a01(spark, sf):
    """A headerless CSV extract read with a schema and named by position."""
    from tessera.sources import tables as TB

    path = _new_folder(spark, "csv")
    _t(spark, sf).events.select("event_id", "user_id", "event_type").write.csv(path)
    raw = TB.read_csv(spark, path, "a long, b long, c string", header=False)
    return TB.rename_positional(raw, ["event_id", "user_id", "event_type"])


A03_EXTRACTS = {
    "per_user": "SELECT user_id AS k, count(*) AS n FROM events GROUP BY user_id",
    "per_customer": "SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey",
}


@query("a03_sql_extracts")
def _a03(spark, sf):
    """The batch crawl: SQL text per extract, written and read back."""
    from tessera.sources import tables as TB

    written = TB.run_sql_extracts(_t(spark, sf), A03_EXTRACTS, _new_folder(spark, "crawl"))
    out = None
    for name, path in written.items():
        part = spark.read.parquet(path).select(F.lit(name).alias("extract"), "k", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("a05_write_by_horizon")
def _a05(spark, sf):
    """The horizon tables written partitioned; rows a reader finds per horizon."""
    from tessera.sources import tables as TB

    path = _new_folder(spark, "horizons")
    TB.write_by_horizon(FT.active_days_features(_t(spark, sf), list(range(1, 9))), path)
    return spark.read.parquet(path).groupBy("horizon").agg(F.count(F.lit(1)).alias("users"))


@query("a07_annotation_recode")
def _a07(spark, sf):
    """A marked sheet (derived from the feedback ids) joined and recoded."""
    from tessera.sources import tables as TB

    pairs = _pairs(spark, sf).select("FeedbackID")
    number = F.pmod(F.crc32(F.col("FeedbackID").cast("string").cast("binary")), F.lit(4))
    sheet = pairs.filter(number < 3).select("FeedbackID", F.element_at(
        F.array(F.lit("x"), F.lit(" V "), F.lit("0")), (number + 1).cast("int")).alias("lookup_in_question"))
    return TB.annotation_recode(pairs, sheet).select("FeedbackID", "lookup_in_question")


@query("views_demographics")
def _demo(spark, sf):
    return V.demographics(_t(spark, sf))


# ---- 2E / 2F: per-user features ------------------------------------------------
from tessera.operators import aggregates as A  # noqa: E402
from tessera.operators import horizons as H  # noqa: E402
from tessera.operators import transforms as T  # noqa: E402
from tessera.plans import feature_tables as FT  # noqa: E402

_KEYS = ["horizon", "UserID"]


def _action(t, hs):
    return H.active_days(FT.engagement_with_tiers(t), hs)


@query("e15_active_days_features")
def _e15(spark, sf):
    return FT.active_days_features(_t(spark, sf), 1)


@query("e04_all_horizons")
def _e04(spark, sf):
    return FT.active_days_features(_t(spark, sf), list(range(1, 9)))


@query("e03_active_days_rows")
def _e03(spark, sf):
    return _action(_t(spark, sf), 1).select(
        "horizon", "UserID", "EventDate", "ActionType", "MinFirstDay", "ZeroDay",
        "CutoffDay", "ScaleActionDay", "ScaleGapday")


@query("d14_d16_rfm_modes")
def _d14(spark, sf):
    return A.rfm(_action(_t(spark, sf), 2), _KEYS)


@query("d15_medians")
def _d15(spark, sf):
    return A.medians(_action(_t(spark, sf), 2), _KEYS)


@query("d12_brand_tier_pivot")
def _d12(spark, sf):
    return A.pivot_agg(_action(_t(spark, sf), 2), _KEYS, "TypeBrand", FT.TIERS,
                       {"Brand": F.lit(1)}, agg="count", name="{value}{measure}")


@query("d10_action_pivot")
def _d10(spark, sf):
    return A.pivot_agg(_action(_t(spark, sf), 2), _KEYS, "ActionType", FT.ACTIONS,
                       {"Record": "Records", "UsageTime": "UsageTime"})


@query("d09_subject_pivot")
def _d09(spark, sf):
    learn = H.active_days(FT.learning_with_gap(_t(spark, sf)), 2)
    return A.pivot_agg(learn, _KEYS, "SubjectName", V.SUBJECTS,
                       {"Interaction": "InteractionLearn", "IsCompleted": "IsCompleted",
                        "Record": "Records", "UsageTime": "UsageTime"})


@query("d17_distinct_tiers")
def _d17(spark, sf):
    return A.distinct_count(_action(_t(spark, sf), 2), _KEYS, "TypeBrand", "NoTypeBrand")


@query("f02_brand_tiers")
def _f02(spark, sf):
    return FT.engagement_with_tiers(_t(spark, sf)).select("DeviceBrand", "TypeBrand").distinct()


# ---- E14 cut-off design and its parts ------------------------------------------
from tessera.operators.joins import remove_keys  # noqa: E402


def _users_x(t):
    return remove_keys(X.user_child_brand_extract(t), V.fake_users(t))


def _eng_x(t):
    return remove_keys(X.engagement_extract(t), V.fake_users(t))


@query("c04_remove_fake_users")
def _c04(spark, sf):
    t = _t(spark, sf)
    return remove_keys(X.payment_extract(t), V.fake_users(t))


@query("e01_first_active_day")
def _e01(spark, sf):
    return H.first_active_day(_eng_x(_t(spark, sf))).select(
        "UserID", "EventDate", "ActionType", "MinFirstDay", "ZeroDay", "lateUser")


@query("e02_cutoff_exclusive")
def _e02(spark, sf):
    return H.cutoff_exclusive(_eng_x(_t(spark, sf)), 3).select(
        "UserID", "EventDate", "ActionType", "cutoffDay", "usedDays", "lateUser")


@query("e05_label_relative")
def _e05(spark, sf):
    return FT.cutoff_engagement(_t(spark, sf), 3, 14).select(
        "UserID", "EventDate", "ActionType", "gapday", "Label")


@query("e06_label_absolute")
def _e06(spark, sf):
    return X.payment_extract(_t(spark, sf)).select(
        "UserID", "gapday", H.label_absolute("gapday", 31).alias("LabelB"))


@query("e07_label_scaled")
def _e07(spark, sf):
    a = _action(_t(spark, sf), 1)
    return a.groupBy("UserID").agg(H.label_scaled(F.max("ScaleGapday"), 31).alias("LabelC"))


@query("e08_ols_slope")
def _e08(spark, sf):
    return _eng_x(_t(spark, sf)).groupBy("UserID", "ActionType").agg(
        H.ols_slope("nth_day_from_registration", "UsageTime").alias("slope"))


@query("e09_scaled_slope")
def _e09(spark, sf):
    return _eng_x(_t(spark, sf)).groupBy("UserID", "ActionType").agg(
        H.scaled_slope("nth_day_from_registration", "UsageTime").alias("slope"))


@query("e10_successive_diff")
def _e10(spark, sf):
    e = _eng_x(_t(spark, sf)).select("UserID", "ActionType", "EventDate",
                                     "nth_day_from_registration", "UsageTime")
    return H.successive_diff(e, ["UserID", "ActionType"], ["nth_day_from_registration"],
                             "UsageTime").select("UserID", "ActionType", "EventDate", "diff")


@query("e11_interest_by_action")
def _e11(spark, sf):
    return H.interest_by_action(FT.cutoff_engagement(_t(spark, sf), 3, 14))


@query("e12_e13_most_interest")
def _e12(spark, sf):
    return H.most_interest(H.interest_by_action(FT.cutoff_engagement(_t(spark, sf), 3, 14)))


@query("e14_cutoff_features")
def _e14(spark, sf):
    return FT.cutoff_features(_t(spark, sf), 3, 14)


@query("d06_d08_children_summary")
def _d06(spark, sf):
    return A.children_summary(_users_x(_t(spark, sf)), V.AS_OF_DATE)


def _merged(t):
    e = FT.cutoff_engagement(t, 3, 14)
    return A.collapse_day_action(e, ["UserID", "EventDate", "ActionType"],
                                 ["Opentime", "UsageTime", "Records", "PaymentScreenTime"],
                                 ["cutoffDay", "lateUser", "Label"])


@query("d31_collapse_day_action")
def _d31(spark, sf):
    return _merged(_t(spark, sf))


@query("d13_totals")
def _d13(spark, sf):
    return A.totals(_merged(_t(spark, sf)),
                    {"TotalOpentime": "Opentime", "TotalUsageTime": "UsageTime",
                     "TotalRecords": "Records", "TotalPayscreentime": "PaymentScreenTime"})


@query("d11_action_measure_pivot")
def _d11(spark, sf):
    return A.pivot_agg(_merged(_t(spark, sf)), "UserID", "ActionType", FT.ACTIONS,
                       {"Opentime": "Opentime", "UsageTime": "UsageTime",
                        "Records": "Records", "PaymentScreenTime": "PaymentScreenTime"})


@query("f01_rare_brand_collapse")
def _f01(spark, sf):
    return T.collapse_rare(_users_x(_t(spark, sf)), "DeviceBrand").select(
        "UserID", "ChildID", "DeviceBrand")


@query("f03_brand_one_hot")
def _f03(spark, sf):
    b = T.collapse_rare(_users_x(_t(spark, sf)), "DeviceBrand")
    out = T.one_hot_per_key(b, "UserID", "DeviceBrand", FT.BRAND_COLUMNS, prefix="brand_")
    return out.toDF(*[c.replace(" ", "_") for c in out.columns])


@query("f03_interest_one_hot")
def _f03i(spark, sf):
    """MostInterest and MostAccumulate as 0/1 columns, one for each action found."""
    m = H.most_interest(H.interest_by_action(FT.cutoff_engagement(_t(spark, sf), 3, 14)))
    out = m.select("UserID", "MostInterest", "MostAccumulate")
    for c in ("MostInterest", "MostAccumulate"):
        out = T.one_hot(out, c, T.found_values(m, c), prefix=f"{c}_").drop(c)
    return out.fillna(0)


# ---- 2H: vectorisation and search ------------------------------------------------
from tessera.operators import search as S  # noqa: E402
from tessera.plans import search_plans as SP  # noqa: E402


@query("h01_count_vectors")
def _h01(spark, sf):
    return S.term_counts(V.search_corpus(_t(spark, sf)), "doc_id", stop_words=SP.STOP_WORDS) \
        .select(F.col("id").alias("doc_id"), "term", "tf")


@query("h02_tfidf_sklearn")
def _h02(spark, sf):
    d_vec, _, _ = SP.tfidf_vectors(_t(spark, sf))
    return d_vec.select(F.col("id").alias("doc_id"), "term", F.round("w", 10).alias("w"))


@query("h03_tfidf_max_features")
def _h03(spark, sf):
    d_vec, _, _ = SP.tfidf_vectors(_t(spark, sf), max_features=1000)
    return d_vec.select(F.col("id").alias("doc_id"), "term", F.round("w", 10).alias("w"))


@query("h04_tfidf_gensim")
def _h04(spark, sf):
    d_vec, _, _ = SP.tfidf_vectors(_t(spark, sf), form="log2")
    return d_vec.select(F.col("id").alias("doc_id"), "term", F.round("w", 10).alias("w"))


@query("h05_cosine_top5")
def _h05(spark, sf):
    return SP.cosine_top_k(_t(spark, sf), 5)


@query("h06_count_cosine_top5")
def _h06(spark, sf):
    return SP.count_cosine_top_k(_t(spark, sf), 5)


@query("h07_euclid_knn5")
def _h07(spark, sf):
    return SP.euclid_top_k(_t(spark, sf), 5)


@query("h14_jaccard_top5")
def _h14(spark, sf):
    return SP.jaccard_top_k(_t(spark, sf), 5)


@query("h24_containment_truth")
def _h24t(spark, sf):
    return SP.containment_truth(_t(spark, sf))


@query("h24_search_hit_rate")
def _h24r(spark, sf):
    return SP.search_hit_rate(_t(spark, sf))


@query("h24_search_evaluation")
def _h24(spark, sf):
    return SP.search_evaluation(_t(spark, sf), 5)


# ---- 2G: text preparation ---------------------------------------------------------
from tessera.functions import text as TX  # noqa: E402
from tessera.operators import textops as TO  # noqa: E402


def _pairs(spark, sf):
    return V.feedback_pairs(_t(spark, sf))


@query("g01_g04_cleaning")
def _g01(spark, sf):
    d = V.formula_documents(_t(spark, sf))
    return d.select("doc_id", TX.clean_full("text").alias("full"),
                    TX.clean_light("text").alias("light"),
                    TX.clean_accent_delete("text").alias("accent_deleted"),
                    TX.clean_letters("text").alias("letters"))


@query("g06_stop_word_removal")
def _g06(spark, sf):
    d = _t(spark, sf).documents
    toks = TX.remove_words(TX.word_tokens("text"), SP.STOP_WORDS)
    return d.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                    F.array_join(toks, " ").alias("tokens"))


@query("g07_length_features")
def _g07(spark, sf):
    d = _t(spark, sf).documents
    return d.select("doc_id", TX.n_chars("text").alias("n_chars"),
                    TX.n_words("text").alias("n_words"),
                    TX.avg_word_len("text").alias("avg_word_len"))


@query("g08_dedup_pairs")
def _g08(spark, sf):
    return TO.dedup_first(_pairs(spark, sf), ["LookupText", "QuestionText"], "FeedbackID",
                          ["FeedbackID", "FeedbackType", "FeedbackResult", "HumanFeedback"])


@query("g09_dedup_documents")
def _g09(spark, sf):
    return TO.dedup_first(_t(spark, sf).documents.select("doc_id", "text", "lang"),
                          ["text"], "doc_id", ["doc_id", "lang"])


@query("g10_duplicate_audit")
def _g10(spark, sf):
    return TO.duplicate_audit(_pairs(spark, sf))


@query("g11_duplicated_lookup_only")
def _g11(spark, sf):
    return TO.duplicated_on_one_side(_pairs(spark, sf), "LookupText", "QuestionText") \
        .select("FeedbackID", "HumanFeedback")


@query("g11_duplicated_question_only")
def _g11q(spark, sf):
    return TO.duplicated_on_one_side(_pairs(spark, sf), "QuestionText", "LookupText") \
        .select("FeedbackID", "HumanFeedback")


@query("b14_drop_columns")
def _b14(spark, sf):
    """Columns that exist or not are dropped alike."""
    return V.user_profile(_t(spark, sf)).drop("UserJoinedDate", "NoSuchColumn")


@query("g12_short_text_share")
def _g12(spark, sf):
    c = _t(spark, sf).conversations
    return TO.short_text_share(c, TX.n_words("text"), 5)


@query("g13_g16_formula_split")
def _g13(spark, sf):
    d = V.formula_documents(_t(spark, sf))
    forms = TX.formulas("text")
    return d.select(
        "doc_id", F.size(forms).cast("long").alias("n_formulas"),
        F.array_join(forms, " | ").alias("formulas"),
        F.size(TX.operator_formulas(forms)).cast("long").alias("n_operator_formulas"),
        F.length(TX.strip_formulas("text")).cast("long").alias("text_len"),
        TX.strip_latex(F.array_join(forms, " ")).alias("formula_plain"),
        F.round(TX.text_formula_ratio("text", "text"), 10).alias("text_ratio"),
        F.round(TX.text_formula_ratio("text", "formula"), 10).alias("formula_ratio"))


@query("g13_g17_variants")
def _g13v(spark, sf):
    """Display formulas, the token-count ratios and the first text kind."""
    d = V.formula_documents(_t(spark, sf))
    kinds = d.select("doc_id", "text", *TX.kind_parts("text"))
    every = TX.formulas("text", display=True)
    return kinds.select(
        "doc_id", F.size(every).cast("long").alias("n_formulas"),
        F.array_join(every, " | ").alias("formulas"),
        F.length(TX.strip_formulas("text", display=True)).cast("long").alias("text_len"),
        F.round(TX.token_formula_ratio("text", "text"), 10).alias("text_ratio"),
        F.round(TX.token_formula_ratio("text", "formula"), 10).alias("formula_ratio"),
        TX.text_kind_v0_from().alias("kind_v0"))


@query("g17_g18_text_kind")
def _g17(spark, sf):
    d = V.formula_documents(_t(spark, sf)).select("doc_id", *TX.kind_parts("text"))
    return d.select("doc_id", TX.text_kind_from(1).alias("kind_v1"),
                    TX.text_kind_from(2).alias("kind_v2"),
                    TX.text_kind_majority_from().alias("kind_majority"))


@query("g19_non_ascii_share")
def _g19(spark, sf):
    d = _t(spark, sf).documents
    return d.select("doc_id", F.round(TX.non_ascii_share("text", "word"), 10).alias("word_share"),
                    F.round(TX.non_ascii_share("text", "char"), 10).alias("char_share"))


def _pair_tokens(spark, sf):
    p = _pairs(spark, sf)
    return p.select("FeedbackID", TX.text_tokens("LookupText").alias("lt"),
                    TX.text_tokens("QuestionText").alias("qt"))


@query("g20_vocabulary")
def _g20(spark, sf):
    return TO.vocabulary(_pair_tokens(spark, sf), ["lt", "qt"])


def _vocab_idf(spark, sf):
    p = _pairs(spark, sf)
    voc = TO.vocabulary(_pair_tokens(spark, sf), ["lt", "qt"])
    pre = lambda c: TX.word_tokens(TX.clean_letters(TX.strip_formulas(c)))
    corpus = p.select(F.concat(F.lit("l"), F.col("FeedbackID").cast("string")).alias("doc"),
                      F.explode_outer(pre("LookupText")).alias("term")) \
        .unionByName(p.select(F.concat(F.lit("q"), F.col("FeedbackID").cast("string")).alias("doc"),
                              F.explode_outer(pre("QuestionText")).alias("term"))) \
        .filter(F.col("term").isNotNull())
    n = p.agg(F.count(F.lit(1)) * 2).scalar()
    return TO.vocabulary_idf(voc, corpus, n)


@query("g21_vocabulary_idf")
def _g21(spark, sf):
    return _vocab_idf(spark, sf).select("token", "token_id", F.round("idf", 10).alias("idf"))


@query("g22_g23_sequences")
def _g22(spark, sf):
    pt = _pair_tokens(spark, sf)
    voc = TO.vocabulary(pt, ["lt", "qt"])
    s = TO.to_sequences(pt, "FeedbackID", "lt", voc, "token_id", out="seq")
    # Padded to 800, or to the longest look-up if that is longer.
    longest = pt.agg(F.greatest(F.lit(800), F.max(F.size("lt")))).scalar()
    padded = TX.pad("seq", longest, -1)
    return s.select("FeedbackID", F.array_join("seq", " ").alias("seq"),
                    F.array_join(padded, " ").alias("padded"),
                    F.size(padded).cast("long").alias("padded_len"))


@query("g24_top_terms")
def _g24(spark, sf):
    tf = S.term_counts(_t(spark, sf).documents, "doc_id")
    return TO.top_terms_by(tf, 50)


def _pair_kinds(spark, sf):
    p = _pairs(spark, sf)
    lk = p.select("FeedbackID", "QuestionText", *TX.kind_parts("LookupText")) \
        .select("FeedbackID", "QuestionText", TX.text_kind_from(2).alias("lookup_kind"))
    return lk.select("FeedbackID", "lookup_kind", *TX.kind_parts("QuestionText")) \
        .select("FeedbackID", "lookup_kind", TX.text_kind_from(2).alias("question_kind"))


@query("g25_mismatched_kinds")
def _g25m(spark, sf):
    """The three subsets of pairs whose kinds do not fit together."""
    lk, qk = F.col("lookup_kind"), F.col("question_kind")
    subsets = F.filter(F.array(
        F.when((lk != "Math and Text") & (qk == "Math and Text"), "mixed question"),
        F.when((lk == "Math only") & (qk != "Math only"), "math look-up"),
        F.when((lk == "Text only") & (qk != "Text only"), "text look-up")), lambda x: x.isNotNull())
    return _pair_kinds(spark, sf).select(F.explode(subsets).alias("subset"), "FeedbackID",
                                         "lookup_kind", "question_kind")


@query("g25_kind_summary")
def _g25(spark, sf):
    k = _pair_kinds(spark, sf)
    return k.groupBy("lookup_kind", "question_kind").agg(F.count(F.lit(1)).alias("n"))


# ---- paired similarity, rankers, feedback evaluation -------------------------------
from tessera.plans import pair_plans as PP  # noqa: E402


@query("h15_pair_cosine")
def _h15(spark, sf):
    return PP.pair_cosine(_t(spark, sf))


@query("h16_pair_jaccard")
def _h16(spark, sf):
    return PP.pair_jaccard(_t(spark, sf))


@query("h17_sequence_cosine")
def _h17(spark, sf):
    return PP.sequence_cosine(_t(spark, sf))


@query("h18_h19_edit_and_fuzzy")
def _h18(spark, sf):
    return PP.pair_edit_scores(_t(spark, sf))


@query("h20_formula_score")
def _h20(spark, sf):
    return PP.pair_formula_scores(_t(spark, sf))


@query("h21_combined_ranker_v1")
def _h21(spark, sf):
    return PP.combined_ranker(_t(spark, sf), 1)


@query("h22_combined_ranker_v2")
def _h22(spark, sf):
    return PP.combined_ranker(_t(spark, sf), 2)


@query("h23_batch_search_top1")
def _h23(spark, sf):
    return PP.batch_search_top1(_t(spark, sf))


@query("h23_batch_ranker_top1")
def _h23r(spark, sf):
    from tessera.plans import ranker_plans

    return ranker_plans.batch_ranker_top1(_t(spark, sf))


@query("h25_feedback_evaluation")
def _h25(spark, sf):
    return PP.feedback_evaluation(_t(spark, sf))


@query("h26_agreement")
def _h26(spark, sf):
    return PP.agreement(_t(spark, sf))


@query("h27_review_list")
def _h27(spark, sf):
    return PP.review_list(_t(spark, sf), 0.0, 1.0)


@query("h28_score_distribution")
def _h28(spark, sf):
    return PP.score_distribution(_t(spark, sf))


# ---- reports, joins, transforms, scalar functions ----------------------------------
from tessera.functions import dates as DT  # noqa: E402
from tessera.plans import reports as R  # noqa: E402


@query("d18_value_counts")
def _d18(spark, sf):
    return A.value_counts(X.engagement_extract(_t(spark, sf)), "DeviceBrand")


@query("d19_crosstab_pct")
def _d19(spark, sf):
    p = _pairs(spark, sf).withColumn("FeedbackResult", R.recode_result("FeedbackResult"))
    return A.crosstab_pct(p, "FeedbackResult", "HumanFeedback")


@query("d20_multi_stat_pivot")
def _d20(spark, sf):
    p = R.engagement_payer(_t(spark, sf)).filter("payer")
    return A.multi_stat_pivot(p, "nth_day_from_registration", "ActionType", FT.ACTIONS, "UsageTime")


@query("d21_weekday_action_payer")
def _d21(spark, sf):
    return R.weekday_action_payer(_t(spark, sf))


@query("d22_weekday_counts")
def _d22(spark, sf):
    return R.weekday_counts(_t(spark, sf))


@query("d23_box_stats")
def _d23(spark, sf):
    return A.box_stats(R.engagement_payer(_t(spark, sf)), ["Event_dayofweek", "payer"], "UsageTime")


@query("d24_column_profile")
def _d24(spark, sf):
    return A.column_profile(X.engagement_extract(_t(spark, sf)), R.MEASURES)


@query("d25_correlation")
def _d25(spark, sf):
    return A.correlation_long(X.engagement_extract(_t(spark, sf)), R.MEASURES)


@query("d26_histogram")
def _d26(spark, sf):
    return A.histogram(R.engagement_payer(_t(spark, sf)), "UsageTime", 5.0, ["payer"])


@query("d27_daily_counts")
def _d27(spark, sf):
    return X.engagement_extract(_t(spark, sf)).groupBy("EventDate").agg(
        F.count(F.lit(1)).alias("n"))


@query("c08_hour_diff_cases")
def _c08(spark, sf):
    return R.hour_diff_cases(_t(spark, sf))


@query("d28_use_first_counts")
def _d28(spark, sf):
    return R.use_first_counts(_t(spark, sf))


@query("d29_brand_matrix")
def _d29(spark, sf):
    logs = X.event_logs_all(_t(spark, sf))
    # The known brands always have a column; others get one when they occur.
    found = [b for b in T.found_values(logs, "DeviceBrand") if b not in V.BRANDS]
    return A.brand_matrix(logs, [*V.BRANDS, *found])


@query("d30_first_row")
def _d30(spark, sf):
    e = X.engagement_extract(_t(spark, sf))
    return A.first_row(e, "UserID", ["EventDate", "ActionType"]).select(
        "UserID", "UserJoinedDate", "EventDate", "ActionType")


@query("d32_duplicate_audit")
def _d32(spark, sf):
    ev = _t(spark, sf).events.select("user_id", "event_type")
    return A.duplicate_audit(ev)


@query("c07_learning_fanout")
def _c07(spark, sf):
    return R.learning_fanout(_t(spark, sf))


@query("c09_not_match_in_match")
def _c09(spark, sf):
    return R.not_match_in_match(_t(spark, sf))


@query("c10_label_disagreements")
def _c10(spark, sf):
    return R.label_disagreements(_t(spark, sf))


@query("f06_min_max_scale")
def _f06(spark, sf):
    e = X.engagement_extract(_t(spark, sf)).select("UserID", "EventDate", "ActionType", "UsageTime")
    return T.min_max_scale(e, "UsageTime", "UsageScaled").withColumn(
        "UsageScaled", F.round("UsageScaled", 10))


@query("f08_word_diff_bins")
def _f08(spark, sf):
    return R.word_diff_bins(_t(spark, sf))


@query("f09_top_brands")
def _f09(spark, sf):
    u = X.user_child_brand_extract(_t(spark, sf))
    return A.value_counts(T.top_categories(u, "DeviceBrand", 120, out="TopBrand"), "TopBrand")


@query("b05_parse_ts19")
def _b05(spark, sf):
    ev = _t(spark, sf).events
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".000 +0700"))
    return ev.select("event_id", DT.parse_ts19(raw).alias("parsed"))


@query("b06_b07_calendar_parts")
def _b06(spark, sf):
    e = X.engagement_extract(_t(spark, sf))
    return e.select("UserID", "EventDate", "ActionType",
                    DT.hour_of("firstuse").alias("firstuse_hour"),
                    DT.hour_of("lastuse").alias("lastuse_hour"),
                    DT.day_of_month("lastuse").alias("lastuse_day"),
                    DT.weekday_mon0("lastuse").alias("lastuse_dayofweek"),
                    DT.month_of("UserJoinedDate").alias("JoinMonth"),
                    DT.weekday_name("EventDate").alias("Event_dayofweek"))


@query("b08_b09_child_age")
def _b08(spark, sf):
    c = V.child_profile(_t(spark, sf))
    return c.select("ChildID", DT.age_years("ChildBday", V.AS_OF_DATE).alias("Age"),
                    F.month("ChildBday").alias("monthBday"),
                    DT.age_days_365("ChildBday", V.AS_OF_DATE).alias("age_365"))


@query("b10_pay_date")
def _b10(spark, sf):
    p = X.payment_extract(_t(spark, sf)).filter(F.col("gapday").isNotNull())
    return p.select("UserID", DT.pay_date("UserJoinedDate", "gapday").alias("payday"))


@query("b13_label_recode")
def _b13(spark, sf):
    p = _pairs(spark, sf)
    return p.groupBy(R.recode_result("FeedbackResult").alias("result")).agg(
        F.count(F.lit(1)).alias("n"))


@query("j02_global_top_users")
def _j02(spark, sf):
    e = X.engagement_extract(_t(spark, sf))
    tot = e.groupBy("UserID").agg(F.round(F.sum("UsageTime"), 6).alias("usage"))
    return tot.orderBy(F.desc("usage"), "UserID").limit(10)


@query("j03_set_operations")
def _j03(spark, sf):
    t = _t(spark, sf)
    pay = X.payment_extract(t)
    free = pay.filter(F.col("gapday").isNull()).select("UserID")
    users = V.user_profile(t).select("UserID")
    return users.join(free, "UserID", "left_anti").union(V.fake_users(t)).distinct()


# ---- 2I: models ---------------------------------------------------------------------
from tessera.operators import models as M  # noqa: E402

# Not features: keys, the label, what the label is made of, and text.
ML_OTHER = {"UserID", "horizon", "Label", "gapday", "ScaleGapday", "firstPaymentType"}


def _ml_features(table) -> list[str]:
    """Every numeric column of the feature table that is not in ML_OTHER."""
    return [f.name for f in table.schema
            if f.name not in ML_OTHER and isinstance(f.dataType, NumericType)]


def _ml_table(spark, sf, horizon: int = 1):
    """The training table, written once a session and folder: iterative fits
    and the metric queries read it instead of running the feature plan again."""
    from tessera.session import written

    cached = _ML_TABLES.setdefault(spark.sparkContext.applicationId, {})
    if (sf, horizon) not in cached:
        f = FT.active_days_features(_t(spark, sf), horizon)
        cached[sf, horizon] = written(f.select(
            "UserID", "firstPaymentType", "Label",
            *[F.col(c).cast("double").alias(c) for c in _ml_features(f)]), "ml-table")
    return cached[sf, horizon]


_ML_TABLES: dict[str, dict] = {}


def _split(spark, sf):
    """Train and test rows (written) and the features."""
    from tessera.session import written

    f = _ml_table(spark, sf).fillna(0)
    tr, te = M.stratified_split(f, "UserID")
    return written(tr, "train"), written(te, "test"), _ml_features(f)


def _rule_scored(spark, sf):
    """A deterministic baseline scorer (usage saturation) — a scored table
    whose metrics are SQL-checkable."""
    f = _ml_table(spark, sf)
    s = F.col("TotalUsageTime") / (F.col("TotalUsageTime") + 60.0)
    return f.select("UserID", "firstPaymentType", "Label", s.alias("score"),
                    (s >= 0.5).cast("int").alias("prediction"))


def _rule_scored_b(spark, sf):
    f = _ml_table(spark, sf)
    s = F.col("PaymentScreenFrequent") / (F.col("PaymentScreenFrequent") + 3.0)
    return f.select("UserID", "Label", s.alias("score"))


@query("i01_stratified_split")
def _i01(spark, sf):
    tr, te = M.stratified_split(_ml_table(spark, sf), "UserID")
    return tr.select("UserID", "Label", F.lit("train").alias("split")).unionByName(
        te.select("UserID", "Label", F.lit("test").alias("split")))


@query("i02_class_weights")
def _i02(spark, sf):
    f = _ml_table(spark, sf)
    out = None
    for m in ["balanced", "inverse", "isns", "ens"]:
        w = M.class_weights(f, method=m).select(F.lit(m).alias("method"), "Label",
                                                 F.round("weight", 10).alias("weight"))
        out = w if out is None else out.unionByName(w)
    return out


@query("i03_imbalance_ratio")
def _i03(spark, sf):
    return M.imbalance_ratio(_ml_table(spark, sf))


@query("i04_undersample")
def _i04(spark, sf):
    return M.undersample(_ml_table(spark, sf), "UserID").select("UserID", "Label")


@query("i05_smote_balance")
def _i05b(spark, sf):
    """Class sizes after over-sampling, and the original rows still there."""
    f = _ml_table(spark, sf).fillna(0)
    out = M.smote(f, _ml_features(f), "UserID")
    return out.groupBy("Label").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("UserID").startswith("syn_")).alias("original"),
        F.countDistinct("UserID").alias("distinct_keys"))


@query("i05_smote")
def _i05(spark, sf):
    f = _ml_table(spark, sf).fillna(0)
    return M.smote(f, _ml_features(f), "UserID")


@query("i06_i10_classifiers")
def _i06(spark, sf):
    tr, te, features = _split(spark, sf)
    trw = M.with_weights(tr)
    out = None
    for kind, scale, weight in [("logistic", "standard", "weight"), ("naive_bayes", "min_max", None),
                                ("tree", None, None), ("forest", None, "weight"),
                                ("gbt", None, "weight")]:
        model = M.fit_pipeline(trw, features, kind, scale=scale, weight_col=weight)
        s = M.scored(model, te, "UserID").withColumn("model", F.lit(kind))
        out = s if out is None else out.unionByName(s)
    return out


@query("f07_robust_scaled")
def _f07(spark, sf):
    """Every numeric feature scaled by its median and quartile range."""
    return M.robust_scaled(_ml_table(spark, sf), "UserID", _ml_features(_ml_table(spark, sf)))


def _search_rows(spark, cv, metric):
    rows = [(", ".join(sorted(f"{p.name}={v}" for p, v in pm.items())), float(m))
            for pm, m in zip(cv.getEstimatorParamMaps(), cv.avgMetrics)]
    return spark.createDataFrame(rows, f"params string, {metric} double")


@query("i11_grid_search")
def _i11(spark, sf):
    f = _ml_table(spark, sf).fillna(0)
    cv = M.grid_search(f, _ml_features(f), "forest", M.FOREST_GRID, folds=5)
    return _search_rows(spark, cv, "f1")


@query("i12_random_search")
def _i12(spark, sf):
    f = _ml_table(spark, sf).fillna(0)
    cv = M.random_search(f, _ml_features(f), "gbt", M.BOOSTED_SPACE, draws=10, folds=5)
    return _search_rows(spark, cv, "auc")


@query("i13_confusion_metrics")
def _i13(spark, sf):
    return M.confusion_metrics(_rule_scored(spark, sf))


@query("i14_roc_points")
def _i14(spark, sf):
    return M.roc_points(_rule_scored(spark, sf))


@query("i14_auc")
def _i14b(spark, sf):
    return M.auc(_rule_scored(spark, sf)).select(F.round("auc", 10).alias("auc"))


@query("i15_pr_curve")
def _i15(spark, sf):
    return M.pr_curve(_rule_scored(spark, sf))


@query("i15_average_precision")
def _i15b(spark, sf):
    return M.average_precision(_rule_scored(spark, sf)).select(
        F.round("average_precision", 10).alias("average_precision"))


@query("i16_metrics_by_payment_type")
def _i16(spark, sf):
    s = _rule_scored(spark, sf).withColumn("segment", F.coalesce("firstPaymentType", F.lit("Nan")))
    return M.confusion_metrics(s, ["segment"])


@query("i17_metric_table")
def _i17(spark, sf):
    """Boosted trees for each of the eight horizons under two weight policies:
    five test metrics each."""
    allh = FT.active_days_features(_t(spark, sf), list(range(1, 9)))
    features = _ml_features(allh)
    allh = allh.select("horizon", "UserID", "Label",
                       *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                         for c in features])
    return M.metric_table(allh, list(range(1, 9)), features, "UserID", ["isns", "scale_pos_weight"])


@query("i18_probability_blend")
def _i18(spark, sf):
    b = M.blend(_rule_scored(spark, sf), _rule_scored_b(spark, sf), "UserID")
    return b.withColumn("score", F.round("score", 10))


@query("i18_score_medians")
def _i18m(spark, sf):
    """Medians of the two scores and of their blend."""
    m = M.score_medians(_rule_scored(spark, sf), _rule_scored_b(spark, sf), "UserID")
    return m.select("which", F.round("median", 10).alias("median"))


@query("i19_recursive_elimination")
def _i19(spark, sf):
    """Features left out one by one down to a single one."""
    tr, te, features = _split(spark, sf)
    return M.recursive_elimination(tr, te, features, "UserID", n_keep=1, kind="forest", step=1)[1]


@query("i20_permutation_importance")
def _i20(spark, sf):
    """All numeric features, 10 repeats."""
    tr, te, features = _split(spark, sf)
    model = M.fit_pipeline(tr, features, "forest")
    return M.permutation_importance(model, te, features, "UserID", repeats=10)


# ---- H08-H13: PCA and LSI ---------------------------------------------------------
@query("h08_pca_explained_variance")
def _h08(spark, sf):
    """Cumulative share of the variance for k = 0, 100 ... all components."""
    from tessera.operators import lsa

    docs, _, dim = SP.dense_tfidf(_t(spark, sf))
    return lsa.explained_variance(docs, 100, dim)


@query("h08_total_variance")
def _h08t(spark, sf):
    """The spectrum's sum: the variances of all terms together."""
    from tessera.operators import lsa

    docs, _, dim = SP.dense_tfidf(_t(spark, sf))
    values = lsa.spectrum(docs, dim)
    return spark.createDataFrame([(len(values), round(float(values.sum()), 8))],
                                 "components int, variance double")


@query("h09_lsi_topics")
def _h09(spark, sf):
    from tessera.operators import lsa

    docs, _, dim = SP.dense_tfidf(_t(spark, sf), form="log2")
    axes = lsa.fit_lsi(docs, SP.LSI_TOPICS, dim)
    return lsa.project(docs, axes, dim=dim).select(F.col("id").alias("doc_id"), "vec")


@query("h10_pca_cosine_top5")
def _h10(spark, sf):
    return SP.pca_top_k(_t(spark, sf), 10, 5, "cosine")


@query("h11_lsi_cosine_top5")
def _h11(spark, sf):
    return SP.lsi_top_k(_t(spark, sf))


@query("h12_pca_euclid_top5")
def _h12(spark, sf):
    return SP.pca_top_k(_t(spark, sf), 10, 5, "euclid")


@query("h12_pca_linear_kernel_top5")
def _h12b(spark, sf):
    return SP.pca_top_k(_t(spark, sf), 10, 5, "dot")


@query("h13_pca_reconstruction")
def _h13(spark, sf):
    from tessera.operators import lsa

    docs, _, dim = SP.dense_tfidf(_t(spark, sf))
    return lsa.reconstruction_error(lsa.fit_pca(docs, 10, dim), docs, dim)


# ---- streaming ---------------------------------------------------------------------
@query("d02_streaming_daily_event_log")
def _d02s(spark, sf):
    """D02 maintained incrementally by Structured Streaming (same result as
    the batch extract once the input is consumed)."""
    import uuid

    from tessera.streaming import daily_logs

    sink = daily_logs.run(spark, sf, "events", name=f"daily_event_log_{uuid.uuid4().hex[:8]}")
    return daily_logs.current_table(spark, sink)


@query("g05_compound_merge")
def _g05(spark, sf):
    """Documents and benchmark passages with all frequent pairs of the corpus
    (at least one in 10,000 of its adjacent pairs) merged into ``a_b`` compounds."""
    from tessera.operators import compounds
    from tessera.session import written

    t = _t(spark, sf)
    clean = TX.clean_full("text").alias("text")
    docs = t.documents.select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), clean)
    passages = t.benchmark.select(F.lit("benchmark").alias("source"), F.col("item_id").alias("id"), clean)
    texts = written(docs.unionByName(passages), "clean-texts").select(
        "source", "id", TX.split_words("text").alias("tokens"))
    lexicon = compounds.frequent_pairs(texts.filter("source = 'documents'"), 1e-4)
    return compounds.merged_pairs(texts, lexicon).withColumnRenamed("merged", "tokens")


@query("f05_log_features")
def _f05(spark, sf):
    return FT.log_features(FT.active_days_features(_t(spark, sf), 1))


@query("a06_stop_word_union")
def _a06(spark, sf):
    """Spark's built-in English list ∪ the corpus terms found in more than
    half of the documents (set union)."""
    from tessera.sources.tables import load_stop_words

    t = _t(spark, sf)
    tf = S.term_counts(t.documents, "doc_id")
    n = t.documents.count()
    frequent = S.doc_frequency(tf).filter(F.col("df") > n / 2).select(F.col("term").alias("word"))
    return load_stop_words(spark).unionByName(frequent).distinct()

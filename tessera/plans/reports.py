"""Exploratory reports over the extracts (survey D18-D32, C07-C10, F06-F09,
B05-B15, J02-J03): the data behind the reference's plots and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import text as TX
from tessera.operators import aggregates as A
from tessera.operators import transforms as T
from tessera.operators.joins import compare_on_key, remove_keys
from tessera.operators.textops import text_key
from tessera.plans import extracts as X
from tessera.plans import feature_tables as FT
from tessera.sources import views as V
from tessera.sources.tables import Tables

MEASURES = ["UsageTime", "Records", "open_time", "payment_screen_time"]


def engagement_payer(t: Tables) -> DataFrame:
    """Engagement rows with the payer gap, payer flag (B15) and weekday names."""
    eng = X.engagement_extract(t)
    pay = X.payment_extract(t).select("UserID", "gapday", "firstpay", "firstPayment")
    e = eng.join(pay, "UserID", "left")
    return e.withColumn("payer", F.col("gapday").isNotNull()) \
            .withColumn("Event_dayofweek", D.weekday_name("EventDate"))


def weekday_action_payer(t: Tables) -> DataFrame:
    """D21."""
    e = engagement_payer(t)
    return e.groupBy("Event_dayofweek", "ActionType", "payer").agg(
        F.count(F.lit(1)).alias("events"), F.avg("UsageTime").alias("mean_usage"))


def weekday_counts(t: Tables) -> DataFrame:
    """Weekday counts of pay day, join day and event day over payer
    rows, side by side (full outer join on the weekday)."""
    p = engagement_payer(t).filter("payer")
    pay_day = D.weekday_name(D.pay_date("UserJoinedDate", "gapday"))
    a = p.groupBy(pay_day.alias("weekday")).agg(F.count(F.lit(1)).alias("pay_dayofweek"))
    b = p.groupBy(D.weekday_name("UserJoinedDate").alias("weekday")).agg(
        F.count(F.lit(1)).alias("joined_dayofweek"))
    c = p.groupBy(F.col("Event_dayofweek").alias("weekday")).agg(
        F.count(F.lit(1)).alias("Event_dayofweek"))
    return a.join(b, "weekday", "full").join(c, "weekday", "full")


def hour_diff_cases(t: Tables) -> DataFrame:
    """Hours between first use and first payment, three cohorts:
    ``zero_instant`` (first active day 0, paid on day 0), ``late_late``
    (first active day > 0, paid later) and ``late_instant``."""
    fake = V.fake_users(t)
    eng = remove_keys(X.engagement_extract(t), fake)
    pay = remove_keys(X.payment_extract(t), fake).filter(F.col("gapday").isNotNull())
    first = eng.groupBy("UserID").agg(F.min("nth_day_from_registration").alias("min_day"),
                                      F.min("firstuse").alias("firstuse"))
    payers = pay.select("UserID", "gapday", "firstpay", "firstPayment")
    j = first.join(payers, "UserID")
    case = (F.when((F.col("min_day") == 0) & (F.col("gapday") == 0), "zero_instant")
             .when((F.col("min_day") > 0) & (F.col("gapday") != 0), "late_late")
             .when((F.col("min_day") > 0) & (F.col("gapday") == 0), "late_instant"))
    secs = F.unix_micros(F.col("firstpay").cast("timestamp")) - F.unix_micros(F.col("firstuse").cast("timestamp"))
    return j.select("UserID", case.alias("case"), "firstPayment",
                    (F.col("firstuse") > F.col("firstpay")).alias("use_first"),
                    F.round(F.abs(secs) / 3.6e9, 6).alias("gap_hour")).filter(F.col("case").isNotNull())


def use_first_counts(t: Tables) -> DataFrame:
    """D28."""
    return hour_diff_cases(t).groupBy("case", "firstPayment", "use_first").agg(
        F.count(F.lit(1)).alias("n"))


def learning_fanout(t: Tables) -> DataFrame:
    """Engagement left-joined to the learning detail on (user, date,
    day number) — the fan-out variant (each engagement row repeats per
    subject row)."""
    eng = X.engagement_extract(t).select("UserID", "EventDate", "nth_day_from_registration",
                                         "ActionType", F.col("UsageTime").alias("eng_usage"))
    det = X.learning_detail_extract(t, sort=False).select(
        "UserID", "EventDate", "nth_day_from_registration", "SubjectName", "IsCompleted",
        F.col("UsageTime").alias("learn_usage"))
    return eng.join(det, ["UserID", "EventDate", "nth_day_from_registration"], "left")


def not_match_in_match(t: Tables) -> DataFrame:
    """NOT MATCH look-ups whose text also occurs among MATCH look-ups;
    texts meet by digest."""
    p = V.feedback_pairs(t).select("FeedbackID", "HumanFeedback", text_key(["LookupText"]).alias("k"))
    m = p.filter(F.col("HumanFeedback") == "MATCH").select("k")
    return p.filter(F.col("HumanFeedback") == "NOT MATCH").join(m, "k", "left_semi").select("FeedbackID")


def label_disagreements(t: Tables) -> DataFrame:
    """Users whose label differs between the cut-off and active-days tables."""
    a = FT.cutoff_features(t, 3, 14).select("UserID", "Label")
    b = FT.active_days_features(t, 1).select("UserID", "Label")
    return compare_on_key(a, b, "UserID", "Label")


def word_diff_bins(t: Tables) -> DataFrame:
    """F08 on the feedback pairs."""
    p = V.feedback_pairs(t)
    d = F.abs(TX.n_words("QuestionText") - TX.n_words("LookupText"))
    return p.select("FeedbackID", d.alias("diff_word"), T.bin_right_closed(d).alias("diff_bin"))


def recode_result(col) -> "F.Column":
    """``NOT_MATCH`` and ``SKIP`` → ``NOT MATCH``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin("NOT_MATCH", "SKIP"), F.lit("NOT MATCH")).otherwise(c)

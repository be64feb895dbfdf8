"""End-to-end per-user feature tables (survey E14, E15, E04).

Every part is aggregated to (horizon, user) or user grain before the star
join, so the join keeps one row per key by construction and all parts share
the same hash partitioning on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import aggregates as A
from tessera.operators import horizons as H
from tessera.operators import transforms as T
from tessera.operators.joins import remove_keys, star_left_join
from tessera.plans import extracts as X
from tessera.sources import views as V
from tessera.sources.tables import Tables

ACTIONS = ["Discovery", "Entertainment", "Learn"]
TIERS = ["Big", "Medium", "Small"]
LEARN_COLS = [f"{m}{s}" for m in ("Interaction", "IsCompleted", "Record", "UsageTime")
              for s in V.SUBJECTS]
# Columns left untouched by the log transform (as in the reference).
LOG_EXCLUDES = ["firstPaymentType", "Recency", "ContentFrequent", "PaymentScreenFrequent",
                "TotalChild", "MedianChildAge", "NoFemale", "NoMale", "NoTypeBrand",
                "BigBrand", "MediumBrand", "SmallBrand", "Label", "gapday", "JoinMonth",
                "ModeFirstHour", "ModeLastHour", "ModeLastDay", "ModeDayofweek", "ScaleGapday"]
# Brand-tier thresholds scaled to the driver data (the reference uses
# 100000 / 10000 on its production table).
TIER_BIG, TIER_MEDIUM = 1000, 850


def payment_columns(t: Tables) -> DataFrame:
    pay = X.payment_extract(t)
    return pay.select("UserID", "UserJoinedDate", "gapday",
                      F.col("firstPayment").alias("firstPaymentType"))


def engagement_with_tiers(t: Tables, big: int = TIER_BIG, medium: int = TIER_MEDIUM) -> DataFrame:
    """Engagement extract + payer gap + brand tier."""
    eng = X.engagement_extract(t)
    pay = payment_columns(t).select("UserID", "gapday")
    eng = eng.join(pay, "UserID", "left")
    return T.frequency_tier(eng, "DeviceBrand", big, medium)


def learning_with_gap(t: Tables) -> DataFrame:
    det = X.learning_detail_extract(t, sort=False)
    det = det.withColumn("InteractionLearn", F.col("UsageTime") * F.col("Records"))
    pay = payment_columns(t).select("UserID", "gapday")
    return det.join(pay, "UserID", "left")


# E15 / E04 ---------------------------------------------------------------------
def active_days_features(t: Tables, horizons: Sequence[int] | int = 1,
                         big: int = TIER_BIG, medium: int = TIER_MEDIUM) -> DataFrame:
    """The "active-days" feature table: one row per (horizon, user)."""
    keys = ["horizon", "UserID"]
    learn = H.active_days(learning_with_gap(t), horizons)
    content_learn = A.pivot_agg(
        learn, keys, "SubjectName", V.SUBJECTS,
        {"Interaction": "InteractionLearn", "IsCompleted": "IsCompleted",
         "Record": "Records", "UsageTime": "UsageTime"})

    action = H.active_days(engagement_with_tiers(t, big, medium), horizons)
    # Everything at the (horizon, user) grain comes from one aggregate.
    active = action.groupBy(*keys).agg(
        *A.rfm_exprs(), *A.median_exprs(),
        *A.pivot_exprs("TypeBrand", TIERS, {"Brand": F.lit(1)}, agg="count", name="{value}{measure}"),
        *A.pivot_exprs("ActionType", ACTIONS, {"Record": "Records", "UsageTime": "UsageTime"}),
        A.count_distinct_with_null("TypeBrand").alias("NoTypeBrand"))

    pay = payment_columns(t).select("UserID", "firstPaymentType",
                                    F.month("UserJoinedDate").alias("JoinMonth"), "gapday")
    final = star_left_join(active, [content_learn], key=keys)
    final = final.join(V.demographics(t), "UserID", "left").join(pay, "UserID", "left")
    final = final.filter(F.col("TotalChild").isNotNull())            # B12
    final = final.fillna(0, subset=LEARN_COLS)                        # B11
    return final.select(
        "*",
        T.safe_ratio("TotalUsageTime", "TotalRecords").alias("AvgTimePerCompletion"),
        (F.col("TotalUsageTime") * F.col("TotalRecords")).alias("InteractionGeneral"),
        (F.col("UsageTimeLearn") * F.col("RecordLearn")).alias("InteractionLearn"),
        (F.col("UsageTimeDiscovery") * F.col("RecordDiscovery")).alias("InteractionDiscovery"),
        (F.col("UsageTimeEntertainment") * F.col("RecordEntertainment"))
        .alias("InteractionEntertainment"),
        (F.col("MedianUsageTime") * F.col("MedianRecord")).alias("MedianInteraction"),
        H.label_scaled("ScaleGapday", 31).alias("Label"))


def log_features(features: DataFrame, keys: Sequence[str] = ("horizon", "UserID")) -> DataFrame:
    """F05 over every numeric feature not in the exclude list."""
    numeric = [f.name for f in features.schema.fields
               if f.name not in keys and f.name not in LOG_EXCLUDES
               and f.dataType.typeName() in ("double", "long", "integer")]
    return T.log_transform(features, numeric)


# E14 ---------------------------------------------------------------------------
def cutoff_engagement(t: Tables, n_days: int = 3, mark_day: int = 14) -> DataFrame:
    """E02 + E05 on the engagement extract, fake users removed."""
    fake = V.fake_users(t)
    eng = remove_keys(X.engagement_extract(t), fake) \
        .withColumnRenamed("open_time", "Opentime") \
        .withColumnRenamed("payment_screen_time", "PaymentScreenTime")
    pay = remove_keys(X.payment_extract(t), fake)
    return H.set_label(H.cutoff_exclusive(eng, n_days), pay, mark_day)


BRAND_COLUMNS = V.BRANDS + ["Other brand"]


def cutoff_features(t: Tables, n_days: int = 3, mark_day: int = 14,
                    as_of: str = V.AS_OF_DATE) -> DataFrame:
    """The "cut-off" feature table: one row per user."""
    fake = V.fake_users(t)
    users = remove_keys(X.user_child_brand_extract(t), fake)
    e = cutoff_engagement(t, n_days, mark_day)

    brands = T.collapse_rare(users, "DeviceBrand")                               # F01
    brand_hot = T.one_hot_per_key(brands, "UserID", "DeviceBrand", BRAND_COLUMNS,
                                  prefix="brand_")                               # F03
    brand_hot = brand_hot.toDF(*[c.replace(" ", "_") for c in brand_hot.columns])
    children = A.children_summary(users, as_of)                                  # D06-D08
    merged = A.collapse_day_action(e, ["UserID", "EventDate", "ActionType"],
                                   ["Opentime", "UsageTime", "Records", "PaymentScreenTime"],
                                   ["cutoffDay", "lateUser", "Label"])           # D31
    base = e.groupBy("UserID").agg(F.min("UserJoinedDate").alias("UserJoinedDate"))
    totals = {"TotalOpentime": "Opentime", "TotalUsageTime": "UsageTime",
              "TotalRecords": "Records", "TotalPayscreentime": "PaymentScreenTime"}
    activity = merged.groupBy("UserID").agg(                                       # D13, D11
        *[F.sum(c).alias(n) for n, c in totals.items()],
        *A.pivot_exprs("ActionType", ACTIONS,
                       {"Opentime": "Opentime", "UsageTime": "UsageTime",
                        "Records": "Records", "PaymentScreenTime": "PaymentScreenTime"}),
        *[F.max(c).alias(c) for c in ("cutoffDay", "lateUser", "Label")])
    interest = H.most_interest(H.interest_by_action(e))                          # E11-E13
    return star_left_join(base, [children, activity, interest, brand_hot])

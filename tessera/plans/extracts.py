"""The five warehouse extracts (survey 2D D01-D05, with A04, B01-B04, C01-C05).

Plans are written so that the raw event tables are aggregated *before* any
join: joins then run at user-day grain, which is bounded per user (at most
one row per day and action), instead of at raw-event grain.  The results are
the same as the reference's join-then-group SQL because every joined column
is functionally determined by the pre-aggregation key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import day_diff, day_diff_nonneg, minutes_2dp, tenths, ts_range_filter
from tessera.sources import views as V
from tessera.sources.tables import Tables, union_live_archive


def cohort(t: Tables, start: str = V.COHORT_START, end: str = V.COHORT_END) -> DataFrame:
    """Users whose join date lies in [start, end]."""
    up = V.user_profile(t)
    return up.filter(ts_range_filter("UserJoinedDate", start, end))


def event_logs_all(t: Tables) -> DataFrame:
    """Live ∪ archive event logs, duplicates kept."""
    return union_live_archive(V.user_event_logs(t), V.user_event_logs(t, archive=True))


def usage_records_all(t: Tables) -> DataFrame:
    """Live ∪ archive usage records."""
    return union_live_archive(V.view_child_usage_records(t),
                              V.view_child_usage_records(t, archive=True))


# D01 + C03 + C05 -------------------------------------------------------------
def payment_summary(t: Tables, first_pay_join: bool = True) -> DataFrame:
    """Per payer: first payment time, amount, count, average, and the payment
    type of the first-payment row.

    ``first_pay_join=True`` keeps the reference's self-join back to the
    first-payment row (a tie at the same timestamp yields several rows);
    ``False`` uses ``min_by`` (one row, shuffle-free) — identical whenever
    (UserID, CreatedAt) is unique, as in the driver data."""
    usr = V.user_subscription_records(t)
    plans = V.subscription_plan_profile(t).filter(F.col("PlanIsTrial") == 0).select("PlanID")
    ok = (usr.filter((F.col("TransactionType") == "purchase")
                     & (F.col("TransactionStatus") == "succeed")
                     & F.col("RefundTransactionID").isNull())
          .join(F.broadcast(plans), "PlanID", "left_semi"))   # 5-row dimension
    if not first_pay_join:
        return ok.groupBy("UserID").agg(
            F.min("CreatedAt").alias("firstpay"),
            F.min_by("PaymentType", "CreatedAt").alias("firstPayment"),
            F.sum("FinalValue").alias("Amount"),
            F.count(F.lit(1)).alias("TransactionNo"),
            (F.sum("FinalValue") / F.count(F.lit(1))).alias("avgValue"))
    a = ok.groupBy("UserID").agg(
        F.min("CreatedAt").alias("firstpay"),
        F.sum("FinalValue").alias("Amount"),
        F.count(F.lit(1)).alias("TransactionNo"),
        (F.sum("FinalValue") / F.count(F.lit(1))).alias("avgValue"))
    b = usr.select("UserID", F.col("CreatedAt").alias("firstpay"),
                   F.col("PaymentType").alias("firstPayment"))
    return a.join(b, ["UserID", "firstpay"], "inner").select(
        "UserID", "firstpay", "firstPayment", "Amount", "TransactionNo", "avgValue")


def payment_extract(t: Tables, start: str = V.COHORT_START, end: str = V.COHORT_END,
                    first_pay_join: bool = True) -> DataFrame:
    """Extract 1 ("Payment"): cohort users left-joined to their payment
    summary, with the non-negative day gap to the first payment."""
    pay = payment_summary(t, first_pay_join)
    users = cohort(t, start, end)
    j = users.join(pay, "UserID", "left")
    return j.select(
        "UserID", "UserJoinedDate", "firstpay", "firstPayment",
        day_diff_nonneg("UserJoinedDate", "firstpay").alias("gapday"),
        "Amount", "TransactionNo", "avgValue")


# Extract 2 --------------------------------------------------------------------
def user_child_extract(t: Tables, start: str = V.COHORT_START,
                       end: str = V.COHORT_END) -> DataFrame:
    users = cohort(t, start, end).select("UserID")
    kids = V.child_profile(t)
    return users.join(kids, "UserID").select("UserID", "ChildBday", "ChildGender")


# D02 ---------------------------------------------------------------------------
def daily_event_log(t: Tables) -> DataFrame:
    """Per user and day: max brand, app opens, payment-screen views."""
    logs = event_logs_all(t)
    return logs.groupBy(F.to_date("EventTime").alias("EventDate"), "UserID").agg(
        F.max("DeviceBrand").alias("DeviceBrand"),
        F.count_if(F.col("EventCode") == "app_info_openApp").cast("long").alias("open_time"),
        F.count_if(F.col("EventCode").isin("pop_up_show_listSub",
                                           "parentcontrol_show_listPackage"))
         .cast("long").alias("payment_screen_time"))


# D03 ---------------------------------------------------------------------------
def engagement_extract(t: Tables, start: str = V.COHORT_START,
                       end: str = V.COHORT_END) -> DataFrame:
    """Extract 3 ("Engagement"): per user, day and action type, usage
    minutes, record count, first/last use, joined with the day's event log."""
    rec = usage_records_all(t)
    daily = rec.groupBy("UserID", F.to_date("EventTime").alias("EventDate"), "ActionType").agg(
        F.sum(tenths("UsageTime")).alias("_usage"),
        F.count(F.lit(1)).alias("Records"),
        F.max("EventTime").alias("lastuse"),
        F.min("EventTime").alias("firstuse"))
    users = cohort(t, start, end)
    logs = daily_event_log(t)
    j = daily.join(users, "UserID").join(logs, ["UserID", "EventDate"], "left")
    return j.select(
        "EventDate", "UserID", "ActionType", "UserJoinedDate",
        day_diff("UserJoinedDate", "EventDate").alias("nth_day_from_registration"),
        "open_time", "payment_screen_time", "DeviceBrand",
        minutes_2dp("_usage").alias("UsageTime"),
        "Records", "lastuse", "firstuse")


# D04 ---------------------------------------------------------------------------
def user_child_brand_extract(t: Tables, start: str = V.COHORT_START,
                             end: str = V.COHORT_END) -> DataFrame:
    """Extract 4: DISTINCT (user, child, birthday, gender, brand).  The
    brand list is de-duplicated before the join (the outer DISTINCT makes
    that equivalent), so the join input is at (user, brand) grain."""
    users = cohort(t, start, end).select("UserID")
    kids = V.child_profile(t)
    brands = event_logs_all(t).select("UserID", "DeviceBrand").distinct()
    j = users.join(kids, "UserID").join(brands, "UserID", "left")
    return j.select("UserID", "ChildID", "ChildBday", "ChildGender", "DeviceBrand").distinct()


# D05 + J01 ---------------------------------------------------------------------
def learning_detail_extract(t: Tables, start: str = V.COHORT_START,
                            end: str = V.COHORT_END, sort: bool = True) -> DataFrame:
    """Extract 5: per user, day, subject and completion flag."""
    rec = usage_records_all(t)
    # The activity dimension is a fixed-size table (N_ACTIVITIES rows), so the
    # subject lookup is a map-side broadcast join; the aggregate runs before
    # the user join, which then sees user-day grain rows only.
    acts = F.broadcast(V.activity_profile(t))
    daily = rec.join(acts, "ActivityID").groupBy(
        "UserID", F.to_date("EventTime").alias("EventDate"), "SubjectName", "IsCompleted",
    ).agg(F.sum(tenths("UsageTime")).alias("_usage"), F.count(F.lit(1)).alias("Records"))
    users = cohort(t, start, end)
    out = daily.join(users, "UserID").select(
        "EventDate",
        day_diff("UserJoinedDate", "EventDate").alias("nth_day_from_registration"),
        "UserID", "SubjectName", "IsCompleted",
        minutes_2dp("_usage").alias("UsageTime"), "Records")
    if sort:
        out = out.orderBy("UserID", "EventDate", "SubjectName", "IsCompleted")
    return out


def all_extracts(t: Tables) -> dict[str, DataFrame]:
    """The named batch of extracts."""
    return {
        "Payment": payment_extract(t),
        "User": user_child_extract(t),
        "Engagement": engagement_extract(t),
        "User_DeviceBrand": user_child_brand_extract(t),
        "Engagement_detail_learn": learning_detail_extract(t),
    }

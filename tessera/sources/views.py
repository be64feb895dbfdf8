"""Logical tables of the subscription / search workload, defined as lazy
views over the driver tables (FIXTURES.md §3).

Every view is a projection/filter over a driver table, so Catalyst folds it
into the query that uses it: filters and column pruning still reach the
parquet scan.  The same definitions are written in SQL in
``tessera/oracle_sql.py`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import maybe_broadcast
from tessera.sources.tables import Tables

# Fixed values of the fixture mapping (FIXTURES.md §3) --------------------
BRANDS = ["samsung", "oppo", "apple", "xiaomi", "vivo", "realme", "nokia"]
PAYMENT_TYPES = ["zalopay", "momo", "card", "store"]
SUBJECTS = ["English", "Math", "Phonics", "Vietnamese"]
EVENT_CODES = {
    "view": "app_info_openApp",
    "click": "pop_up_show_listSub",
    "signup": "parentcontrol_show_listPackage",
}
ACTION_TYPES = {"click": "Learn", "view": "Discovery"}   # else Entertainment
ARCHIVE_BEFORE = "2024-01-15 00:00:00"
JOIN_BASE_DATE = "2024-01-01"
CHILD_BDAY_BASE = "2014-01-01"
AS_OF_DATE = "2024-02-01"
N_ACTIVITIES = 100
FAKE_MOD, FAKE_REM = 37, 5
DEMOGRAPHICS_GAP_MOD = 11
# Cohort that the reference filters on (its own window is 2022-04-01 ..
# 2023-04-20); for the driver data every user joins 2023-12-30 .. 2024-01-01.
COHORT_START, COHORT_END = "2023-12-30", "2024-01-01"


def prop_k(col: str = "props"):
    """The integer carried in ``props`` (``{"k": 17}`` → 17)."""
    return F.regexp_extract(F.col(col), r"([0-9]+)", 1).cast("int")


def _pick(values, index_col):
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (index_col + F.lit(1)).cast("int"))


def user_profile(t: Tables) -> DataFrame:
    users = t.events.select(F.col("user_id").alias("UserID")).distinct()
    joined = F.date_sub(F.lit(JOIN_BASE_DATE).cast("date"),
                        (F.col("UserID") % 3).cast("int"))
    return users.withColumn("UserJoinedDate", joined.cast("timestamp_ntz"))


def fake_users(t: Tables) -> DataFrame:
    return (t.events.select(F.col("user_id").alias("UserID"))
            .filter(F.col("UserID") % FAKE_MOD == FAKE_REM).distinct())


def child_profile(t: Tables) -> DataFrame:
    base = user_profile(t).select("UserID")
    kids = base.withColumn(
        "i", F.explode(F.sequence(F.lit(1), (F.col("UserID") % 3 + 1).cast("int"))))
    child_id = F.col("UserID") * 10 + F.col("i")
    return kids.select(
        "UserID",
        child_id.alias("ChildID"),
        F.date_add(F.lit(CHILD_BDAY_BASE).cast("date"),
                   ((child_id * 97) % 2000).cast("int")).alias("ChildBday"),
        F.when(child_id % 2 == 0, "female").otherwise("male").alias("ChildGender"),
    )


def subscription_plan_profile(t: Tables) -> DataFrame:
    plans = t.spark.range(5).select(F.col("id").cast("int").alias("PlanID"))
    return plans.withColumn("PlanIsTrial", (F.col("PlanID") == 1).cast("int"))


def user_subscription_records(t: Tables) -> DataFrame:
    k = prop_k()
    ev = t.events.filter(F.col("event_type") == "purchase")
    return ev.select(
        F.col("event_id").alias("TransactionID"),
        F.col("user_id").alias("UserID"),
        F.col("ts").alias("CreatedAt"),
        F.col("value").alias("FinalValue"),
        F.lit("purchase").alias("TransactionType"),
        F.when(k < 5, "succeed").otherwise("failed").alias("TransactionStatus"),
        F.when(k == 3, F.col("event_id")).alias("RefundTransactionID"),
        (k % 5).alias("PlanID"),
        _pick(PAYMENT_TYPES, F.col("user_id") % 4).alias("PaymentType"),
    )


def _event_code():
    expr = F.lit("other")
    for etype, code in reversed(list(EVENT_CODES.items())):
        expr = F.when(F.col("event_type") == etype, code).otherwise(expr)
    return expr


def _archive_split(df: DataFrame, archive: bool) -> DataFrame:
    cut = F.lit(ARCHIVE_BEFORE).cast("timestamp_ntz")
    return df.filter(F.col("ts") < cut) if archive else df.filter(F.col("ts") >= cut)


def user_event_logs(t: Tables, archive: bool = False) -> DataFrame:
    k = prop_k()
    brand = _pick(BRANDS, (F.col("user_id") + k % 3) % len(BRANDS))
    ev = _archive_split(t.events, archive)
    return ev.select(
        F.col("user_id").alias("UserID"),
        F.col("ts").alias("EventTime"),
        _event_code().alias("EventCode"),
        brand.alias("DeviceBrand"),
        F.concat(brand, F.lit("-"), (k % 2).cast("string")).alias("DeviceModel"),
    )


def view_child_usage_records(t: Tables, archive: bool = False) -> DataFrame:
    k = prop_k()
    action = F.lit("Entertainment")
    for etype, name in reversed(list(ACTION_TYPES.items())):
        action = F.when(F.col("event_type") == etype, name).otherwise(action)
    ev = _archive_split(t.events.filter(F.col("event_type") != "purchase"), archive)
    return ev.select(
        F.col("user_id").alias("UserID"),
        F.col("ts").alias("EventTime"),
        action.alias("ActionType"),
        (F.col("value") * 10).alias("UsageTime"),
        k.alias("ActivityID"),
        (k % 2).alias("IsCompleted"),
    )


def activity_profile(t: Tables) -> DataFrame:
    ids = t.spark.range(N_ACTIVITIES).select(F.col("id").cast("int").alias("ActivityID"))
    return ids.withColumn("SubjectName", _pick(SUBJECTS, F.col("ActivityID") % 4))


def demographics(t: Tables, as_of: str = AS_OF_DATE) -> DataFrame:
    """Per-user child summary.  Users with ``UserID % 11 = 0`` are missing so
    that the required-column drop (B12) has work to do."""
    from tessera.functions.dates import age_years

    kids = child_profile(t).filter(F.col("UserID") % DEMOGRAPHICS_GAP_MOD != 0)
    return kids.groupBy("UserID").agg(
        F.countDistinct("ChildID").cast("long").alias("TotalChild"),
        F.median(age_years("ChildBday", as_of)).alias("MedianChildAge"),
        F.count_if(F.col("ChildGender") == "female").cast("long").alias("NoFemale"),
        F.count_if(F.col("ChildGender") == "male").cast("long").alias("NoMale"),
    )


def _line_at(text_col: str, key_col: str):
    return (F.col(key_col) % F.size(F.split(F.col(text_col), "\n")) + 1).cast("int")


def _pick_line(text_col: str, key_col: str):
    return F.element_at(F.split(F.col(text_col), "\n"), _line_at(text_col, key_col))


def _next_lines(docs: DataFrame) -> DataFrame:
    """Of every document the line that the look-up of the id before it may be:
    no other text of it is joined.  Place 0 is an error only where it is used."""
    before = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next_text"))
    at = _line_at("next_text", "doc_id")
    return before.select("doc_id", at.alias("next_at"),
                         F.when(at != 0, _pick_line("next_text", "doc_id")).alias("next_line"))


def feedback_pairs(t: Tables) -> DataFrame:
    """Look-up / question pairs with human labels.

    Question = a whole document (with its formula, see ``formula_documents``);
    Lookup = one whole line of the same document
    (``MATCH``, label quality 1) or of the document with the next id
    (``NOT MATCH``).  Feedback Type comes from ``toxic``; the engine's own
    result from ``doc_id % 3``.
    """
    docs = formula_documents(t)
    lab = t.labels.select("doc_id", "quality", "toxic")
    # Only texts of labelled documents are shuffled, and of the next ones a line.
    known = maybe_broadcast(lab.select("doc_id"))
    lines = _next_lines(docs).join(known, "doc_id", "left_semi")
    j = (lab.join(lines, "doc_id", "left")
         .join(docs.join(known, "doc_id", "left_semi"), "doc_id"))
    lookup = F.when(F.col("quality") == 1, _pick_line("text", "doc_id")) \
              .when(F.col("next_at") == 0, F.raise_error(F.lit("there is no line 0")).cast("string")) \
              .otherwise(F.col("next_line"))
    return j.select(
        F.col("doc_id").alias("FeedbackID"),
        lookup.alias("LookupText"),
        F.col("text").alias("QuestionText"),
        F.when(F.col("toxic") == 0, "POSITIVE").otherwise("NEGATIVE").alias("FeedbackType"),
        F.element_at(F.array(F.lit("MATCH"), F.lit("NOT_MATCH"), F.lit("SKIP")),
                     (F.col("doc_id") % 3 + 1).cast("int")).alias("FeedbackResult"),
        F.when(F.col("quality") == 1, "MATCH").otherwise("NOT MATCH").alias("HumanFeedback"),
    ).filter(F.col("LookupText").isNotNull())


def formula_documents(t: Tables) -> DataFrame:
    """Documents, a third of them carrying an inline LaTeX formula."""
    formula = F.concat(F.lit(" \\( x^2 + "), F.col("doc_id").cast("string"),
                       F.lit(" = 0 \\)"))
    return t.documents.select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("text"), formula))
         .otherwise(F.col("text")).alias("text"))


def search_corpus(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


def search_queries(t: Tables) -> DataFrame:
    return t.benchmark.select(F.col("item_id").alias("query_id"), "text")


def product_names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("doc_id"), F.col("p_name").alias("text"))

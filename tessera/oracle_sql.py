"""DuckDB oracle SQL, one statement per registered query key."""

from __future__ import annotations

from tessera.oracle_views import COHORT_WHERE, with_views

_PAY = """SELECT a.UserID, firstpay, b.PaymentType AS firstPayment, Amount, TransactionNo, avgValue
  FROM (SELECT UserID, min(CreatedAt) AS firstpay, sum(FinalValue) AS Amount,
               count(*) AS TransactionNo, sum(FinalValue) / count(*) AS avgValue
        FROM user_subscription_records
        WHERE TransactionType = 'purchase' AND TransactionStatus = 'succeed'
          AND RefundTransactionID IS NULL
          AND PlanID IN (SELECT PlanID FROM subscription_plan_profile WHERE PlanIsTrial = 0)
        GROUP BY UserID) a
  JOIN user_subscription_records b ON a.UserID = b.UserID AND a.firstpay = b.CreatedAt"""


def _payment_extract(where: str = COHORT_WHERE) -> str:
    return with_views(f"""
SELECT u.UserID, UserJoinedDate, firstpay, firstPayment,
  CASE WHEN date_diff('day', CAST(UserJoinedDate AS DATE), CAST(firstpay AS DATE)) < 0 THEN NULL
       ELSE date_diff('day', CAST(UserJoinedDate AS DATE), CAST(firstpay AS DATE)) END AS gapday,
  Amount, TransactionNo, avgValue
FROM user_profile u LEFT JOIN pay ON pay.UserID = u.UserID
WHERE {where}""", {"pay": _PAY})


_LOGS = """SELECT CAST(EventTime AS DATE) AS EventDate, UserID, max(DeviceBrand) AS DeviceBrand,
  CAST(sum(CASE WHEN EventCode = 'app_info_openApp' THEN 1 ELSE 0 END) AS BIGINT) AS open_time,
  CAST(sum(CASE WHEN EventCode IN ('pop_up_show_listSub', 'parentcontrol_show_listPackage')
           THEN 1 ELSE 0 END) AS BIGINT) AS payment_screen_time
  FROM event_logs_all GROUP BY 1, 2"""

_ENGAGEMENT = f"""SELECT CAST(r.EventTime AS DATE) AS EventDate, r.UserID AS UserID, ActionType,
  u.UserJoinedDate AS UserJoinedDate,
  date_diff('day', CAST(UserJoinedDate AS DATE), CAST(r.EventTime AS DATE)) AS nth_day_from_registration,
  open_time, payment_screen_time, logs.DeviceBrand AS DeviceBrand,
  floor((sum(CAST(round(UsageTime * 10) AS BIGINT)) + 3) / 6) / 100.0 AS UsageTime, count(*) AS Records,
  max(r.EventTime) AS lastuse, min(r.EventTime) AS firstuse
FROM usage_records_all r JOIN user_profile u ON u.UserID = r.UserID
LEFT JOIN logs ON logs.UserID = r.UserID AND logs.EventDate = CAST(r.EventTime AS DATE)
WHERE {COHORT_WHERE}
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""

_LEARN = f"""SELECT CAST(EventTime AS DATE) AS EventDate,
  date_diff('day', CAST(UserJoinedDate AS DATE), CAST(EventTime AS DATE)) AS nth_day_from_registration,
  r.UserID AS UserID, SubjectName, IsCompleted,
  floor((sum(CAST(round(UsageTime * 10) AS BIGINT)) + 3) / 6) / 100.0 AS UsageTime, count(*) AS Records
FROM usage_records_all r JOIN activity_profile a ON a.ActivityID = r.ActivityID
JOIN user_profile p ON p.UserID = r.UserID
WHERE {COHORT_WHERE}
GROUP BY 1, 2, 3, 4, 5"""

EXTRA_VIEWS = {"logs": _LOGS, "engagement": _ENGAGEMENT, "learn": _LEARN}


def q(body: str) -> str:
    return with_views(body, EXTRA_VIEWS)


ORACLE: dict[str, str] = {
    "d01_payment_extract": _payment_extract(),
    "c05_payment_extract_min_by": _payment_extract(),
    "b01_cohort_narrow": _payment_extract(
        "UserJoinedDate >= TIMESTAMP '2023-12-31' AND UserJoinedDate < TIMESTAMP '2024-01-02'"),
    "a02_user_child_extract": q(f"""SELECT u.UserID, ChildBday, ChildGender
        FROM user_profile u JOIN child_profile c ON c.UserID = u.UserID WHERE {COHORT_WHERE}"""),
    "d02_daily_event_log": q("SELECT * FROM logs"),
    "d03_engagement_extract": q("SELECT * FROM engagement"),
    "d04_user_child_brand": q(f"""SELECT DISTINCT u.UserID, ChildID, ChildBday, ChildGender, DeviceBrand
        FROM user_profile u JOIN child_profile c ON c.UserID = u.UserID
        LEFT JOIN (SELECT DISTINCT UserID, DeviceBrand, DeviceModel FROM event_logs_all) b
          ON b.UserID = u.UserID
        WHERE {COHORT_WHERE}"""),
    "d05_learning_detail": q("SELECT * FROM learn ORDER BY UserID, EventDate, SubjectName, IsCompleted"),
    "a04_usage_union": q("""SELECT ActionType, count(*) AS n, round(sum(UsageTime), 6) AS usage
        FROM usage_records_all GROUP BY ActionType"""),
    "views_demographics": q("SELECT * FROM demographics"),
}


# ---- feature pipelines -------------------------------------------------------
def _payment_body(where: str = COHORT_WHERE) -> str:
    return f"""SELECT u.UserID, UserJoinedDate, firstpay, firstPayment,
  CASE WHEN date_diff('day', CAST(UserJoinedDate AS DATE), CAST(firstpay AS DATE)) < 0 THEN NULL
       ELSE date_diff('day', CAST(UserJoinedDate AS DATE), CAST(firstpay AS DATE)) END AS gapday,
  Amount, TransactionNo, avgValue
FROM user_profile u LEFT JOIN pay ON pay.UserID = u.UserID WHERE {where}"""


TIER_BIG, TIER_MEDIUM = 1000, 850


def _horizon_values(hs) -> str:
    return "(VALUES " + ", ".join(f"({h})" for h in hs) + ") hs(h)"


def _active(src: str, hs) -> str:
    return f"""SELECT x.*, CAST(h AS INTEGER) AS horizon, MinFirstDay + h AS CutoffDay,
  nth_day_from_registration - MinFirstDay AS ScaleActionDay, gapday - MinFirstDay AS ScaleGapday
FROM (SELECT *, min(nth_day_from_registration) OVER (PARTITION BY UserID) AS MinFirstDay,
      CASE WHEN min(nth_day_from_registration) OVER (PARTITION BY UserID) = 0 THEN 'zero'
           ELSE 'other' END AS ZeroDay FROM {src}) x
JOIN {_horizon_values(hs)} ON h >= nth_day_from_registration - MinFirstDay"""


def _mode(src: str, keys: str, expr: str, name: str) -> str:
    return f"""SELECT {keys}, CAST(first(v ORDER BY c DESC, v ASC) AS INTEGER) AS {name}
FROM (SELECT {keys}, {expr} AS v, count(*) AS c FROM {src} GROUP BY {keys}, {expr})
GROUP BY {keys}"""


def _pivot(src: str, keys: str, pivot: str, values, measures: dict, agg="sum",
           name="{measure}{value}", cast=None) -> str:
    cols = []
    for mname, m in measures.items():
        for v in values:
            inner = f"{agg}(CASE WHEN {pivot} = '{v}' THEN {m} END)"
            c = inner if agg == "count" else f"COALESCE({inner}, 0)"
            t = (cast or {}).get(mname)
            if t:
                c = f"CAST({c} AS {t})"
            cols.append(f"{c} AS {name.format(measure=mname, value=v)}")
    return f"SELECT {keys}, {', '.join(cols)} FROM {src} GROUP BY {keys}"


SUBJECTS = ["English", "Math", "Phonics", "Vietnamese"]
ACTIONS = ["Discovery", "Entertainment", "Learn"]
LEARN_COLS = [f"{m}{s}" for m in ("Interaction", "IsCompleted", "Record", "UsageTime")
              for s in SUBJECTS]


def _features_views(hs) -> dict[str, str]:
    keys = "horizon, UserID"
    v = {
        "payment_x": _payment_body(),
        "pay_cols": """SELECT UserID, UserJoinedDate, gapday, firstPayment AS firstPaymentType
            FROM payment_x""",
        "brand_counts": """SELECT DeviceBrand, count(*) AS cnt FROM engagement
            WHERE DeviceBrand IS NOT NULL GROUP BY DeviceBrand""",
        "engage_t": f"""SELECT e.*, p.gapday,
            CASE WHEN bc.cnt >= {TIER_BIG} THEN 'Big' WHEN bc.cnt >= {TIER_MEDIUM} THEN 'Medium'
                 ELSE 'Small' END AS TypeBrand
            FROM engagement e LEFT JOIN pay_cols p ON p.UserID = e.UserID
            LEFT JOIN brand_counts bc ON bc.DeviceBrand = e.DeviceBrand""",
        "learn_g": """SELECT d.*, UsageTime * Records AS InteractionLearn, p.gapday
            FROM learn d LEFT JOIN pay_cols p ON p.UserID = d.UserID""",
        "action_h": _active("engage_t", hs),
        "learn_h": _active("learn_g", hs),
        "rfm_base": f"""SELECT {keys},
            CAST(horizon + 1 - max(ScaleActionDay) AS BIGINT) AS Recency,
            CAST(count(DISTINCT firstuse) + max(CASE WHEN firstuse IS NULL THEN 1 ELSE 0 END) AS BIGINT)
              AS ContentFrequent,
            CAST(sum(payment_screen_time) AS BIGINT) AS PaymentScreenFrequent,
            sum(UsageTime) AS TotalUsageTime, CAST(sum(Records) AS BIGINT) AS TotalRecords,
            max(ScaleGapday) AS ScaleGapday
            FROM action_h GROUP BY {keys}""",
        "m_fh": _mode("action_h", keys, "hour(firstuse)", "ModeFirstHour"),
        "m_lh": _mode("action_h", keys, "hour(lastuse)", "ModeLastHour"),
        "m_ld": _mode("action_h", keys, "day(lastuse)", "ModeLastDay"),
        "m_dw": _mode("action_h", keys, "isodow(lastuse) - 1", "ModeDayofweek"),
        "rfm": """SELECT r.horizon, r.UserID, Recency, ContentFrequent, PaymentScreenFrequent,
            TotalUsageTime, TotalRecords, ModeFirstHour, ModeLastHour, ModeLastDay, ModeDayofweek,
            ScaleGapday
            FROM rfm_base r JOIN m_fh USING (horizon, UserID) JOIN m_lh USING (horizon, UserID)
            JOIN m_ld USING (horizon, UserID) JOIN m_dw USING (horizon, UserID)""",
        "medians_h": f"""SELECT {keys}, median(UsageTime) AS MedianUsageTime,
            median(Records) AS MedianRecord, median(payment_screen_time) AS MedianPaymentScreen
            FROM action_h GROUP BY {keys}""",
        "brand_h": _pivot("action_h", keys, "TypeBrand", ["Big", "Medium", "Small"],
                          {"Brand": "1"}, agg="count", name="{value}{measure}"),
        "content_sum": _pivot("action_h", keys, "ActionType", ACTIONS,
                              {"Record": "Records", "UsageTime": "UsageTime"},
                              cast={"Record": "BIGINT"}),
        "demo_h": f"""SELECT {keys}, CAST(count(DISTINCT TypeBrand)
            + max(CASE WHEN TypeBrand IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS NoTypeBrand
            FROM action_h GROUP BY {keys}""",
        "content_learn": _pivot("learn_h", keys, "SubjectName", SUBJECTS,
                                {"Interaction": "InteractionLearn", "IsCompleted": "IsCompleted",
                                 "Record": "Records", "UsageTime": "UsageTime"},
                                cast={"IsCompleted": "BIGINT", "Record": "BIGINT"}),
    }
    learn_sel = ", ".join(f"COALESCE(cl.{c}, 0) AS {c}" for c in LEARN_COLS)
    v["features"] = f"""SELECT r.*, NoTypeBrand, BigBrand, MediumBrand, SmallBrand, {learn_sel},
        RecordDiscovery, RecordEntertainment, RecordLearn, UsageTimeDiscovery, UsageTimeEntertainment,
        UsageTimeLearn, MedianUsageTime, MedianRecord, MedianPaymentScreen,
        TotalChild, MedianChildAge, NoFemale, NoMale, p.firstPaymentType,
        CAST(month(p.UserJoinedDate) AS INTEGER) AS JoinMonth, p.gapday,
        TotalUsageTime / NULLIF(TotalRecords, 0) AS AvgTimePerCompletion,
        TotalUsageTime * TotalRecords AS InteractionGeneral,
        UsageTimeLearn * RecordLearn AS InteractionLearn,
        UsageTimeDiscovery * RecordDiscovery AS InteractionDiscovery,
        UsageTimeEntertainment * RecordEntertainment AS InteractionEntertainment,
        MedianUsageTime * MedianRecord AS MedianInteraction,
        CAST(COALESCE(r.ScaleGapday <= 31, false) AS INTEGER) AS Label
      FROM rfm r
      LEFT JOIN demo_h USING (horizon, UserID)
      LEFT JOIN brand_h USING (horizon, UserID)
      LEFT JOIN content_learn cl USING (horizon, UserID)
      LEFT JOIN content_sum USING (horizon, UserID)
      LEFT JOIN medians_h USING (horizon, UserID)
      LEFT JOIN demographics dm ON dm.UserID = r.UserID
      LEFT JOIN pay_cols p ON p.UserID = r.UserID
      WHERE TotalChild IS NOT NULL"""
    return v


def fq(body: str, hs=(1,)) -> str:
    extra = dict(EXTRA_VIEWS)
    extra["pay"] = _PAY
    extra.update(_features_views(hs))
    return with_views(body, extra)


ORACLE.update({
    "e15_active_days_features": fq("SELECT * FROM features", (1,)),
    "e04_all_horizons": fq("SELECT * FROM features", tuple(range(1, 9))),
    "e03_active_days_rows": fq("""SELECT horizon, UserID, EventDate, ActionType, MinFirstDay, ZeroDay,
        CutoffDay, ScaleActionDay, ScaleGapday FROM action_h""", (1,)),
    "d14_d16_rfm_modes": fq("SELECT * FROM rfm", (2,)),
    "d15_medians": fq("SELECT * FROM medians_h", (2,)),
    "d12_brand_tier_pivot": fq("SELECT * FROM brand_h", (2,)),
    "d10_action_pivot": fq("SELECT * FROM content_sum", (2,)),
    "d09_subject_pivot": fq("SELECT * FROM content_learn", (2,)),
    "d17_distinct_tiers": fq("SELECT * FROM demo_h", (2,)),
    "f02_brand_tiers": fq("SELECT DISTINCT DeviceBrand, TypeBrand FROM engage_t"),
})


AGE_SQL = """CAST(floor((datediff('month', ChildBday, DATE '2024-02-01')
    - CASE WHEN day(DATE '2024-02-01') < day(ChildBday) THEN 1 ELSE 0 END) / 12) AS BIGINT)"""
BRAND_COLUMNS = ["samsung", "oppo", "apple", "xiaomi", "vivo", "realme", "nokia", "Other brand"]


def _cutoff_views() -> dict[str, str]:
    v = {
        "ucb": f"""SELECT DISTINCT u.UserID, ChildID, ChildBday, ChildGender, DeviceBrand
            FROM user_profile u JOIN child_profile c ON c.UserID = u.UserID
            LEFT JOIN (SELECT DISTINCT UserID, DeviceBrand FROM event_logs_all) b ON b.UserID = u.UserID
            WHERE {COHORT_WHERE}""",
        "users_x": "SELECT * FROM ucb WHERE UserID NOT IN (SELECT UserID FROM fake_users)",
        "eng_x": """SELECT * EXCLUDE (open_time, payment_screen_time), open_time AS Opentime,
            payment_screen_time AS PaymentScreenTime
            FROM engagement WHERE UserID NOT IN (SELECT UserID FROM fake_users)""",
        "eng_raw_x": "SELECT * FROM engagement WHERE UserID NOT IN (SELECT UserID FROM fake_users)",
        "pay_x2": "SELECT * FROM payment_x WHERE UserID NOT IN (SELECT UserID FROM fake_users)",
        "first_day": """SELECT *, min(nth_day_from_registration) OVER (PARTITION BY UserID) AS MinFirstDay
            FROM eng_x""",
        "cut": """SELECT *, MinFirstDay + 3 AS cutoffDay, CAST(MinFirstDay > 0 AS INTEGER) AS lateUser,
            nth_day_from_registration - MinFirstDay AS usedDays
            FROM first_day WHERE MinFirstDay + 3 - nth_day_from_registration > 0""",
        "lab": """SELECT c.*, p.gapday,
            CAST(COALESCE(p.gapday - c.MinFirstDay <= 14, false) AS INTEGER) AS Label
            FROM cut c LEFT JOIN pay_x2 p ON p.UserID = c.UserID""",
        "bcnt": """SELECT DeviceBrand, count(*) AS cnt FROM users_x WHERE DeviceBrand IS NOT NULL
            GROUP BY DeviceBrand""",
        "users_b": """SELECT u.UserID, u.ChildID, CASE WHEN b.cnt < (SELECT avg(cnt) FROM bcnt)
            THEN 'Other brand' ELSE u.DeviceBrand END AS DeviceBrand
            FROM users_x u LEFT JOIN bcnt b ON b.DeviceBrand = u.DeviceBrand""",
        "brand_hot": "SELECT UserID, " + ", ".join(
            f"COALESCE(max(CAST(DeviceBrand = '{b}' AS INTEGER)), 0) AS brand_{b.replace(' ', '_')}"
            for b in BRAND_COLUMNS) + " FROM users_b GROUP BY UserID",
        "children": f"""SELECT UserID, CAST(count(DISTINCT ChildID) AS BIGINT) AS TotalChild,
            CAST(count(*) FILTER (WHERE ChildGender = 'female') AS BIGINT) AS NoFemale,
            CAST(count(*) FILTER (WHERE ChildGender = 'male') AS BIGINT) AS NoMale,
            median({AGE_SQL}) AS MedianChildAge FROM users_x GROUP BY UserID""",
        "merged": """SELECT UserID, EventDate, ActionType,
            CAST(sum(Opentime) AS BIGINT) AS Opentime, sum(UsageTime) AS UsageTime,
            CAST(sum(Records) AS BIGINT) AS Records,
            CAST(sum(PaymentScreenTime) AS BIGINT) AS PaymentScreenTime,
            max(cutoffDay) AS cutoffDay, max(lateUser) AS lateUser, max(Label) AS Label
            FROM lab GROUP BY UserID, EventDate, ActionType""",
        "labels_u": """SELECT UserID, max(cutoffDay) AS cutoffDay, max(lateUser) AS lateUser,
            max(Label) AS Label FROM merged GROUP BY UserID""",
        "base_u": "SELECT UserID, min(UserJoinedDate) AS UserJoinedDate FROM lab GROUP BY UserID",
        "total_u": """SELECT UserID, CAST(sum(Opentime) AS BIGINT) AS TotalOpentime,
            sum(UsageTime) AS TotalUsageTime, CAST(sum(Records) AS BIGINT) AS TotalRecords,
            CAST(sum(PaymentScreenTime) AS BIGINT) AS TotalPayscreentime FROM merged GROUP BY UserID""",
        "activity_u": _pivot("merged", "UserID", "ActionType", ACTIONS,
                             {"Opentime": "Opentime", "UsageTime": "UsageTime",
                              "Records": "Records", "PaymentScreenTime": "PaymentScreenTime"},
                             cast={"Opentime": "BIGINT", "Records": "BIGINT",
                                   "PaymentScreenTime": "BIGINT"}),
        "interest_a": """SELECT UserID, ActionType, sum(i) AS total_interest, avg(i) AS average_interest,
            arg_max(i, usedDays) - arg_min(i, usedDays) AS accumulate,
            CASE WHEN count(i) < 2 THEN NULL
                 WHEN var_samp(usedDays) = 0 OR var_samp(i) = 0 THEN 0.0
                 ELSE covar_pop(usedDays, i) / var_samp(usedDays) END AS slope
            FROM (SELECT *, UsageTime * Records AS i FROM lab) GROUP BY UserID, ActionType""",
        "interest": "SELECT *, slope / NULLIF(average_interest, 0) AS Slope_norm FROM interest_a",
        "most_i": """SELECT UserID,
            first(ActionType ORDER BY total_interest DESC, ActionType) AS MostInterest,
            first(total_interest ORDER BY total_interest DESC, ActionType) AS ti,
            first(Slope_norm ORDER BY total_interest DESC, ActionType) AS it,
            sum(total_interest) AS sum_ti,
            first(ActionType ORDER BY accumulate DESC, ActionType) AS MostAccumulate,
            first(accumulate ORDER BY accumulate DESC, ActionType) AS acc,
            first(Slope_norm ORDER BY accumulate DESC, ActionType) AS at_,
            sum(abs(accumulate)) AS sum_acc
            FROM interest GROUP BY UserID""",
        "most_interest": """SELECT UserID, MostInterest,
            CASE WHEN sum_ti = 0 THEN 0.0 ELSE ti / sum_ti END AS TotalInterestRatio,
            CASE WHEN it IS NULL OR isnan(it) THEN 0.0 ELSE it END AS InterestTrend,
            MostAccumulate,
            CASE WHEN sum_acc = 0 THEN 0.0 ELSE acc / sum_acc END AS TotalAccuRatio,
            CASE WHEN at_ IS NULL OR isnan(at_) THEN 0.0 ELSE at_ END AS AccuTrend
            FROM most_i""",
        "cutoff_features": """SELECT * FROM base_u
            LEFT JOIN children USING (UserID) LEFT JOIN total_u USING (UserID)
            LEFT JOIN activity_u USING (UserID) LEFT JOIN most_interest USING (UserID)
            LEFT JOIN brand_hot USING (UserID) LEFT JOIN labels_u USING (UserID)""",
    }
    return v


def cq(body: str) -> str:
    extra = dict(EXTRA_VIEWS)
    extra["pay"] = _PAY
    extra.update(_features_views((1,)))
    extra.update(_cutoff_views())
    return with_views(body, extra)


_ENG_SLOPE = """SELECT UserID, ActionType, {expr} AS slope FROM eng_raw_x GROUP BY UserID, ActionType"""

ORACLE.update({
    "c04_remove_fake_users": cq("SELECT * FROM pay_x2"),
    "e01_first_active_day": cq("""SELECT UserID, EventDate, ActionType, MinFirstDay,
        CASE WHEN MinFirstDay = 0 THEN 'zero' ELSE 'other' END AS ZeroDay,
        CAST(MinFirstDay > 0 AS INTEGER) AS lateUser FROM first_day"""),
    "e02_cutoff_exclusive": cq("SELECT UserID, EventDate, ActionType, cutoffDay, usedDays, lateUser FROM cut"),
    "e05_label_relative": cq("SELECT UserID, EventDate, ActionType, gapday, Label FROM lab"),
    "e06_label_absolute": cq("""SELECT UserID, gapday,
        CAST(COALESCE(gapday <= 31, false) AS INTEGER) AS LabelB FROM payment_x"""),
    "e07_label_scaled": cq("""SELECT UserID, CAST(COALESCE(max(ScaleGapday) <= 31, false) AS INTEGER)
        AS LabelC FROM action_h GROUP BY UserID"""),
    "e08_ols_slope": cq(_ENG_SLOPE.format(expr="""CASE WHEN count(UsageTime) * sum(x * x) - sum(x) * sum(x) = 0
        THEN 0.0 ELSE (count(UsageTime) * sum(x * UsageTime) - sum(x) * sum(UsageTime))
        / (count(UsageTime) * sum(x * x) - sum(x) * sum(x)) END""").replace(
        "FROM eng_raw_x", "FROM (SELECT *, nth_day_from_registration AS x FROM eng_raw_x)")),
    "e09_scaled_slope": cq(_ENG_SLOPE.format(expr="""CASE WHEN count(UsageTime) < 2 THEN NULL
        WHEN var_samp(nth_day_from_registration) = 0 OR var_samp(UsageTime) = 0 THEN 0.0
        ELSE covar_pop(nth_day_from_registration, UsageTime) / var_samp(nth_day_from_registration) END""")),
    "e10_successive_diff": cq("""SELECT UserID, ActionType, EventDate, COALESCE(d, 0.0) AS diff FROM (
        SELECT *, UsageTime - lag(UsageTime) OVER w AS d, row_number() OVER w AS rn,
               count(*) OVER (PARTITION BY UserID, ActionType) AS n
        FROM eng_raw_x WINDOW w AS (PARTITION BY UserID, ActionType ORDER BY nth_day_from_registration))
        WHERE rn > 1 OR n = 1"""),
    "e11_interest_by_action": cq("SELECT * FROM interest"),
    "e12_e13_most_interest": cq("SELECT * FROM most_interest"),
    "e14_cutoff_features": cq("SELECT * FROM cutoff_features"),
    "d06_d08_children_summary": cq("SELECT * FROM children"),
    "d31_collapse_day_action": cq("SELECT * FROM merged"),
    "d13_totals": cq("SELECT * FROM total_u"),
    "d11_action_measure_pivot": cq("SELECT * FROM activity_u"),
    "f01_rare_brand_collapse": cq("SELECT UserID, ChildID, DeviceBrand FROM users_b"),
    "f03_brand_one_hot": cq("SELECT * FROM brand_hot"),
    "f03_interest_one_hot": cq("SELECT UserID, " + ", ".join(
        f"CAST(coalesce({c} = '{a}', false) AS INTEGER) AS {c}_{a}"
        for c in ("MostInterest", "MostAccumulate") for a in ("Discovery", "Entertainment", "Learn"))
        + " FROM most_interest"),
})


# ---- search ---------------------------------------------------------------------------
WORD_RE = r"[\p{L}\p{N}_]{2,}"
STOP = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "in",
        "is", "it", "its", "of", "on", "or", "that", "the", "to", "was", "were", "with"]
_STOP_LIST = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
VIET = "àáạảãâầấậẩẫăằắặẳẵèéẹẻẽêềếệểễòóọỏõôồốộổỗơờớợởỡìíịỉĩùúụủũưừứựửữỳýỵỷỹđ"


def _clean_full(col: str) -> str:
    t = f"regexp_replace(lower({col}), '[^a-z0-9{VIET}]+', ' ', 'g')"
    t = f"regexp_replace({t}, '(^| )0+', '\\1', 'g')"
    return f"trim(regexp_replace({t}, ' +', ' ', 'g'))"


def _split_words(col: str) -> str:
    return f"list_filter(regexp_split_to_array(trim({col}), '\\s+'), lambda w: w <> '')"


def _search_views(form: str = "smooth", max_features: int | None = None, stop: bool = False) -> dict:
    stop_f = f" WHERE NOT list_contains({_STOP_LIST}, term)" if stop else ""
    idf = ("ln((1 + n) / (1.0 + count(*))) + 1" if form == "smooth"
           else "log2(CAST(n AS DOUBLE) / count(*))")
    v = {
        "d_tok": f"""SELECT * FROM (SELECT doc_id AS id,
            unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM documents){stop_f}""",
        "q_tok": f"""SELECT * FROM (SELECT item_id AS id,
            unnest(regexp_extract_all(lower(text), '{WORD_RE}')) AS term FROM benchmark){stop_f}""",
        "d_tf0": "SELECT id, term, count(*) AS tf FROM d_tok GROUP BY id, term",
        "q_tf": "SELECT id, term, count(*) AS tf FROM q_tok GROUP BY id, term",
        "ndocs": "SELECT count(DISTINCT doc_id) AS n FROM documents",
    }
    if max_features:
        v["top_terms"] = f"""SELECT term FROM (SELECT term, sum(tf) AS c FROM d_tf0 GROUP BY term
            ORDER BY c DESC, term LIMIT {max_features})"""
        v["d_tf"] = "SELECT * FROM d_tf0 WHERE term IN (SELECT term FROM top_terms)"
    else:
        v["d_tf"] = "SELECT * FROM d_tf0"
    v.update({
        "idf": f"SELECT term, {idf} AS idf FROM d_tf, ndocs GROUP BY term, n",
        "d_w": "SELECT id, term, tf * idf AS w FROM d_tf JOIN idf USING (term) WHERE tf * idf <> 0",
        "q_w": "SELECT id, term, tf * idf AS w FROM q_tf JOIN idf USING (term) WHERE tf * idf <> 0",
        "d_vec": "SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM d_w",
        "q_vec": "SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM q_w",
        "scores": """SELECT q.id AS query_id, d.id AS doc_id, round(sum(q.w * d.w), 10) AS score
            FROM q_vec q JOIN d_vec d USING (term) GROUP BY q.id, d.id""",
        # Every pair: documents without a common term have the score 0.
        "pairs_all": "SELECT b.item_id AS query_id, d.doc_id FROM benchmark b CROSS JOIN documents d",
        "all_scores": """SELECT query_id, doc_id, coalesce(score, 0.0) AS score
            FROM pairs_all LEFT JOIN scores USING (query_id, doc_id)""",
        "cos_top": """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id
            ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM all_scores) WHERE rank <= 5""",
        # count vectors
        "c_d_tf": "SELECT * FROM d_tf",
        "c_q_tf": "SELECT * FROM q_tf WHERE term IN (SELECT term FROM d_tf)",
        "c_d_vec": """SELECT id, term, tf / sqrt(sum(tf * tf) OVER (PARTITION BY id)) AS w FROM c_d_tf""",
        "c_q_vec": """SELECT id, term, tf / sqrt(sum(tf * tf) OVER (PARTITION BY id)) AS w FROM c_q_tf""",
        "c_scores": """SELECT q.id AS query_id, d.id AS doc_id, round(sum(q.w * d.w), 10) AS score
            FROM c_q_vec q JOIN c_d_vec d USING (term) GROUP BY q.id, d.id""",
        # token sets (clean_full + split)
        "d_set": f"""SELECT id, term, count(*) OVER (PARTITION BY id) AS n FROM (SELECT DISTINCT doc_id AS id,
            unnest({_split_words(_clean_full('text'))}) AS term FROM documents)""",
        "q_set": f"""SELECT id, term, count(*) OVER (PARTITION BY id) AS n FROM (SELECT DISTINCT item_id AS id,
            unnest({_split_words(_clean_full('text'))}) AS term FROM benchmark)""",
        "jac": """SELECT q.id AS query_id, d.id AS doc_id,
            round(count(*) / (min(q.n) + min(d.n) - count(*)), 10) AS score
            FROM q_set q JOIN d_set d USING (term) GROUP BY q.id, d.id""",
        "truth": """SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d
            ON contains(d.text, b.text)""",
    })
    return v


def sq(body: str, **kw) -> str:
    return with_views(body, _search_views(**kw))


def _rank(src: str, score: str = "score", asc: bool = False, k: int = 5) -> str:
    order = f"{score} {'ASC' if asc else 'DESC'}, doc_id"
    return f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY {order})
        AS INTEGER) AS rank FROM {src}) WHERE rank <= {k}"""


_EVALUATION = """SELECT b.item_id AS query_id, min(c.rank) AS best_rank,
        CASE WHEN min(c.rank) = 1 THEN 'Matching' WHEN min(c.rank) IS NOT NULL THEN 'In top'
             ELSE 'No result' END AS outcome
        FROM benchmark b
        LEFT JOIN (SELECT c.query_id, c.rank FROM cos_top c JOIN truth USING (query_id, doc_id)) c
          ON c.query_id = b.item_id GROUP BY b.item_id"""


ORACLE.update({
    "h01_count_vectors": sq("SELECT id AS doc_id, term, tf FROM d_tf", stop=True),
    "h02_tfidf_sklearn": sq("SELECT id AS doc_id, term, round(w, 10) AS w FROM d_vec"),
    "h03_tfidf_max_features": sq("SELECT id AS doc_id, term, round(w, 10) AS w FROM d_vec",
                                 max_features=1000),
    "h04_tfidf_gensim": sq("SELECT id AS doc_id, term, round(w, 10) AS w FROM d_vec", form="log2"),
    "h05_cosine_top5": sq("SELECT * FROM cos_top"),
    "h06_count_cosine_top5": sq(_rank("""(SELECT query_id, doc_id, coalesce(score, 0.0) AS score
        FROM pairs_all LEFT JOIN c_scores USING (query_id, doc_id))"""), stop=True),
    "h07_euclid_knn5": sq(_rank("""(SELECT query_id, doc_id, round(sqrt(greatest(0.0,
          CASE WHEN query_id IN (SELECT id FROM q_vec) THEN 1 ELSE 0 END
          + CASE WHEN doc_id IN (SELECT id FROM d_vec) THEN 1 ELSE 0 END - 2 * score)), 10) AS distance
        FROM all_scores)""", "distance", True)),
    "h14_jaccard_top5": sq(_rank("""(SELECT query_id, doc_id, coalesce(score, 0.0) AS score
        FROM pairs_all LEFT JOIN jac USING (query_id, doc_id))""")),
    "h08_total_variance": sq("""SELECT CAST(count(*) AS INTEGER) AS components,
        round(sum((s2 - s1 * s1 / n) / (n - 1)), 8) AS variance
        FROM (SELECT term, sum(w) AS s1, sum(w * w) AS s2 FROM d_vec GROUP BY term)
        CROSS JOIN (SELECT count(DISTINCT id) AS n FROM d_vec)""", max_features=1200),
    "h24_containment_truth": sq("SELECT * FROM truth"),
    "h24_search_evaluation": sq(_EVALUATION),
    "h24_search_hit_rate": sq(f"""SELECT count(*) AS queries,
        count(*) FILTER (WHERE outcome = 'Matching') AS top1,
        count(*) FILTER (WHERE outcome <> 'No result') AS topk,
        count(*) FILTER (WHERE outcome <> 'No result') / count(*) AS hit_rate FROM ({_EVALUATION})"""),
})


# ---- text preparation -------------------------------------------------------------
PUNCT = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
FORMULA_RE = r"\\\(.*?\\\)"
DISPLAY_RE = r"\\\[.*?\\\]"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def x_light(c):
    return f"trim(regexp_replace(lower({c}), ' +', ' ', 'g'))"


def x_accent(c):
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[{VIET}]', '', 'g'), ' +', ' ', 'g'))"


def x_letters(c):
    t = f"translate({c}, {_lit(PUNCT)}, {_lit(' ' * len(PUNCT))})"
    return f"lower(regexp_replace({t}, '\\d+', '', 'g'))"


def x_forms(c):
    return f"regexp_extract_all({c}, {_lit(FORMULA_RE)})"


def x_strip_forms(c):
    return f"regexp_replace({c}, {_lit(FORMULA_RE)}, '', 'g')"


def x_text_tokens(c):
    return _split_words(x_letters(x_strip_forms(c)))


def x_word_tokens(c):
    return f"regexp_extract_all(lower({c}), '{WORD_RE}')"


def x_op_forms(forms):
    return f"list_filter({forms}, lambda f: regexp_matches(f, '[+\\-*/=<>]'))"


def x_strip_latex(c):
    t = f"regexp_replace({c}, '\\\\left\\(', '\\\\left( ', 'g')"
    t = f"regexp_replace({t}, '\\\\right\\)', ' \\\\right)', 'g')"
    t = f"regexp_replace({t}, '\\\\[()\\[\\]]', ' ', 'g')"
    t = f"regexp_replace({t}, '\\\\[A-Za-z]+', ' ', 'g')"
    t = f"regexp_replace({t}, '[()\\[\\]{{}}|]', ' ', 'g')"
    return f"lower(trim(regexp_replace({t}, ' +', ' ', 'g')))"


def x_ratio(c, which):
    tl = f"length({x_letters(x_strip_forms(c))})"
    fl = f"length(array_to_string({x_forms(c)}, ' '))"
    num = tl if which == "text" else fl
    return f"round({num} / ({tl} + {fl} + 1e-8), 10)"


def x_kind(c, version):
    forms, toks = x_forms(c), x_text_tokens(c)
    k = 2 if version == 2 else 1
    blank = f"length(trim({x_letters(x_strip_forms(c))})) = 0"
    return (f"CASE WHEN len({forms}) = 0 THEN 'Text only' "
            f"WHEN {blank} OR len({toks}) < len({forms}) * {k} OR len(list_distinct({toks})) <= 1 "
            f"THEN 'Math only' ELSE 'Math and Text' END")


def x_kind_major(c):
    forms, toks = x_forms(c), x_text_tokens(c)
    ops = f"len(list_filter({forms}, lambda f: regexp_matches(f, '[+\\-*/=<>^]')))"
    return (f"CASE WHEN len({toks}) < len({forms}) * 2 OR len({toks}) <= 5 THEN 'Math only' "
            f"WHEN len({forms}) = 0 OR {ops} * 2 < len({forms}) THEN 'Text only' "
            f"ELSE 'Math and Text' END")


def _words_only(c):
    """Text without formulas; everything but letters, digits and _ is a space."""
    plain = f"regexp_replace({x_strip_forms(c)}, '\\\\\\[.*?\\\\\\]', '', 'g')"
    return f"regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}_]', ' ', 'g')"


def x_non_ascii_word(c):
    words = (f"list_filter({_split_words(_words_only(c))}, lambda w: length(w) > 1 AND "
             f"NOT regexp_matches(w, '^\\p{{Nd}}+$'))")
    non = f"len(list_filter({words}, lambda w: regexp_matches(w, '[^\\x00-\\x7F]')))"
    return f"CASE WHEN len({words}) = 0 THEN -1.0 ELSE round({non} / (len({words}) + 1e-9), 10) END"


def x_non_ascii_char(c):
    chars = f"length(regexp_replace({_words_only(c)}, ' ', '', 'g'))"
    non = f"length(regexp_replace({_words_only(c)}, '[\\x00-\\x7F]', '', 'g'))"
    return f"CASE WHEN {chars} = 0 THEN -1.0 ELSE round({non} / ({chars} + 1e-9), 10) END"


def x_n_words(c):
    return f"CAST(len({_split_words(c)}) AS BIGINT)"


_TEXT_VIEWS = {
    "dl": "SELECT LookupText, count(*) AS n FROM feedback_pairs GROUP BY 1",
    "dq": "SELECT QuestionText, count(*) AS n FROM feedback_pairs GROUP BY 1",
    "dp": """SELECT LookupText, QuestionText, count(*) AS n, count(DISTINCT HumanFeedback) AS labels
        FROM feedback_pairs GROUP BY 1, 2""",
    "pair_tok": f"""SELECT FeedbackID, {x_text_tokens('LookupText')} AS lt,
        {x_text_tokens('QuestionText')} AS qt FROM feedback_pairs""",
    "vocab": """SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS token_id FROM (
        SELECT DISTINCT unnest(lt) AS token FROM pair_tok UNION SELECT DISTINCT unnest(qt) FROM pair_tok)""",
    "vcorpus": f"""SELECT DISTINCT doc, term FROM (
        SELECT 'l' || FeedbackID AS doc, unnest({x_word_tokens(x_letters(x_strip_forms('LookupText')))}) AS term
        FROM feedback_pairs UNION ALL
        SELECT 'q' || FeedbackID, unnest({x_word_tokens(x_letters(x_strip_forms('QuestionText')))})
        FROM feedback_pairs)""",
    "vocab_idf": """SELECT v.token, v.token_id,
        ln((1.0 + 2 * (SELECT count(*) FROM feedback_pairs)) / (1.0 + COALESCE(d.df, 0))) + 1 AS idf
        FROM vocab v LEFT JOIN (SELECT term, count(*) AS df FROM vcorpus GROUP BY term) d ON d.term = v.token""",
}


def tq(body: str) -> str:
    views = dict(_TEXT_VIEWS)
    return with_views(body, views)


ORACLE.update({
    "g01_g04_cleaning": tq(f"""SELECT doc_id, {_clean_full('text')} AS "full", {x_light('text')} AS light,
        {x_accent('text')} AS accent_deleted, {x_letters('text')} AS letters FROM formula_documents"""),
    "g06_stop_word_removal": tq(f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens,
        array_to_string(t, ' ') AS tokens FROM (SELECT doc_id,
        list_filter({x_word_tokens('text')}, lambda w: NOT list_contains({_STOP_LIST}, w)) AS t FROM documents)"""),
    "g07_length_features": tq(f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars,
        {x_n_words('text')} AS n_words,
        CASE WHEN {x_n_words('text')} > 0 THEN length(text) / {x_n_words('text')} END AS avg_word_len
        FROM documents"""),
    "g08_dedup_pairs": tq("""SELECT FeedbackID, FeedbackType, FeedbackResult, HumanFeedback FROM (
        SELECT *, row_number() OVER (PARTITION BY LookupText, QuestionText ORDER BY FeedbackID) AS rn
        FROM feedback_pairs) WHERE rn = 1"""),
    "g09_dedup_documents": tq("""SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY text
        ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1"""),
    "g10_duplicate_audit": tq("""
        SELECT 'rows' AS measure, CAST(count(*) AS DOUBLE) AS value FROM feedback_pairs
        UNION ALL SELECT 'dup_lookup_rows', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS DOUBLE) FROM dl
        UNION ALL SELECT 'dup_question_rows', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS DOUBLE) FROM dq
        UNION ALL SELECT 'dup_pair_rows', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS DOUBLE) FROM dp
        UNION ALL SELECT 'dup_pair_groups', CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE) FROM dp
        UNION ALL SELECT 'conflicting_pair_groups',
          CAST(count(*) FILTER (WHERE n > 1 AND labels > 1) AS DOUBLE) FROM dp"""),
    "g11_duplicated_lookup_only": tq("""SELECT FeedbackID, HumanFeedback FROM feedback_pairs
        WHERE LookupText IN (SELECT LookupText FROM feedback_pairs GROUP BY LookupText
                             HAVING count(*) > 1 AND count(DISTINCT QuestionText) > 1)"""),
    "a01_a02_csv_extract": "SELECT event_id, user_id, event_type FROM events",
    "a03_sql_extracts": """SELECT 'per_user' AS extract, user_id AS k, count(*) AS n FROM events GROUP BY user_id
        UNION ALL SELECT 'per_customer', o_custkey, count(*) FROM orders GROUP BY o_custkey""",
    "a05_write_by_horizon": f"SELECT horizon, count(*) AS users FROM ({ORACLE['e04_all_horizons']}) GROUP BY horizon",
    "b14_drop_columns": "SELECT DISTINCT user_id AS UserID FROM events",
    "g11_duplicated_question_only": tq("""SELECT FeedbackID, HumanFeedback FROM feedback_pairs
        WHERE QuestionText IN (SELECT QuestionText FROM feedback_pairs GROUP BY QuestionText
                               HAVING count(*) > 1 AND count(DISTINCT LookupText) > 1)"""),
    "g12_short_text_share": tq(f"""SELECT count(*) AS rows,
        count(*) FILTER (WHERE {x_n_words('text')} <= 5) AS short_rows,
        count(*) FILTER (WHERE {x_n_words('text')} <= 5) / count(*) AS share FROM conversations"""),
    "g13_g16_formula_split": tq(f"""SELECT doc_id, CAST(len({x_forms('text')}) AS BIGINT) AS n_formulas,
        array_to_string({x_forms('text')}, ' | ') AS formulas,
        CAST(len({x_op_forms(x_forms('text'))}) AS BIGINT) AS n_operator_formulas,
        CAST(length({x_strip_forms('text')}) AS BIGINT) AS text_len,
        {x_strip_latex(f"array_to_string({x_forms('text')}, ' ')")} AS formula_plain,
        {x_ratio('text', 'text')} AS text_ratio, {x_ratio('text', 'formula')} AS formula_ratio
        FROM formula_documents"""),
    "g17_g18_text_kind": tq(f"""SELECT doc_id, {x_kind('text', 1)} AS kind_v1, {x_kind('text', 2)} AS kind_v2,
        {x_kind_major('text')} AS kind_majority FROM formula_documents"""),
    "g19_non_ascii_share": tq(f"""SELECT doc_id, {x_non_ascii_word('text')} AS word_share,
        {x_non_ascii_char('text')} AS char_share FROM documents"""),
    "g20_vocabulary": tq("SELECT * FROM vocab"),
    "g21_vocabulary_idf": tq("SELECT token, token_id, round(idf, 10) AS idf FROM vocab_idf"),
    "g22_g23_sequences": tq("""SELECT p.FeedbackID,
        COALESCE(array_to_string(list(v.token_id ORDER BY u.pos) FILTER (WHERE u.pos IS NOT NULL), ' '), '') AS seq,
        array_to_string(list_concat(
          COALESCE(list(CAST(v.token_id AS VARCHAR) ORDER BY u.pos) FILTER (WHERE u.pos IS NOT NULL), []),
          list_transform(range(greatest(800, (SELECT max(len(lt)) FROM pair_tok)) - len(p.lt)),
                         lambda i: '-1')), ' ') AS padded,
        CAST(greatest(800, (SELECT max(len(lt)) FROM pair_tok)) AS BIGINT) AS padded_len
        FROM pair_tok p
        LEFT JOIN (SELECT FeedbackID, unnest(lt) AS token, generate_subscripts(lt, 1) AS pos FROM pair_tok) u
          ON u.FeedbackID = p.FeedbackID
        LEFT JOIN vocab v ON v.token = u.token
        GROUP BY p.FeedbackID, p.lt"""),
    "g24_top_terms": tq(f"""SELECT term, CAST(sum(tf) AS BIGINT) AS total FROM (SELECT doc_id, term, count(*) AS tf
        FROM (SELECT doc_id, unnest({x_word_tokens('text')}) AS term FROM documents) GROUP BY ALL)
        GROUP BY term ORDER BY total DESC, term LIMIT 50"""),
    "g25_mismatched_kinds": tq(f"""SELECT unnest(list_filter([
          CASE WHEN lookup_kind <> 'Math and Text' AND question_kind = 'Math and Text' THEN 'mixed question' END,
          CASE WHEN lookup_kind = 'Math only' AND question_kind <> 'Math only' THEN 'math look-up' END,
          CASE WHEN lookup_kind = 'Text only' AND question_kind <> 'Text only' THEN 'text look-up' END],
          lambda x: x IS NOT NULL)) AS subset, FeedbackID, lookup_kind, question_kind
        FROM (SELECT FeedbackID, {x_kind('LookupText', 2)} AS lookup_kind,
          {x_kind('QuestionText', 2)} AS question_kind FROM feedback_pairs)"""),
    "g13_g17_variants": tq(f"""SELECT doc_id, CAST(len(f) AS BIGINT) AS n_formulas,
        array_to_string(f, ' | ') AS formulas, CAST(length(plain) AS BIGINT) AS text_len,
        round(nt / (nt + nf + 1e-5), 10) AS text_ratio, round(nf / (nt + nf + 1e-5), 10) AS formula_ratio,
        CASE WHEN nf = 0 THEN 'Text only' WHEN nt < nf THEN 'Math only' ELSE 'Math and Text' END AS kind_v0
        FROM (SELECT doc_id, {x_forms('text')} || regexp_extract_all(text, '{DISPLAY_RE}') AS f,
          regexp_replace({x_strip_forms('text')}, '{DISPLAY_RE}', '', 'g') AS plain,
          len({x_text_tokens('text')}) AS nt, len({x_forms('text')}) AS nf FROM formula_documents)"""),
    "g25_kind_summary": tq(f"""SELECT {x_kind('LookupText', 2)} AS lookup_kind,
        {x_kind('QuestionText', 2)} AS question_kind, count(*) AS n FROM feedback_pairs GROUP BY ALL"""),
})


# ---- paired similarity ----------------------------------------------------------------
def x_squeeze(c):
    return f"trim(regexp_replace({c}, ' +', ' ', 'g'))"


def x_edit(a, b):
    m = f"greatest(length({a}), length({b}))"
    return f"CASE WHEN {m} = 0 THEN 1.0 ELSE 1 - levenshtein({a}, {b}) / {m} END"


def x_fuzzy(a, b):
    ts = lambda c: f"array_to_string(list_sort({_split_words(c)}), ' ')"
    ta, tb = f"list_distinct({_split_words(a)})", f"list_distinct({_split_words(b)})"
    mn = f"least(len({ta}), len({tb}))"
    ov = f"CASE WHEN {mn} = 0 THEN 0.0 ELSE len(list_intersect({ta}, {tb})) / {mn} END"
    return f"greatest({x_edit(a, b)}, {x_edit(ts(a), ts(b))}, {ov})"


def x_formula_score(lf, qf):
    best = f"list_transform({lf}, lambda f: list_max(list_transform({qf}, lambda g: {x_fuzzy('f', 'g')})))"
    return (f"CASE WHEN len({lf}) = 0 OR len({qf}) = 0 THEN 0.0 "
            f"ELSE CAST(list_sum({best}) AS DOUBLE) / len({lf}) END")


def _pair_search_views():
    v = {
        "pq": f"SELECT FeedbackID AS id, {_clean_full('QuestionText')} AS text FROM feedback_pairs",
        "pl": f"SELECT FeedbackID AS id, {_clean_full('LookupText')} AS text FROM feedback_pairs",
        # Fit on questions, top 1200 terms, stop words removed
        "pq_tf0": f"""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({x_word_tokens('text')}) AS term
            FROM pq) WHERE NOT list_contains({_STOP_LIST}, term) GROUP BY id, term""",
        "pq_top": """SELECT term FROM (SELECT term, sum(tf) AS c FROM pq_tf0 GROUP BY term
            ORDER BY c DESC, term LIMIT 1200)""",
        "pq_tf": "SELECT * FROM pq_tf0 WHERE term IN (SELECT term FROM pq_top)",
        "pq_idf": """SELECT term, ln((1 + (SELECT count(DISTINCT id) FROM pq)) / (1.0 + count(*))) + 1 AS idf
            FROM pq_tf GROUP BY term""",
        "pq_vec": """SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
            SELECT id, term, tf * idf AS w FROM pq_tf JOIN pq_idf USING (term))""",
        "pl_tf": f"""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({x_word_tokens('text')}) AS term
            FROM pl) WHERE NOT list_contains({_STOP_LIST}, term) GROUP BY id, term""",
        "pl_vec": """SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
            SELECT id, term, tf * idf AS w FROM pl_tf JOIN pq_idf USING (term))""",
        "pcos": """SELECT p.FeedbackID, p.HumanFeedback, round(COALESCE(c.cosine, 0.0), 10) AS cosine
            FROM feedback_pairs p LEFT JOIN (SELECT l.id, sum(l.w * q.w) AS cosine FROM pl_vec l
            JOIN pq_vec q ON q.id = l.id AND q.term = l.term GROUP BY l.id) c ON c.id = p.FeedbackID""",
        # Full search, no stop words, no feature cap
        "fq_tf": f"""SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({x_word_tokens('text')}) AS term
            FROM pq) GROUP BY id, term""",
        "fq_idf": """SELECT term, ln((1 + (SELECT count(DISTINCT id) FROM pq)) / (1.0 + count(*))) + 1 AS idf
            FROM fq_tf GROUP BY term""",
        "fq_vec": """SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
            SELECT id, term, tf * idf AS w FROM fq_tf JOIN fq_idf USING (term))""",
        "fl_vec": f"""SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM (
            SELECT id, term, tf * idf AS w FROM (SELECT id, term, count(*) AS tf FROM (
              SELECT id, unnest({x_word_tokens('text')}) AS term FROM pl) GROUP BY id, term)
            JOIN fq_idf USING (term))""",
        "fscores": """SELECT l.id AS FeedbackID, q.id AS found_id, round(sum(l.w * q.w), 10) AS score
            FROM fl_vec l JOIN fq_vec q USING (term) GROUP BY l.id, q.id""",
        "franked": """SELECT *, CAST(row_number() OVER (PARTITION BY FeedbackID ORDER BY score DESC, found_id)
            AS INTEGER) AS rank FROM fscores""",
        "top1": """SELECT p.FeedbackID, r.found_id, r.score,
            CASE WHEN COALESCE(f.QuestionText = p.QuestionText OR f.QuestionText = p.LookupText, false)
                 THEN 'MATCH' ELSE 'NOT MATCH' END AS SE_match
            FROM feedback_pairs p LEFT JOIN (SELECT * FROM franked WHERE rank = 1) r ON r.FeedbackID = p.FeedbackID
            LEFT JOIN feedback_pairs f ON f.FeedbackID = r.found_id""",
        "fhits": """SELECT r.FeedbackID, min(r.rank) AS best_rank FROM franked r
            JOIN feedback_pairs f ON f.FeedbackID = r.found_id
            JOIN feedback_pairs p ON p.FeedbackID = r.FeedbackID
            WHERE r.rank <= 5 AND f.QuestionText = p.QuestionText GROUP BY r.FeedbackID""",
        # Idf sequences
        "seq_ex": """SELECT FeedbackID, 'l' AS side, unnest(lt) AS token, generate_subscripts(lt, 1) AS pos
            FROM pair_tok UNION ALL
            SELECT FeedbackID, 'q', unnest(qt), generate_subscripts(qt, 1) FROM pair_tok""",
        "seq_w": "SELECT s.*, v.idf FROM seq_ex s JOIN vocab_idf v ON v.token = s.token",
        "seq_cos": """SELECT p.FeedbackID,
            CASE WHEN len(p.lt) = 0 OR len(p.qt) = 0 OR COALESCE(na, 0) = 0 OR COALESCE(nb, 0) = 0 THEN 0.0
                 ELSE round(COALESCE(dot, 0.0) / (na * nb), 10) END AS seq_cosine, p.lt
            FROM pair_tok p
            LEFT JOIN (SELECT FeedbackID, sqrt(sum(idf * idf)) AS na FROM seq_w WHERE side = 'l' GROUP BY 1) a
              USING (FeedbackID)
            LEFT JOIN (SELECT FeedbackID, sqrt(sum(idf * idf)) AS nb FROM seq_w WHERE side = 'q' GROUP BY 1) b
              USING (FeedbackID)
            LEFT JOIN (SELECT l.FeedbackID, sum(l.idf * q.idf) AS dot FROM seq_w l JOIN seq_w q
              ON q.FeedbackID = l.FeedbackID AND q.pos = l.pos AND l.side = 'l' AND q.side = 'q'
              GROUP BY l.FeedbackID) d USING (FeedbackID)""",
        "fscore": f"""SELECT FeedbackID, {x_formula_score(x_forms('LookupText'), x_forms('QuestionText'))}
            AS formula_score, {x_forms('LookupText')} AS lf FROM feedback_pairs""",
    }
    return v


def pq_(body: str) -> str:
    views = dict(_TEXT_VIEWS)
    views.update(_pair_search_views())
    return with_views(body, views)


_V1 = """SELECT s.FeedbackID,
    round(CASE WHEN len(list_distinct(s.lt)) > 2 THEN s.seq_cosine ELSE 0.0 END, 10) AS text_score,
    round(CASE WHEN len(list_distinct(s.lt)) > 2 AND len(f.lf) = 0 THEN 0.0 ELSE f.formula_score END, 10)
      AS formula_score,
    round(CASE WHEN len(list_distinct(s.lt)) <= 2 THEN f.formula_score
               WHEN len(f.lf) = 0 THEN s.seq_cosine
               WHEN (s.seq_cosine <> 0)::INT + (f.formula_score <> 0)::INT = 0 THEN 0.0
               ELSE (s.seq_cosine + f.formula_score)
                    / ((s.seq_cosine <> 0)::INT + (f.formula_score <> 0)::INT) END, 10) AS final_score
    FROM seq_cos s JOIN fscore f USING (FeedbackID)"""

ORACLE.update({
    "h15_pair_cosine": pq_("SELECT *, CAST(cosine >= 0.8 AS INTEGER) AS high FROM pcos"),
    "h16_pair_jaccard": pq_(f"""SELECT FeedbackID, HumanFeedback, j AS jaccard, CAST(j >= 0.8 AS INTEGER) AS high
        FROM (SELECT *, round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 0.0
              ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 10) AS j
        FROM (SELECT *, {_split_words(_clean_full('LookupText'))} AS a,
              {_split_words(_clean_full('QuestionText'))} AS b FROM feedback_pairs))"""),
    "h17_sequence_cosine": pq_("SELECT FeedbackID, seq_cosine FROM seq_cos"),
    "h20_formula_score": pq_("SELECT FeedbackID, round(formula_score, 10) AS formula_score FROM fscore"),
    "h21_combined_ranker_v1": pq_(_V1),
    "h23_batch_search_top1": pq_("SELECT * FROM top1"),
    "h25_feedback_evaluation": pq_("""SELECT CASE WHEN h.best_rank = 1 THEN 'Matching'
          WHEN h.best_rank IS NOT NULL THEN 'In top' ELSE 'No result' END AS outcome,
        p.HumanFeedback, count(*) AS n
        FROM feedback_pairs p LEFT JOIN fhits h USING (FeedbackID) GROUP BY ALL"""),
    "h26_agreement": pq_("""SELECT count(*) FILTER (WHERE FeedbackType = 'POSITIVE' AND HumanFeedback = 'NOT MATCH')
          AS positive_not_match,
        count(*) FILTER (WHERE FeedbackType = 'NEGATIVE' AND HumanFeedback = 'MATCH') AS negative_match,
        count(*) AS rows,
        (count(*) FILTER (WHERE FeedbackType = 'POSITIVE' AND HumanFeedback = 'NOT MATCH')
         + count(*) FILTER (WHERE FeedbackType = 'NEGATIVE' AND HumanFeedback = 'MATCH')) / count(*)
          AS disagreement_rate FROM feedback_pairs"""),
    "h27_review_list": pq_("""SELECT * FROM top1 WHERE SE_match = 'NOT MATCH' AND score BETWEEN 0.0 AND 1.0
        ORDER BY score DESC, FeedbackID"""),
    "h28_score_distribution": pq_("""SELECT HumanFeedback, round(floor(cosine / 0.1) * 0.1, 6) AS bin,
        count(*) AS n FROM pcos GROUP BY ALL"""),
})


# ---- reports ---------------------------------------------------------------------------
def _wd_name(c):
    return ("CASE isodow(" + c + ") " + " ".join(
        f"WHEN {i + 1} THEN '{d}'" for i, d in enumerate(["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]))
        + " END")


_REPORT_VIEWS = {
    "eng_pay": f"""SELECT e.*, p.gapday, p.firstpay, p.firstPayment, p.gapday IS NOT NULL AS payer,
        {_wd_name('e.EventDate')} AS Event_dayofweek
        FROM engagement e LEFT JOIN payment_x p ON p.UserID = e.UserID""",
    "recoded": """SELECT *, CASE WHEN FeedbackResult IN ('NOT_MATCH', 'SKIP') THEN 'NOT MATCH'
        ELSE FeedbackResult END AS result FROM feedback_pairs""",
    "hd_first": """SELECT UserID, min(nth_day_from_registration) AS min_day, min(firstuse) AS firstuse
        FROM eng_raw_x GROUP BY UserID""",
    "hd_cases": """SELECT f.UserID, CASE WHEN min_day = 0 AND gapday = 0 THEN 'zero_instant'
          WHEN min_day > 0 AND gapday <> 0 THEN 'late_late'
          WHEN min_day > 0 AND gapday = 0 THEN 'late_instant' END AS "case",
        p.firstPayment, f.firstuse > p.firstpay AS use_first,
        round(abs(epoch_us(p.firstpay) - epoch_us(f.firstuse)) / 3.6e9, 6) AS gap_hour
        FROM hd_first f JOIN (SELECT * FROM pay_x2 WHERE gapday IS NOT NULL) p ON p.UserID = f.UserID""",
}


def rq(body: str) -> str:
    extra = dict(EXTRA_VIEWS)
    extra["pay"] = _PAY
    extra.update(_features_views((1,)))
    extra.update(_cutoff_views())
    extra.update(_REPORT_VIEWS)
    return with_views(body, extra)


def _pct_sql():
    return """SELECT result AS FeedbackResult, HumanFeedback,
        floor(n / sum(n) OVER (PARTITION BY result) * 10000.0 + 0.5) / 10000.0 * 100 AS pct
        FROM (SELECT result, HumanFeedback, count(*) AS n FROM recoded GROUP BY ALL)"""


def _multi_stat():
    cols = []
    for a in ["Discovery", "Entertainment", "Learn"]:
        m = f"CASE WHEN ActionType = '{a}' THEN UsageTime END"
        cols += [f"count({m}) AS count_{a}", f"avg({m}) AS mean_{a}", f"sum({m}) AS sum_{a}",
                 f"stddev_samp({m}) AS std_{a}"]
    return f"SELECT nth_day_from_registration, {', '.join(cols)} FROM eng_pay WHERE payer GROUP BY 1"


def _profile():
    parts = []
    for c in ["UsageTime", "Records", "open_time", "payment_screen_time"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS "column", CAST(count({x}) AS DOUBLE) AS count,
            CAST(count(*) FILTER (WHERE {x} IS NULL) AS DOUBLE) AS nulls, avg({x}) AS mean,
            stddev_samp({x}) AS std, min({x}) AS min, quantile_cont({x}, 0.25) AS q1,
            quantile_cont({x}, 0.5) AS q2, quantile_cont({x}, 0.75) AS q3, max({x}) AS max FROM engagement""")
    return " UNION ALL ".join(parts)


def _corr():
    cs = ["UsageTime", "Records", "open_time", "payment_screen_time"]
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM engagement"
             for i, a in enumerate(cs) for b in cs[i:]]
    return " UNION ALL ".join(parts)


_BRANDS7 = ["samsung", "oppo", "apple", "xiaomi", "vivo", "realme", "nokia"]

ORACLE.update({
    "d18_value_counts": rq("""SELECT DeviceBrand, count(*) AS count FROM engagement GROUP BY 1
        ORDER BY count DESC, DeviceBrand"""),
    "d19_crosstab_pct": rq(_pct_sql()),
    "d20_multi_stat_pivot": rq(_multi_stat()),
    "d21_weekday_action_payer": rq("""SELECT Event_dayofweek, ActionType, payer, count(*) AS events,
        avg(UsageTime) AS mean_usage FROM eng_pay GROUP BY ALL"""),
    "d22_weekday_counts": rq(f"""SELECT COALESCE(a.weekday, b.weekday, c.weekday) AS weekday,
        pay_dayofweek, joined_dayofweek, Event_dayofweek FROM
        (SELECT {_wd_name("CAST(UserJoinedDate AS DATE) + CAST(ceil(gapday) AS INTEGER)")} AS weekday,
                count(*) AS pay_dayofweek FROM eng_pay WHERE payer GROUP BY 1) a
        FULL JOIN (SELECT {_wd_name('UserJoinedDate')} AS weekday, count(*) AS joined_dayofweek
                   FROM eng_pay WHERE payer GROUP BY 1) b ON a.weekday = b.weekday
        FULL JOIN (SELECT Event_dayofweek AS weekday, count(*) AS Event_dayofweek FROM eng_pay
                   WHERE payer GROUP BY 1) c ON c.weekday = COALESCE(a.weekday, b.weekday)"""),
    "d23_box_stats": rq("""SELECT Event_dayofweek, payer, min(UsageTime) AS min,
        quantile_cont(UsageTime, 0.25) AS q1, quantile_cont(UsageTime, 0.5) AS median,
        quantile_cont(UsageTime, 0.75) AS q3, max(UsageTime) AS max FROM eng_pay GROUP BY ALL"""),
    "d24_column_profile": rq(_profile()),
    "d25_correlation": rq(_corr()),
    "d26_histogram": rq("""SELECT payer, floor(UsageTime / 5.0) * 5.0 AS bin, count(*) AS n
        FROM eng_pay GROUP BY ALL"""),
    "d27_daily_counts": rq("SELECT EventDate, count(*) AS n FROM engagement GROUP BY 1"),
    "c08_hour_diff_cases": rq('SELECT * FROM hd_cases WHERE "case" IS NOT NULL'),
    "d28_use_first_counts": rq("""SELECT "case", firstPayment, use_first, count(*) AS n FROM hd_cases
        WHERE "case" IS NOT NULL GROUP BY ALL"""),
    "d29_brand_matrix": rq("SELECT UserID, " + ", ".join(
        f"CAST(count(*) FILTER (WHERE DeviceBrand = '{b}') AS BIGINT) AS {b}" for b in _BRANDS7)
        + ", CAST(count(DISTINCT DeviceBrand) AS BIGINT) AS n_brands FROM event_logs_all GROUP BY UserID"),
    "d30_first_row": rq("""SELECT UserID, UserJoinedDate, EventDate, ActionType FROM (SELECT *,
        row_number() OVER (PARTITION BY UserID ORDER BY EventDate, ActionType) AS rn FROM engagement)
        WHERE rn = 1"""),
    "d32_duplicate_audit": rq("""SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT user_id,
        event_type FROM events)) AS distinct_rows,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS duplicate_rows
        FROM events"""),
    "c07_learning_fanout": rq("""SELECT e.UserID, e.EventDate, e.nth_day_from_registration, e.ActionType,
        e.UsageTime AS eng_usage, l.SubjectName, l.IsCompleted, l.UsageTime AS learn_usage
        FROM engagement e LEFT JOIN learn l ON l.UserID = e.UserID AND l.EventDate = e.EventDate
        AND l.nth_day_from_registration = e.nth_day_from_registration"""),
    "c09_not_match_in_match": rq("""SELECT FeedbackID FROM feedback_pairs WHERE HumanFeedback = 'NOT MATCH'
        AND LookupText IN (SELECT LookupText FROM feedback_pairs WHERE HumanFeedback = 'MATCH')"""),
    "c10_label_disagreements": rq("""SELECT a.UserID, a.Label AS Label_a, b.Label AS Label_b
        FROM cutoff_features a LEFT JOIN features b ON b.UserID = a.UserID
        WHERE a.Label IS DISTINCT FROM b.Label"""),
    "f06_min_max_scale": rq("""SELECT UserID, EventDate, ActionType, UsageTime,
        round((UsageTime - (SELECT min(UsageTime) FROM engagement))
              / ((SELECT max(UsageTime) FROM engagement) - (SELECT min(UsageTime) FROM engagement)), 10)
          AS UsageScaled FROM engagement"""),
    "f08_word_diff_bins": rq(f"""SELECT FeedbackID, d AS diff_word, CASE WHEN d <= 5 THEN 'Very low'
        WHEN d <= 10 THEN 'Low' WHEN d <= 15 THEN 'Medium' WHEN d <= 20 THEN 'High' ELSE 'Very high' END
          AS diff_bin FROM (SELECT FeedbackID,
          abs({x_n_words('QuestionText')} - {x_n_words('LookupText')}) AS d FROM feedback_pairs)"""),
    "f09_top_brands": rq("""SELECT TopBrand, count(*) AS count FROM (SELECT CASE WHEN b.cnt >= 120
        THEN u.DeviceBrand ELSE 'Others' END AS TopBrand FROM ucb u LEFT JOIN (SELECT DeviceBrand,
        count(*) AS cnt FROM ucb WHERE DeviceBrand IS NOT NULL GROUP BY 1) b ON b.DeviceBrand = u.DeviceBrand)
        GROUP BY 1 ORDER BY count DESC, TopBrand"""),
    "b05_parse_ts19": rq("SELECT event_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed FROM events"),
    "b06_b07_calendar_parts": rq(f"""SELECT UserID, EventDate, ActionType,
        CAST(hour(firstuse) AS INTEGER) AS firstuse_hour, CAST(hour(lastuse) AS INTEGER) AS lastuse_hour,
        CAST(day(lastuse) AS INTEGER) AS lastuse_day, CAST(isodow(lastuse) - 1 AS INTEGER) AS lastuse_dayofweek,
        CAST(month(UserJoinedDate) AS INTEGER) AS JoinMonth, {_wd_name('EventDate')} AS Event_dayofweek
        FROM engagement"""),
    "b08_b09_child_age": rq(f"""SELECT ChildID, {AGE_SQL} AS Age, CAST(month(ChildBday) AS INTEGER) AS monthBday,
        round(datediff('day', ChildBday, DATE '2024-02-01') / 365.0, 1) AS age_365 FROM child_profile"""),
    "b10_pay_date": rq("""SELECT UserID, CAST(CAST(UserJoinedDate AS DATE) + CAST(ceil(gapday) AS INTEGER) AS DATE)
        AS payday FROM payment_x WHERE gapday IS NOT NULL"""),
    "b13_label_recode": rq("SELECT result, count(*) AS n FROM recoded GROUP BY 1"),
    "j02_global_top_users": rq("""SELECT UserID, round(sum(UsageTime), 6) AS usage FROM engagement
        GROUP BY 1 ORDER BY usage DESC, UserID LIMIT 10"""),
    "j03_set_operations": rq("""SELECT UserID FROM user_profile WHERE UserID NOT IN
        (SELECT UserID FROM payment_x WHERE gapday IS NULL) UNION SELECT UserID FROM fake_users"""),
})


# ---- models ---------------------------------------------------------------------------
_ML_VIEWS = {
    "ml": """SELECT UserID, firstPaymentType, Label,
        CAST(TotalUsageTime AS DOUBLE) AS TotalUsageTime,
        CAST(PaymentScreenFrequent AS DOUBLE) AS PaymentScreenFrequent FROM features""",
    "rs": """SELECT UserID, firstPaymentType, Label, TotalUsageTime / (TotalUsageTime + 60.0) AS score,
        CAST(TotalUsageTime / (TotalUsageTime + 60.0) >= 0.5 AS INTEGER) AS prediction FROM ml""",
    "rs_b": """SELECT UserID, Label, PaymentScreenFrequent / (PaymentScreenFrequent + 3.0) AS score FROM ml""",
    "sc": """SELECT score, count(*) FILTER (WHERE Label = 1) AS pos, count(*) FILTER (WHERE Label = 0) AS neg
        FROM rs GROUP BY score""",
    "sc_cum": """SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM sc
        WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "pn": """SELECT count(*) FILTER (WHERE Label = 1) AS P, count(*) FILTER (WHERE Label = 0) AS N FROM rs""",
}


def _conf(by: str = "") -> str:
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""SELECT {g}tp, fp, tn, fn, (tp + tn) / (tp + fp + tn + fn) AS accuracy,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
        CASE WHEN (CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END)
                + (CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END) = 0 THEN 0.0
             ELSE 2 * (CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END)
                    * (CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END)
                    / ((CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END)
                       + (CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END)) END AS f1,
        ((CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END)
          + (CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END)) / 2 AS auc_hard
        FROM (SELECT {g}count(*) FILTER (WHERE Label = 1 AND prediction = 1) AS tp,
          count(*) FILTER (WHERE Label = 0 AND prediction = 1) AS fp,
          count(*) FILTER (WHERE Label = 0 AND prediction = 0) AS tn,
          count(*) FILTER (WHERE Label = 1 AND prediction = 0) AS fn
          FROM (SELECT *, COALESCE(firstPaymentType, 'Nan') AS segment FROM rs) {grp})"""


def mq(body: str) -> str:
    extra = dict(EXTRA_VIEWS)
    extra["pay"] = _PAY
    extra.update(_features_views((1,)))
    extra.update(_ML_VIEWS)
    return with_views(body, extra)


def _weights() -> str:
    base = "SELECT Label, count(*) AS n_c FROM ml GROUP BY Label"
    exprs = {"balanced": "(SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c)",
             "inverse": "1.0 / n_c", "isns": "1.0 / sqrt(n_c)",
             "ens": "(1.0 - 0.99999) / (1.0 - pow(0.99999, n_c))"}
    parts = [f"SELECT '{m}' AS method, Label, round({e}, 10) AS weight FROM c" for m, e in exprs.items()]
    return f"SELECT * FROM (WITH c AS ({base}) " + " UNION ALL ".join(parts) + ")"


ORACLE.update({
    "i01_stratified_split": mq("""SELECT UserID, Label,
        CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
          SELECT UserID, Label, count(*) OVER (PARTITION BY Label) AS n,
            row_number() OVER (PARTITION BY Label ORDER BY md5('42:' || CAST(UserID AS VARCHAR)), UserID) AS k
          FROM ml)"""),
    "i04_undersample": mq("""SELECT UserID, Label FROM (
          SELECT UserID, Label,
            row_number() OVER (PARTITION BY Label ORDER BY md5('42:' || CAST(UserID AS VARCHAR)), UserID) AS k
          FROM ml) WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM ml GROUP BY Label))"""),
    "i05_smote_balance": mq("""SELECT Label, max(count(*)) OVER () AS "rows", count(*) AS original,
        max(count(*)) OVER () AS distinct_keys FROM ml GROUP BY Label"""),
    "i02_class_weights": mq(_weights()),
    "i03_imbalance_ratio": mq("""SELECT count(*) FILTER (WHERE Label = 0) / count(*) FILTER (WHERE Label = 1)
        AS scale_pos_weight FROM ml"""),
    "i13_confusion_metrics": mq(_conf()),
    "i16_metrics_by_payment_type": mq(_conf("segment")),
    "i14_roc_points": mq("""SELECT score AS threshold, cum_pos / greatest((SELECT P FROM pn), 1) AS tpr,
        cum_neg / greatest((SELECT N FROM pn), 1) AS fpr FROM sc_cum"""),
    "i14_auc": mq("""SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / (sum(pos) * sum(neg)), 10) AS auc
        FROM sc_cum"""),
    "i15_pr_curve": mq("""SELECT score AS threshold, cum_pos / (cum_pos + cum_neg) AS precision,
        cum_pos / (SELECT P FROM pn) AS recall, pos / (SELECT P FROM pn) AS recall_step FROM sc_cum"""),
    "i15_average_precision": mq("""SELECT round(sum(pos / (SELECT P FROM pn) * cum_pos / (cum_pos + cum_neg)), 10)
        AS average_precision FROM sc_cum"""),
    "i18_probability_blend": mq("""SELECT a.UserID, a.Label, round(0.8 * a.score + 0.2 * b.score, 10) AS score,
        CAST(0.8 * a.score + 0.2 * b.score >= 0.5 AS INTEGER) AS prediction
        FROM rs a JOIN rs_b b ON b.UserID = a.UserID"""),
    "f07_robust_scaled": mq("""SELECT * FROM (WITH cells AS (
        SELECT * FROM (SELECT UserID, CAST(COLUMNS(* EXCLUDE (UserID, Label, firstPaymentType, gapday,
                              ScaleGapday, horizon)) AS DOUBLE) FROM features)
        UNPIVOT INCLUDE NULLS (x FOR feature IN (COLUMNS(* EXCLUDE (UserID))))),
        mid AS (SELECT feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2,
                       quantile_cont(x, 0.75) AS q3 FROM cells GROUP BY feature)
        SELECT UserID, feature, round((x - q2) / CASE WHEN q3 - q1 = 0 THEN 1.0 ELSE q3 - q1 END, 10) AS scaled
        FROM cells JOIN mid USING (feature))"""),
    "i18_score_medians": mq("""SELECT which, round(quantile_cont(x, 0.5), 10) AS median FROM (
        SELECT unnest(['a', 'b', 'blend']) AS which,
               unnest([a.score, b.score, 0.8 * a.score + 0.2 * b.score]) AS x
        FROM rs a JOIN rs_b b ON b.UserID = a.UserID) GROUP BY which"""),
})

ORACLE["d02_streaming_daily_event_log"] = ORACLE["d02_daily_event_log"]


_LOG_COLS = (["TotalUsageTime", "TotalRecords"] + LEARN_COLS
             + ["RecordDiscovery", "RecordEntertainment", "RecordLearn", "UsageTimeDiscovery",
                "UsageTimeEntertainment", "UsageTimeLearn", "MedianUsageTime", "MedianRecord",
                "MedianPaymentScreen", "AvgTimePerCompletion", "InteractionGeneral", "InteractionLearn",
                "InteractionDiscovery", "InteractionEntertainment", "MedianInteraction"])

ORACLE["f05_log_features"] = fq("SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN (SELECT min({c}) FROM features) = 0 THEN ln({c} + 1) ELSE ln({c}) END AS {c}"
    for c in _LOG_COLS) + ") FROM features", (1,))


def _compounds() -> str:
    tokens = _split_words(_clean_full("text"))
    return f"""
WITH t AS (
  SELECT 'documents' AS source, doc_id AS id, {tokens} AS tk FROM documents
  UNION ALL SELECT 'benchmark', item_id, {tokens} FROM benchmark),
w AS (
  SELECT source, id, pos, tk[pos] AS a, tk[pos + 1] AS b
  FROM (SELECT source, id, tk, unnest(range(1, len(tk) + 1)) AS pos FROM t)),
pairs AS (
  SELECT a, b, count(*) AS n FROM w WHERE source = 'documents' AND b IS NOT NULL GROUP BY a, b),
lexicon AS (SELECT a, b FROM pairs WHERE n >= greatest(2, (SELECT sum(n) FROM pairs) * 0.0001)),
hits AS (
  SELECT source, id, pos, pos - row_number() OVER (PARTITION BY source, id ORDER BY pos) AS run
  FROM w SEMI JOIN lexicon USING (a, b)),
starts AS (
  SELECT source, id, pos FROM (
    SELECT *, min(pos) OVER (PARTITION BY source, id, run) AS first FROM hits) WHERE (pos - first) % 2 = 0),
merged AS (
  SELECT w.source, w.id, w.pos, CASE WHEN s.pos IS NULL THEN w.a ELSE w.a || '_' || w.b END AS token
  FROM w LEFT JOIN starts s ON s.source = w.source AND s.id = w.id AND s.pos = w.pos
  WHERE NOT EXISTS (SELECT 1 FROM starts p
                    WHERE p.source = w.source AND p.id = w.id AND p.pos + 1 = w.pos))
SELECT t.source, t.id, coalesce(string_agg(m.token, ' ' ORDER BY m.pos), '') AS tokens,
       count(m.token) AS n_tokens
FROM t LEFT JOIN merged m ON m.source = t.source AND m.id = t.id GROUP BY t.source, t.id"""


ORACLE["g05_compound_merge"] = _compounds()

_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(
  range(1, length(CAST({c} AS VARCHAR)) + 1), lambda i: ascii(substr(CAST({c} AS VARCHAR), i, 1))::BIGINT)),
  lambda a, x: list_reduce(list_concat([xor(a, x)], range(8)),
                           lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))))"""
ORACLE["a07_annotation_recode"] = tq(f"""SELECT FeedbackID,
  CASE WHEN {_CRC32.format(c='FeedbackID')} % 4 < 2 THEN 'in' ELSE 'not in' END AS lookup_in_question
  FROM feedback_pairs""")

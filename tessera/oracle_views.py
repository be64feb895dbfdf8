"""DuckDB SQL for the logical views of ``tessera.sources.views``.

Used only to cross-check the Spark plans: ``with_views(body)`` prefixes a
query with the CTEs it references (dependencies resolved automatically).
"""

from __future__ import annotations

import re

from tessera.sources import views as V

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"


def _case(expr: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


_BRAND = _case(f"(user_id + {K} % 3) % {len(V.BRANDS)}", V.BRANDS)
_EVENT_CODE = ("CASE " + " ".join(f"WHEN event_type = '{e}' THEN '{c}'"
                                  for e, c in V.EVENT_CODES.items()) + " ELSE 'other' END")
_ACTION = ("CASE " + " ".join(f"WHEN event_type = '{e}' THEN '{a}'"
                              for e, a in V.ACTION_TYPES.items()) + " ELSE 'Entertainment' END")
_ARCH = f"TIMESTAMP '{V.ARCHIVE_BEFORE}'"


def _line_pick(text: str, key: str) -> str:
    parts = f"string_split({text}, chr(10))"
    return f"{parts}[CAST({key} % len({parts}) + 1 AS INTEGER)]"


VIEW_SQL: dict[str, str] = {
    "user_profile": f"""SELECT DISTINCT user_id AS UserID,
        CAST(DATE '{V.JOIN_BASE_DATE}' - CAST(user_id % 3 AS INTEGER) AS TIMESTAMP) AS UserJoinedDate
        FROM events""",
    "fake_users": f"""SELECT DISTINCT user_id AS UserID FROM events
        WHERE user_id % {V.FAKE_MOD} = {V.FAKE_REM}""",
    "child_profile": f"""SELECT UserID, ChildID,
        DATE '{V.CHILD_BDAY_BASE}' + CAST(ChildID * 97 % 2000 AS INTEGER) AS ChildBday,
        CASE WHEN ChildID % 2 = 0 THEN 'female' ELSE 'male' END AS ChildGender
        FROM (SELECT u.UserID, u.UserID * 10 + v.i AS ChildID FROM user_profile u
              JOIN (VALUES (1), (2), (3)) v(i) ON v.i <= u.UserID % 3 + 1)""",
    "subscription_plan_profile": """SELECT CAST(p AS INTEGER) AS PlanID,
        CAST(p = 1 AS INTEGER) AS PlanIsTrial FROM range(5) r(p)""",
    "user_subscription_records": f"""SELECT event_id AS TransactionID, user_id AS UserID,
        ts AS CreatedAt, value AS FinalValue, 'purchase' AS TransactionType,
        CASE WHEN {K} < 5 THEN 'succeed' ELSE 'failed' END AS TransactionStatus,
        CASE WHEN {K} = 3 THEN event_id END AS RefundTransactionID,
        {K} % 5 AS PlanID,
        {_case('user_id % 4', V.PAYMENT_TYPES)} AS PaymentType
        FROM events WHERE event_type = 'purchase'""",
    "user_event_logs": f"""SELECT user_id AS UserID, ts AS EventTime, {_EVENT_CODE} AS EventCode,
        {_BRAND} AS DeviceBrand, {_BRAND} || '-' || CAST({K} % 2 AS VARCHAR) AS DeviceModel
        FROM events WHERE ts >= {_ARCH}""",
    "user_event_logs_arXiv": f"""SELECT user_id AS UserID, ts AS EventTime, {_EVENT_CODE} AS EventCode,
        {_BRAND} AS DeviceBrand, {_BRAND} || '-' || CAST({K} % 2 AS VARCHAR) AS DeviceModel
        FROM events WHERE ts < {_ARCH}""",
    "view_child_usage_records": f"""SELECT user_id AS UserID, ts AS EventTime, {_ACTION} AS ActionType,
        value * 10 AS UsageTime, {K} AS ActivityID, {K} % 2 AS IsCompleted
        FROM events WHERE event_type <> 'purchase' AND ts >= {_ARCH}""",
    "view_child_usage_records_arXiv": f"""SELECT user_id AS UserID, ts AS EventTime, {_ACTION} AS ActionType,
        value * 10 AS UsageTime, {K} AS ActivityID, {K} % 2 AS IsCompleted
        FROM events WHERE event_type <> 'purchase' AND ts < {_ARCH}""",
    "activity_profile": f"""SELECT CAST(a AS INTEGER) AS ActivityID,
        {_case('a % 4', V.SUBJECTS)} AS SubjectName FROM range({V.N_ACTIVITIES}) r(a)""",
    "demographics": f"""SELECT UserID, CAST(count(DISTINCT ChildID) AS BIGINT) AS TotalChild,
        median(CAST(floor((datediff('month', ChildBday, DATE '{V.AS_OF_DATE}')
               - CASE WHEN day(DATE '{V.AS_OF_DATE}') < day(ChildBday) THEN 1 ELSE 0 END) / 12) AS BIGINT))
          AS MedianChildAge,
        CAST(count(*) FILTER (WHERE ChildGender = 'female') AS BIGINT) AS NoFemale,
        CAST(count(*) FILTER (WHERE ChildGender = 'male') AS BIGINT) AS NoMale
        FROM child_profile WHERE UserID % {V.DEMOGRAPHICS_GAP_MOD} <> 0 GROUP BY UserID""",
    "event_logs_all": "SELECT * FROM user_event_logs UNION ALL SELECT * FROM user_event_logs_arXiv",
    "usage_records_all": """SELECT * FROM view_child_usage_records
        UNION ALL SELECT * FROM view_child_usage_records_arXiv""",
    "feedback_pairs": f"""SELECT FeedbackID, LookupText, QuestionText, FeedbackType, FeedbackResult,
        HumanFeedback FROM (
        SELECT l.doc_id AS FeedbackID,
          CASE WHEN l.quality = 1 THEN {_line_pick('d.text', 'l.doc_id')}
               ELSE {_line_pick('n.text', 'l.doc_id')} END AS LookupText,
          d.text AS QuestionText,
          CASE WHEN l.toxic = 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS FeedbackType,
          CASE l.doc_id % 3 WHEN 0 THEN 'MATCH' WHEN 1 THEN 'NOT_MATCH' ELSE 'SKIP' END AS FeedbackResult,
          CASE WHEN l.quality = 1 THEN 'MATCH' ELSE 'NOT MATCH' END AS HumanFeedback
        FROM labels l JOIN formula_documents d ON d.doc_id = l.doc_id
        LEFT JOIN formula_documents n ON n.doc_id = l.doc_id + 1) WHERE LookupText IS NOT NULL""",
    "formula_documents": """SELECT doc_id, CASE WHEN doc_id % 3 = 0
        THEN text || ' \\( x^2 + ' || CAST(doc_id AS VARCHAR) || ' = 0 \\)' ELSE text END AS text
        FROM documents""",
}

# Cohort filter, the same window as the Spark plans.
COHORT_WHERE = (f"UserJoinedDate >= TIMESTAMP '{V.COHORT_START}' AND "
                f"UserJoinedDate < DATE '{V.COHORT_END}' + INTERVAL 1 DAY")


def _deps(sql: str) -> list[str]:
    return [n for n in VIEW_SQL if re.search(rf"\b{n}\b", sql)]


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the needed views (topologically ordered) + ``body``."""
    defs = dict(VIEW_SQL)
    defs.update(extra or {})
    order: list[str] = []

    def visit(name: str, stack: tuple = ()) -> None:
        if name in order or name in stack:
            return
        for dep in [n for n in defs if n != name and re.search(rf"\b{n}\b", defs[name])]:
            visit(dep, stack + (name,))
        order.append(name)

    for name in [n for n in defs if re.search(rf"\b{n}\b", body)]:
        visit(name)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in order)
    return f"WITH {ctes}\n{body}"

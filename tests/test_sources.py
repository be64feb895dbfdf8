"""Sources and sinks (survey 2A) on data derived from the driver tables."""

import os
import uuid

from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources import tables as TB
from tests.conftest import SF_SMALL


def _scratch(spark, name):
    return scratch_path(spark, f"tests/{name}-{uuid.uuid4().hex[:8]}")


def test_csv_scan_with_schema_and_positional_rename(spark):
    t = TB.Tables(spark, SF_SMALL)
    path = _scratch(spark, "csv")
    t.events.select("event_id", "user_id", "event_type").write.option("header", False).csv(path)
    df = TB.read_csv(spark, path, "a long, b long, c string", header=False)
    named = TB.rename_positional(df, ["event_id", "user_id", "event_type"])
    assert named.columns == ["event_id", "user_id", "event_type"]
    assert named.count() == t.events.count()


def test_run_extracts_and_write_by_horizon(spark):
    from tessera.plans import extracts as X
    from tessera.plans import feature_tables as FT

    t = TB.Tables(spark, SF_SMALL)
    out = _scratch(spark, "extracts")
    written = TB.run_extracts({"Payment": X.payment_extract(t)}, out)
    assert spark.read.parquet(written["Payment"]).count() == X.payment_extract(t).count()
    hp = _scratch(spark, "horizons")
    TB.write_by_horizon(FT.active_days_features(t, [1, 2]), hp)
    assert sorted(os.listdir(hp)).count("horizon=1") == 1
    assert spark.read.parquet(hp).filter("horizon = 2").count() > 0


def test_stop_words_union(spark):
    path = _scratch(spark, "stop")
    spark.createDataFrame([("thì_là",), ("the",)], "value string").write.text(path)
    sw = TB.load_stop_words(spark, path)
    words = {r.word for r in sw.collect()}
    assert "thì_là" in words and "the" in words
    assert sw.count() == len(words)


def test_annotation_recode(spark):
    fb = spark.createDataFrame([(1,), (2,), (3,), (4,)], "FeedbackID int")
    ann = spark.createDataFrame([(1, "x"), (2, "v"), (3, "0")], "FeedbackID int, lookup_in_question string")
    rec = TB.annotation_recode(fb, ann)
    got = {r.FeedbackID: r.lookup_in_question for r in rec.collect()}
    assert got == {1: "in", 2: "in", 3: "not in", 4: "not in"}
    counts = {r.lookup_in_question: r.n for r in TB.annotation_counts(rec).collect()}
    assert counts == {"in": 2, "not in": 2}


def test_live_archive_union_keeps_duplicates(spark):
    a = spark.range(3)
    assert TB.union_live_archive(a, a).count() == 6


def test_spread_only_when_few_partitions(spark):
    df = spark.range(100).repartition(50)
    assert TB.spread(df, "id").rdd.getNumPartitions() == 50
    one = spark.range(100).coalesce(1)
    assert TB.spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_feedback_pairs_join_a_line_of_the_next_document(spark):
    """The next document's whole text used to be shuffled for one line of it."""
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from tessera.sources import views as V

    docs = [(i, f"a{i}\nb{i}\nc{i}") for i in range(8)] + [(3, "x3\ny3"), (4, "x4"), (None, "n\nn"), (6, None)]
    labels = [(i, i % 2, 0) for i in range(9)] + [(2, 0, 1), (3, 1, 1), (None, 0, 0), (5, None, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    t = SimpleNamespace(documents=d, labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = V.feedback_pairs(t)
    full = {}
    for i, text in docs:
        if i is not None and text is not None and i % 3 == 0:
            text += f" \\( x^2 + {i} = 0 \\)"
        full.setdefault(i, []).append(text)
    line = lambda i, text: text and text.split("\n")[i % len(text.split("\n"))]
    want = []
    for i, quality, toxic in labels:
        for text in full.get(i, []) if i is not None else []:
            for after in full.get(i + 1) or [None]:
                lookup = line(i, text) if quality == 1 else line(i, after)
                if lookup is not None:
                    want.append((i, lookup, text))
    rows = [(r.FeedbackID, r.LookupText, r.QuestionText) for r in got.collect()]
    key = lambda r: (r[0], r[1], r[2] or "")
    assert sorted(rows, key=key) == sorted(want, key=key) and len(rows) > 10
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join"):]
    assert "next_line" in joins and "AS next_text" not in joins.split("next_line")[0]
    assert got.filter(F.col("FeedbackID").isNull()).isEmpty()

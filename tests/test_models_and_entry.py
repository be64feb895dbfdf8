"""Model metrics against brute force, invariants of the sampling
operators, and the driver contract on the smallest data set."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import models as M
from tests.conftest import SF_SMALL


def _scored(spark):
    rows = [(i, y, s) for i, (y, s) in enumerate(
        [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.3), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.95)])]
    return spark.createDataFrame(rows, "id int, Label int, score double"), rows


def test_auc_matches_pairwise_definition(spark):
    df, rows = _scored(spark)
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert M.auc(df.repartition(3)).first()["auc"] == pytest.approx(want)


def test_cumulative_desc_matches_python(spark):
    df = spark.createDataFrame([(float(i), i % 3) for i in range(50)], "s double, v int")
    got = {r.s: r.cum_v for r in M.cumulative_desc(df.repartition(5), "s", ["v"]).collect()}
    running, want = 0, {}
    for i in reversed(range(50)):
        running += i % 3
        want[float(i)] = running
    assert got == want


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(40).withColumnRenamed("id", "k")
    r = M.global_row_number(df.repartition(4), F.xxhash64("k"))
    assert sorted(x._r for x in r.collect()) == list(range(1, 41))


def test_confusion_metrics(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1)], "Label int, prediction int")
    r = M.confusion_metrics(df).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 1, 1, 1)
    assert r.precision == pytest.approx(2 / 3) and r.recall == pytest.approx(2 / 3)


def test_split_is_deterministic_and_disjoint(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("Label"))
    tr, te = M.stratified_split(df, "k")
    a, b = {r.k for r in tr.collect()}, {r.k for r in te.collect()}
    assert not a & b and len(a | b) == 500
    tr2, te2 = M.stratified_split(df, "k")
    assert {r.k for r in te2.collect()} == b
    share_pos = te.filter("Label = 1").count() / df.filter("Label = 1").count()
    assert 0.1 < share_pos < 0.3


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "Label int")
    w = {r.Label: r.weight for r in M.class_weights(df).collect()}
    assert w[1] == pytest.approx(8 / (2 * 2)) and w[0] == pytest.approx(8 / (2 * 6))


def test_entry_runs_on_smallest_data(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    rows = df.collect()
    assert "Label" in df.columns and len(rows) > 50
    assert len({(r.horizon, r.UserID) for r in rows}) == len(rows)


def test_every_registered_query_has_unique_name_and_oracle_keys_exist():
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100


@pytest.mark.parametrize("name", ["d01_payment_extract", "e15_active_days_features",
                                  "h05_cosine_top5", "g13_g16_formula_split"])
def test_oracle_matches_on_smallest_data(spark, name):
    import duckdb

    import __spark_entry__ as entry
    from tessera.sources.tables import DRIVER_TABLES
    from tools.oracle_check import _rows

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    got = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    assert got == want


def test_smote_balances_inside_the_hull(spark):
    rows = [(i, float(i % 5), float(i % 7), 1 if i < 6 else 0) for i in range(25)]
    df = spark.createDataFrame(rows, "k int, a double, b double, Label int")
    out = M.smote(df, ["a", "b"], "k")
    syn = out.filter(F.col("k").startswith("syn_")).collect()
    assert len(syn) == 13 and all(r.Label == 1 for r in syn)
    assert len({r.k for r in syn}) == 13
    lo_a, hi_a = min(r[1] for r in rows if r[3] == 1), max(r[1] for r in rows if r[3] == 1)
    assert all(lo_a <= r.a <= hi_a for r in syn)


def test_ranks_over_many_wide_rows_without_exchange_reuse(spark):
    """Every consumer of a rank must see the same ranges."""
    import numpy as np

    n = 120_000
    wide = spark.range(n).select(
        F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(60_000)) / 60_000.0).alias("score"),
        F.repeat(F.lit("x"), 60).alias("pad"))
    wide = wide.withColumn("Label", (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000.0
                                     < F.col("score")).cast("int"))
    was = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        rows = wide.select("score", "Label").toPandas()
        pos, neg = (np.sort(rows.score[rows.Label == y]) for y in (1, 0))
        below = np.searchsorted(neg, pos, "left") + np.searchsorted(neg, pos, "right")
        want = below.sum() / 2 / (len(pos) * len(neg))
        assert M.auc(wide).first()["auc"] == pytest.approx(want, abs=1e-12)
        ranked = M.global_row_number(wide, F.struct("score", "id"))
        got = ranked.agg(F.countDistinct("_r"), F.min("_r"), F.max("_r"), F.count("*")).first()
        assert tuple(got) == (n, 1, n, n)
        swap = M.global_row_number(wide.select("id"), F.xxhash64("id")).select("_r", F.col("id").alias("o"))
        assert ranked.join(swap, "_r").count() == n
    finally:
        spark.conf.set("spark.sql.exchange.reuse", was)


def test_split_and_undersampling_are_exact(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("Label"))
    _, te = M.stratified_split(df, "k")
    assert {r.Label: r["count"] for r in te.groupBy("Label").count().collect()} == {0: 180, 1: 20}
    few = M.undersample(df, "k").groupBy("Label").count().collect()
    assert {r.Label: r["count"] for r in few} == {0: 100, 1: 100}


def test_grid_search_assembles_once_and_finds_the_same(spark):
    """fits get ready vectors and keep row nodes; the metrics are those of
    a plain pipeline in the cross-validation."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    df = spark.range(240).select(
        (F.pmod(F.xxhash64("id"), F.lit(97)) / 97.0).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(89)) / 89.0).alias("b"))
    df = df.withColumn("Label", (F.col("a") * F.col("b") > 0.2).cast("int")).coalesce(1)
    grid = {"numTrees": [3], "maxDepth": [2, 6]}
    found = M.grid_search(df, ["a", "b"], "forest", grid, folds=2)

    est = M.classifier("forest", seed=42)
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    plain = CrossValidator(
        estimator=Pipeline(stages=[M.assembler(["a", "b"]), est]), estimatorParamMaps=b.build(),
        evaluator=MulticlassClassificationEvaluator(labelCol="Label", metricName="f1"),
        numFolds=2, seed=42).fit(df)
    assert found.avgMetrics == pytest.approx(plain.avgMetrics, abs=1e-12)
    got, want = (m.bestModel.transform(df).select("prediction").collect() for m in (found, plain))
    assert got == want

    inner = found.getEstimator()
    assert isinstance(inner, RandomForestClassifier) and inner.getCacheNodeIds()


def test_metric_table_computes_its_table_once(spark):
    """the table given is computed once, whatever the horizons; rows of
    metrics are those of single fits on the exact splits."""
    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return float(v)

    base = spark.range(400).select(
        (F.col("id") % 2 + 1).cast("int").alias("horizon"), F.col("id").alias("k"),
        (F.pmod(F.xxhash64("id"), F.lit(97)) / 97.0).alias("a"))
    base = base.withColumn("Label", (F.col("a") + (F.col("k") % 5) / 10 > 0.7).cast("int")).coalesce(1)
    table = base.withColumn("b", F.udf(counted, "double")(F.col("k") % 5))
    got = M.metric_table(table, [1, 2], ["a", "b"], "k", ["isns"], kind="tree").collect()
    assert seen.value == 400

    plain = base.withColumn("b", (F.col("k") % 5).cast("double"))
    for row in got:
        train, test = M.stratified_split(plain.filter(F.col("horizon") == row.horizon), "k")
        model = M.fit_pipeline(M.with_weights(train, method="isns"), ["a", "b"], "tree",
                               weight_col="weight")
        want = M.confusion_metrics(M.scored(model, test, "k")).first()
        assert [row.accuracy, row.f1, row.auc_hard] == pytest.approx(
            [want.accuracy, want.f1, want.auc_hard], abs=1e-12)
    assert [r.horizon for r in sorted(got)] == [1, 2]

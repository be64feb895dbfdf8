"""Model data preparation, training and evaluation (survey 2I) on
``pyspark.ml``.

* Splits, under-sampling and over-sampling are exact per class: rows are
  ranked by a seeded hash with a distributed rank, so a class holding most
  rows is still ranked in parallel.
* Metrics are conditional sums; ROC / PR curves use distributed cumulative
  sums over the distinct scores (range-partitioned, per-partition running
  sums plus per-partition offsets) instead of a single-partition window.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tessera.operators.quantiles import exact_percentiles
from tessera.operators.joins import fits_broadcast
from tessera.operators.ranks import cumulative_desc, global_row_number, running_by
from tessera.session import written

LABEL = "Label"


# I01 ---------------------------------------------------------------------------
def seeded_order(key: str, seed: int) -> Column:
    """A reproducible shuffle key: md5 of the seed and the row's key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def class_ranks(df: DataFrame, key: str, label: str = LABEL, seed: int = 42) -> DataFrame:
    """*df* plus ``_n`` (rows of its class) and ``_k`` (1-based place of the
    row in its class, in seeded order).  Null labels are a class of their own."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col(label).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)                       # one row per class
    counts = counts.select(F.col(label).alias("_class"), "_n",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = global_row_number(df, F.struct(F.col(label).alias("a"),
                                            seeded_order(key, seed).alias("b"),
                                            F.col(key).alias("c")), "_r")
    return (ranked.join(F.broadcast(counts), F.col(label).eqNullSafe(F.col("_class")))
            .withColumn("_k", F.col("_r") - F.col("_before")).drop("_r", "_class", "_before"))


def test_flags(df: DataFrame, key: str, label: str = LABEL, test_fraction: float = 0.2,
               seed: int = 42) -> DataFrame:
    """*df* plus ``_test``: of every class, round(n · ``test_fraction``) rows,
    the first in seeded order, are test rows."""
    test = F.col("_k") <= F.floor(F.col("_n") * test_fraction + 0.5)
    return class_ranks(df, key, label, seed).withColumn("_test", test).drop("_k", "_n")


def stratified_split(df: DataFrame, key: str, label: str = LABEL, test_fraction: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Exact split by :func:`test_flags`: (train, test)."""
    ranked = test_flags(df, key, label, test_fraction, seed)
    return ranked.filter(~F.col("_test")).drop("_test"), ranked.filter("_test").drop("_test")


# I02 / I03 ---------------------------------------------------------------------
def class_weights(df: DataFrame, label: str = LABEL, method: str = "balanced",
                  beta: float = 0.99999) -> DataFrame:
    """Per-class weight: ``balanced`` n/(k·n_c); ``inverse`` 1/n_c;
    ``isns`` 1/sqrt(n_c); ``ens`` (1-β)/(1-β^n_c)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n = F.sum("n_c").over(Window.partitionBy(F.lit(1)))   # over the class table only
    k = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    w = {"balanced": n / (k * F.col("n_c")),
         "inverse": 1.0 / F.col("n_c"),
         "isns": 1.0 / F.sqrt(F.col("n_c")),
         "ens": (1.0 - beta) / (1.0 - F.pow(F.lit(beta), F.col("n_c")))}[method]
    return c.select(label, w.alias("weight"))


def with_weights(df: DataFrame, label: str = LABEL, method: str = "balanced") -> DataFrame:
    """Attach the class weight as a column (a join with the tiny class table)."""
    return df.join(F.broadcast(class_weights(df, label, method)), label)


def imbalance_ratio(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``scale_pos_weight`` = negatives / positives."""
    return df.agg((F.count_if(F.col(label) == 0) / F.count_if(F.col(label) == 1))
                  .alias("scale_pos_weight"))


# I04 ---------------------------------------------------------------------------
def undersample(df: DataFrame, key: str, label: str = LABEL, seed: int = 42) -> DataFrame:
    """As many rows of every class as the smallest class has: the first in
    seeded order."""
    least = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).scalar()
    return class_ranks(df, key, label, seed).filter(F.col("_k") <= least).drop("_k", "_n")


# I05 ---------------------------------------------------------------------------
def smote(df: DataFrame, features: Sequence[str], key: str, label: str = LABEL,
          seed: int = 42, neighbours: int = 5) -> DataFrame:
    """SMOTE: synthetic minority rows until both classes are equal in size.

    A synthetic row lies at a seeded random point between a minority row and
    one of its ``neighbours`` nearest rows along a seeded random projection of
    the (min-max scaled) features; ranks along the projection are distributed,
    so no candidate pairs are enumerated.  Every minority row is used equally
    often, up to one."""
    import numpy as np

    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    base = df.select(F.col(key).cast("string").alias(key), *features, label)
    if len(counts) < 2:
        return base
    minority = min(counts, key=counts.get)
    n, missing = counts[minority], max(counts.values()) - counts[minority]
    mino = df.filter(F.col(label) == minority).fillna(0, subset=list(features))
    stats = mino.agg(*[F.min(f).alias(f"lo_{f}") for f in features],
                     *[F.max(f).alias(f"hi_{f}") for f in features]).first()      # one row
    direction = np.random.default_rng(seed).normal(size=len(features))
    proj = F.lit(0.0)
    for wgt, f in zip(direction, features):
        lo, hi = stats[f"lo_{f}"] or 0.0, stats[f"hi_{f}"] or 0.0
        scaled = (F.col(f) - F.lit(lo)) / F.lit(hi - lo) if hi != lo else F.lit(0.0)
        proj = proj + F.lit(float(wgt)) * scaled
    ranked = global_row_number(mino, F.struct(proj.alias("p"), F.col(key).alias("k")), "_r")
    times = F.lit(missing // n) + (F.col("_r") <= missing % n).cast("int")
    copies = (ranked.withColumn("_times", times).filter("_times > 0")
              .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))))
    draw = F.xxhash64(F.col(key), F.col("_copy"), F.lit(seed))
    # The drawn neighbour is 1 .. neighbours ranks up, or down at the upper end.
    reach = min(neighbours, max(n - 1, 1))
    ahead = F.col("_r") + F.pmod(draw, F.lit(reach)) + 1
    copies = copies.withColumn("_near", F.when(F.lit(n == 1), F.col("_r")).when(
        ahead <= n, ahead).otherwise(F.greatest(F.lit(1), 2 * F.col("_r") - ahead)))
    other = ranked.select(F.col("_r").alias("_near"), *[F.col(f).alias(f"_b_{f}") for f in features])
    gap = F.pmod(F.xxhash64(draw, F.lit("gap")), F.lit(1_000_000)) / 1_000_000.0
    synth = copies.join(other, "_near").select(
        F.concat(F.lit("syn_"), F.col(key).cast("string"), F.lit("_"),
                 F.col("_copy").cast("string")).alias(key),
        *[(F.col(f) + gap * (F.col(f"_b_{f}") - F.col(f))).alias(f) for f in features],
        F.lit(minority).alias(label))
    return base.unionByName(synth)


# I06 - I10 ---------------------------------------------------------------------
def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def scaler(kind: str | None):
    """standard (mean, std), min-max or robust scaling inside the
    pipeline — fitted on the training data only."""
    if kind is None:
        return None
    cls = {"standard": lambda: StandardScaler(inputCol="features", outputCol="scaled",
                                              withMean=True, withStd=True),
           "min_max": lambda: MinMaxScaler(inputCol="features", outputCol="scaled"),
           "robust": lambda: RobustScaler(inputCol="features", outputCol="scaled")}[kind]
    return cls()


def classifier(kind: str, features_col: str = "features", weight_col: str | None = None,
               seed: int = 42, **params):
    common = {"featuresCol": features_col, "labelCol": LABEL}
    if kind == "logistic":
        m = LogisticRegression(**common, maxIter=params.get("maxIter", 100))
    elif kind == "naive_bayes":
        m = NaiveBayes(**common, modelType="gaussian")
    elif kind == "tree":
        m = DecisionTreeClassifier(**common, seed=seed, maxDepth=params.get("maxDepth", 5))
    elif kind == "forest":
        m = RandomForestClassifier(**common, seed=seed, numTrees=params.get("numTrees", 50),
                                   maxDepth=params.get("maxDepth", 5))
    elif kind == "gbt":
        m = GBTClassifier(**common, seed=seed, maxIter=params.get("maxIter", 20),
                          maxDepth=params.get("maxDepth", 3))
    else:
        raise ValueError(kind)
    if weight_col and kind != "naive_bayes":
        m.setWeightCol(weight_col)
    return m


def fit_pipeline(train: DataFrame, features: Sequence[str], kind: str, scale: str | None = None,
                 weight_col: str | None = None, **params):
    stages = [assembler(features)]
    sc = scaler(scale)
    if sc is not None:
        stages.append(sc)
    stages.append(classifier(kind, "scaled" if sc is not None else "features", weight_col, **params))
    return Pipeline(stages=stages).fit(train)


def scored(model, df: DataFrame, key: str) -> DataFrame:
    """``(key, Label, score, prediction)`` with score = P(class 1)."""
    out = model.transform(df)
    return out.select(key, LABEL, vector_to_array("probability")[1].alias("score"),
                      F.col("prediction").cast("int").alias("prediction"))


# I11 / I12 ---------------------------------------------------------------------
#: The grid of the forest search; the number of trees is no part of it.
FOREST_GRID = {"numTrees": [10], "maxDepth": [5, 10, 20],
               "minInstancesPerNode": [2, 6, 12], "subsamplingRate": [0.6, 0.7, 0.8]}
BOOSTED_SPACE = {"maxDepth": [2, 3, 4, 5], "maxIter": [5, 10, 20], "stepSize": [0.05, 0.1, 0.2],
                 "subsamplingRate": [0.7, 0.85, 1.0]}
#: Fits of a search that run at the same time.
PARALLEL_FITS = 8


def cross_validated(train: DataFrame, features: Sequence[str], est, maps: Sequence[dict],
                    evaluator, folds: int, seed: int):
    """k-fold cross-validation of *est* over parameter *maps*.

    Rows are assembled once a fold, not in every pass of every fit.  Forests keep
    the node of each row and tree beside the row, so a pass neither walks the
    trees from their roots nor sends them to the tasks; the trees are the same.
    The model returned takes the plain *features*."""
    if isinstance(est, RandomForestClassifier):
        est = est.setCacheNodeIds(True).setCheckpointInterval(-1)   # as many steps as levels
    vectors = assembler(features)
    cv = CrossValidator(estimator=est, estimatorParamMaps=list(maps), evaluator=evaluator,
                        numFolds=folds, seed=seed, parallelism=PARALLEL_FITS)
    found = cv.fit(vectors.transform(train).select(LABEL, "features"))
    found.bestModel = PipelineModel(stages=[vectors, found.bestModel])
    return found


def grid_search(train: DataFrame, features: Sequence[str], kind: str = "forest",
                grid: dict | None = None, folds: int = 5, metric: str = "f1", seed: int = 42):
    """Grid search with k-fold cross-validation (F1 by default)."""
    est = classifier(kind, seed=seed)
    b = ParamGridBuilder()
    for name, values in (grid or {"maxDepth": [3, 5], "numTrees": [20, 50]}).items():
        b = b.addGrid(est.getParam(name), values)
    ev = (MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1") if metric == "f1"
          else BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC"))
    return cross_validated(train, features, est, b.build(), ev, folds, seed)


def random_search(train: DataFrame, features: Sequence[str], kind: str = "gbt",
                  space: dict | None = None, draws: int = 10, folds: int = 5, seed: int = 42):
    """Random search: ``draws`` parameter maps sampled (seeded) from the
    space, each cross-validated on AUC."""
    est = classifier(kind, seed=seed)
    space = space or {"maxDepth": [2, 3, 4, 5], "maxIter": [5, 10, 20], "stepSize": [0.05, 0.1, 0.2]}
    rng = random.Random(seed)
    maps = []
    for _ in range(draws):
        maps.append({est.getParam(k): rng.choice(v) for k, v in space.items()})
    ev = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderROC")
    return cross_validated(train, features, est, maps, ev, folds, seed)


# I13 / I16 ---------------------------------------------------------------------
def confusion_metrics(scored_df: DataFrame, by: Sequence[str] = (), label: str = LABEL,
                      prediction: str = "prediction") -> DataFrame:
    """tp/fp/tn/fn, accuracy, precision, recall, F1 (per segment if ``by``)."""
    y, p = F.col(label), F.col(prediction)
    g = scored_df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    prec = F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp))
    rec = F.when(tp + fn == 0, F.lit(0.0)).otherwise(tp / (tp + fn))
    f1 = F.when(prec + rec == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return g.select(*by, "tp", "fp", "tn", "fn",
                    ((tp + tn) / (tp + fp + tn + fn)).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    ((rec + F.when(tn + fp == 0, F.lit(0.0)).otherwise(tn / (tn + fp))) / 2)
                    .alias("auc_hard"))


# I14 / I15 ---------------------------------------------------------------------
def score_counts(scored_df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    return scored_df.groupBy(score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                        F.count_if(F.col(label) == 0).alias("neg"))


def roc_points(scored_df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """One ROC point per distinct score threshold (score ≥ threshold → 1)."""
    c = cumulative_desc(score_counts(scored_df, label, score), score, ["pos", "neg"])
    tot = scored_df.agg(F.struct(F.count_if(F.col(label) == 1).alias("P"),
                                 F.count_if(F.col(label) == 0).alias("N"))).scalar()
    return c.select(F.col(score).alias("threshold"),
                    (F.col("cum_pos") / F.greatest(tot["P"], F.lit(1))).alias("tpr"),
                    (F.col("cum_neg") / F.greatest(tot["N"], F.lit(1))).alias("fpr"))


def auc(scored_df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """Rank-sum AUC with ties counted one half:
    Σ_s neg(s)·(pos above s + pos(s)/2) / (P·N)."""
    c = cumulative_desc(score_counts(scored_df, label, score), score, ["pos"])
    above = F.col("cum_pos") - F.col("pos")
    return c.agg((F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
                  / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def pr_curve(scored_df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    """Precision / recall per distinct threshold and the average precision
    Σ (R_n − R_{n−1})·P_n."""
    c = cumulative_desc(score_counts(scored_df, label, score), score, ["pos", "neg"])
    P = F.greatest(scored_df.agg(F.count_if(F.col(label) == 1)).scalar(), F.lit(1))
    return c.select(F.col(score).alias("threshold"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    (F.col("cum_pos") / P).alias("recall"),
                    (F.col("pos") / P).alias("recall_step"))


def average_precision(scored_df: DataFrame, label: str = LABEL, score: str = "score") -> DataFrame:
    pr = pr_curve(scored_df, label, score)
    return pr.agg(F.sum(F.col("recall_step") * F.col("precision")).alias("average_precision"))


# I18 ---------------------------------------------------------------------------
def blend(a: DataFrame, b: DataFrame, key: str, wa: float = 0.8, threshold: float = 0.5) -> DataFrame:
    j = a.select(key, LABEL, F.col("score").alias("sa")).join(
        b.select(key, F.col("score").alias("sb")), key)
    s = wa * F.col("sa") + (1 - wa) * F.col("sb")
    return j.select(key, LABEL, s.alias("score"), (s >= threshold).cast("int").alias("prediction"))


# I19 / I20 ---------------------------------------------------------------------
def recursive_elimination(train: DataFrame, test: DataFrame, features: Sequence[str], key: str,
                          n_keep: int, kind: str = "forest", step: int = 1):
    """Drop the least important feature(s) until ``n_keep`` remain; returns
    the kept features and (n_features, dropped, auc), ``dropped`` being what
    goes next; the AUC of all rounds is ranked in one pass."""
    feats, all_scores, gone = list(features), None, []
    while True:
        model = fit_pipeline(train, feats, kind, numTrees=20)
        s = scored(model, test, key).withColumn("n_features", F.lit(len(feats)))
        all_scores = s if all_scores is None else all_scores.unionByName(s)
        imp = model.stages[-1].featureImportances.toArray()
        order = sorted(range(len(feats)), key=lambda i: (imp[i], feats[i]))
        drop = [feats[i] for i in order[:min(step, len(feats) - n_keep)]]
        gone.append((len(feats), ", ".join(sorted(drop)) or None))
        if len(feats) <= n_keep:
            break
        feats = [f for f in feats if f not in drop]
    rounds = train.sparkSession.createDataFrame(gone, "n_features int, dropped string")
    return feats, rounds.join(auc_by(all_scores, ["n_features"]), "n_features", "left")


def policy_weights(df: DataFrame, policy: str) -> DataFrame:
    """*df* plus ``weight``: a class-weight method, or ``scale_pos_weight``
    (positive rows weigh negatives / positives)."""
    if policy != "scale_pos_weight":
        return with_weights(df, method=policy)
    ratio = imbalance_ratio(df).scalar()
    return df.withColumn("weight", F.when(F.col(LABEL) == 1, ratio).otherwise(F.lit(1.0)))


def metric_table(table: DataFrame, horizons: Sequence[int], features: Sequence[str], key: str,
                 policies: Sequence[str], kind: str = "gbt") -> DataFrame:
    """(horizon, policy, accuracy, precision, recall, f1, auc_hard): a model
    for each horizon of *table* and weight policy, measured on its exact test
    split.  *table* is computed once: its rows are assembled and written in a
    folder a horizon.  Splits and fits run side by side, each split ranked and
    written once; all predictions are measured in one pass."""
    spark = table.sparkSession
    rows = written(assembler(features).transform(table).select("horizon", key, LABEL, "features"),
                   "horizons", by=["horizon"])

    @inheritable_thread_target(spark)
    def split(h: int) -> DataFrame:
        return written(test_flags(rows.filter(F.col("horizon") == h).drop("horizon"), key),
                       "split", by=["_test"])

    @inheritable_thread_target(spark)
    def fit(case: tuple[int, str]) -> DataFrame:
        train, test = (splits[case[0]].filter(w).drop("_test") for w in ("not _test", "_test"))
        model = classifier(kind, weight_col="weight").fit(policy_weights(train, case[1]))
        return scored(model, test, key).select(F.lit(case[0]).alias("horizon"),
                                               F.lit(case[1]).alias("policy"), LABEL, "prediction")

    with ThreadPool(PARALLEL_FITS) as pool:
        splits = dict(zip(horizons, pool.map(split, horizons)))
        parts = pool.map(fit, [(h, p) for h in horizons for p in policies])
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return confusion_metrics(every, ["horizon", "policy"]).select(
        "horizon", "policy", "accuracy", "precision", "recall", "f1", "auc_hard")


def robust_scaled(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, feature, value - median over the quartile range) of every
    feature; a feature whose quartiles are equal is only centred."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"))
                      for f in features])
    long = df.select(key, F.explode(cells).alias("c")).select(key, "c.*")
    mid = exact_percentiles(long, ["feature"], "x", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return long.join(mid, "feature", "left").select(
        key, "feature", F.round((F.col("x") - F.col("q2")) / F.when(spread == 0, F.lit(1.0))
                                .otherwise(spread), 10).alias("scaled"))


def score_medians(a: DataFrame, b: DataFrame, key: str, wa: float = 0.8) -> DataFrame:
    """(which, median) of two scores and of their blend."""
    both = a.select(key, F.col("score").alias("a")).join(b.select(key, F.col("score").alias("b")), key)
    cells = F.array(*[F.struct(F.lit(n).alias("which"), c.alias("x")) for n, c in
                      (("a", F.col("a")), ("b", F.col("b")),
                       ("blend", wa * F.col("a") + (1 - wa) * F.col("b")))])
    long = both.select(F.explode(cells).alias("c")).select("c.*")
    return exact_percentiles(long, ["which"], "x", {"median": 0.5})


def auc_by(scored_df: DataFrame, by: Sequence[str], label: str = LABEL, score: str = "score"
           ) -> DataFrame:
    """The rank-sum AUC of every segment *by*, in one pass: segments are runs
    of one range order, so neither a large segment nor many small ones need a
    task or a job of their own."""
    counts = scored_df.groupBy(*by, score).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                               F.count_if(F.col(label) == 0).alias("neg"))
    rows = running_by(counts, by, -F.col(score), ["pos", "neg"])
    above = F.col("run_pos") - F.col("pos")
    total = F.max(F.col("all_pos")) * F.max(F.col("all_neg"))
    return rows.groupBy(*by).agg(
        (F.sum(F.col("neg") * (above + F.col("pos") / 2.0))
         / F.when(total > 0, total)).alias("auc"))


def _multiplier(n: int, rng: random.Random) -> int:
    """A number below n without a common factor with it."""
    while True:
        a = rng.randrange(1, max(n, 2))
        if math.gcd(a, n) == 1:
            return a


def permuted_rows(test: DataFrame, features: Sequence[str], key: str, repeats: int, seed: int = 42
                  ) -> DataFrame:
    """*test* once as it is (feature "", repeat 0) and once for each feature and
    repeat with that feature's values permuted among the rows.

    Rows are numbered once in a seeded order; with a permutation number i takes
    the value of number (a i + b) mod n, with a and n without a common factor.
    So every value knows the number it goes to, and only (number, feature,
    repeat, value) is made for each feature and repeat.  These meet the rows by
    number: the rows are broadcast if their counted size allows, otherwise both
    sides are sorted.  The planner must not choose, as it takes exploded rows
    for as few as there were before."""
    rows = written(global_row_number(test.select(key, LABEL, *features), F.struct(
        seeded_order(key, seed).alias("a"), F.col(key).alias("b")), "_r"), "test-rows")
    n = rows.count()
    rng = random.Random(seed)
    draws = [(i, r, _multiplier(n, rng), rng.randrange(max(n, 1)))
             for i in range(1, len(features) + 1) for r in range(1, repeats + 1)]
    plan = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("repeat"),
                              F.lit(pow(a, -1, max(n, 1))).cast("long").alias("back"),
                              F.lit(b).cast("long").alias("b")) for i, r, a, b in draws])
    number = F.pmod(F.col("_d.back") * (F.col("_r") - 1 - F.col("_d.b")), F.lit(max(n, 1))) + 1
    names = F.array(*[F.lit(f) for f in features])
    moved = rows.select("_r", F.array(*[F.col(f).cast("double") for f in features]).alias("_all"),
                        F.explode(plan).alias("_d")).select(
        number.alias("_r"), F.col("_d.i").alias("_i"), F.col("_d.repeat").alias("repeat"),
        F.element_at("_all", F.col("_d.i")).alias("_v"))
    met = (moved.join(F.broadcast(rows), "_r") if fits_broadcast(rows)
           else moved.hint("merge").join(rows, "_r"))
    swapped = met.select(
        key, LABEL, F.element_at(names, F.col("_i")).alias("feature"), "repeat",
        *[F.when(F.col("_i") == i, F.col("_v")).otherwise(F.col(f)).alias(f)
          for i, f in enumerate(features, 1)])
    plain = rows.select(key, LABEL, F.lit("").alias("feature"), F.lit(0).alias("repeat"),
                        *[F.col(f).cast("double").alias(f) for f in features])
    return plain.unionByName(swapped)


def permutation_importance(model, test: DataFrame, features: Sequence[str], key: str,
                           repeats: int = 10, seed: int = 42) -> DataFrame:
    """(feature, importance, deviation): mean and deviation, over the repeats,
    of the AUC that is lost when the feature's values are permuted.  All
    features and repeats are scored and ranked in one pass."""
    rows = model.transform(permuted_rows(test, features, key, repeats, seed)).select(
        "feature", "repeat", LABEL, vector_to_array("probability")[1].alias("score"))
    each = written(auc_by(rows, ["feature", "repeat"]), "aucs")
    base = each.filter("feature = ''").agg(F.max("auc")).scalar()
    return (each.filter("feature <> ''").groupBy("feature")
            .agg(F.avg(base - F.col("auc")).alias("importance"),
                 F.stddev_pop("auc").alias("deviation")))

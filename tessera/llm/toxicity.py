"""Operator 1: toxicity by non-negative positive-unlabelled learning.

Positives are documents confirmed toxic, the rest of the corpus is unlabelled
text (toxic documents among it).  Linear classifiers over word and word-prefix
counts (seen at least once, twice, four times) are trained with numpy on the risk

    prior * R_pos(+1) + max(0, R_unl(-1) - prior * R_pos(-1)),

whose bracket is the class-prior-corrected risk of the unseen negatives, kept
from going below zero (then only the ascent step of the correction is taken).
The prior is the toxic share of all training labels.  Several classifiers see
different halves of the unlabelled sample; a score is their mean.

Training uses a bounded sample (``max_positive`` and ``max_unlabelled``
documents in hash order of the id); prior and scoring cover everything.  Each
text is scored whole.

Defined results: a null or empty text scores as text without any feature; a
document with several labels is toxic if one says so; null ids are never held
out and never matched with a label; with no toxic label at all every score is
0; repeated rows score alike; an empty table gives an empty result; extra
columns, lang and source are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import is_held_out
from tessera.llm.textbytes import IS_WORDY, LOWER, SpanHash, slices, spans, utf8

MAX_POSITIVE = 4096
MAX_UNLABELLED = 12_288
MAX_FEATURES = 4096
PREFIXES = (4, 5, 6, 7, 8)
#: A word or prefix is seen at least once, twice, four times: one feature each.
LEVELS = np.array([1, 2, 4])
#: Least ratio of the two bounds of a feature that is kept.
MIN_RATIO = 3.0
THRESHOLD = 0.3
MODELS = 3


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and word prefix, lower-cased."""
    raw = LOWER[raw]
    starts, ends, per_text = spans(raw, offsets, IS_WORDY)
    text = np.repeat(np.arange(len(offsets) - 1), per_text)
    h = SpanHash(raw)
    rows, out = [text], [h(starts, ends)]
    for k, n in enumerate(PREFIXES, 1):
        long = ends - starts > n
        a = starts[long]
        rows.append(text[long])
        out.append(h(a, a + n) ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return np.concatenate(rows), np.concatenate(out)


@dataclass
class Model:
    """Word and prefix hashes (ascending); per classifier a weight for every
    hash and level, and a bias."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def __post_init__(self):
        self.slot = np.full(1 << 18, -1, np.int32)
        # Features whose top bits clash share a slot: the slot leads to a run.
        top = (self.hashes >> np.uint64(46)).astype(np.int64)
        self.slot[top[::-1]] = np.arange(len(top), dtype=np.int32)[::-1]

    def present(self, text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature index) pairs; a known hash has one index per level."""
        maybe = np.flatnonzero(self.slot[(h >> np.uint64(46)).astype(np.int64)] >= 0)
        text, h = text[maybe], h[maybe]
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == h if len(h) else np.zeros(0, bool)
        size = len(self.hashes) + 1
        pair, times = np.unique(text[known] * size + at[known], return_counts=True)
        row, level = np.nonzero(times[:, None] >= LEVELS[None])
        return pair[row] // size, pair[row] % size * len(LEVELS) + level

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.bias):
            return np.zeros(n)
        text, feature = self.present(*features(raw, offsets))
        total = np.zeros(n)
        for w, b in zip(self.weights, self.bias):
            z = b + np.bincount(text, weights=w[feature], minlength=n)
            total += 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))
        return total / len(self.bias)


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int,
             prior: float, steps: int = 400, rate: float = 0.05, decay: float = 2e-3
             ) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative PU risk (logistic loss)
    of the sparse 0/1 matrix (rows, cols); ``positive`` marks confirmed rows,
    all others are unlabelled.  Full-batch Adam."""
    n = len(positive)
    p, u = positive.astype(float), (~positive).astype(float)
    p, u = p / max(p.sum(), 1), u / max(u.sum(), 1)
    w, b = np.zeros(n_features), np.log(prior / (1 - prior))
    moment, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, weights=w[cols], minlength=n) + b
        s = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        as_negative = np.logaddexp(0, z)              # loss of calling a row negative
        negatives = (u * as_negative).sum() - prior * (p * as_negative).sum()
        if negatives >= 0:
            g = prior * p * (s - 1) + (u - prior * p) * s
        else:                                          # the corrected risk went below zero
            g = -(u - prior * p) * s
        grad = np.append(np.bincount(cols, weights=g[rows], minlength=n_features) + decay * w,
                         g.sum())
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        move = rate * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def _sample(docs: DataFrame, labels: DataFrame, max_positive: int, max_unlabelled: int
            ) -> tuple[DataFrame, float]:
    """Training documents (text, positive) and the class prior."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .filter(~is_held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    order = F.xxhash64("doc_id")
    confirmed = (known.filter("toxic = 1").orderBy(order, "doc_id").limit(max_positive)
                 .select("doc_id", F.lit(True).alias("positive")))
    train = docs.select("doc_id", "text").filter(~is_held_out(F.col("doc_id")))
    fraction = min(1.0, max_unlabelled / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(1_000_000)) < int(
        fraction * 1_000_000)
    # At most max_positive ids: a bounded broadcast.
    rows = train.join(F.broadcast(confirmed), "doc_id", "left").filter(
        F.col("positive").isNotNull() | chosen)
    return rows.select("text", F.coalesce("positive", F.lit(False)).alias("positive"),
                       chosen.alias("unlabelled")), share


def _feature_rows(keep: np.ndarray | None):
    """Task: the distinct features of each sampled text, those in *keep* only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(keep, np.zeros((0, 0)), np.zeros(0)) if keep is not None else None
        for batch in batches:
            for start, n in slices(batch.column(0)):
                raw, offsets = utf8(batch.column(0).slice(start, n))
                text, h = features(raw, offsets)
                if model is None:
                    order = np.lexsort((h, text))
                    text, h = text[order], h[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                    yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64))],
                                                     names=["feature"])
                    continue
                text, at = model.present(text, h)
                cuts = np.searchsorted(text, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                              pa.array(at, pa.int32())),
                     batch.column(1).slice(start, n), batch.column(2).slice(start, n)],
                    names=["features", "positive", "unlabelled"])
    return run


def train(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES,
          models: int = MODELS) -> Model:
    rows, prior = _sample(docs, labels, max_positive, max_unlabelled)
    none = Model(np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0))
    if not 0 < prior:
        return none
    prior = min(prior, 0.95)
    positives = rows.filter("positive")
    counts = (positives.mapInArrow(_feature_rows(None), "feature long")
              .groupBy("feature").count().filter("count >= 2")
              .orderBy(F.desc("count"), "feature").limit(1 << 16).toPandas())
    if counts.empty:
        return none
    candidates = np.sort(counts["feature"].to_numpy(np.int64).view(np.uint64))
    sample = rows.mapInArrow(_feature_rows(candidates),
                             "features array<int>, positive boolean, unlabelled boolean").toArrow()
    lists = sample.column(0).combine_chunks()
    positive = sample.column(1).to_numpy().astype(bool)
    unlabelled = sample.column(2).to_numpy().astype(bool)
    cuts = lists.offsets.to_numpy()
    cols = lists.values.to_numpy()[cuts[0]:cuts[-1]] if len(lists) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(positive)), np.diff(cuts))
    size = len(candidates) * len(LEVELS)
    in_p = np.bincount(cols[positive[row]], minlength=size)
    in_u = np.bincount(cols[unlabelled[row]], minlength=size)
    n_p, n_u = max(positive.sum(), 1), max(unlabelled.sum(), 1)
    # Keep features that are surely more frequent in positives: a lower bound
    # of their share there against an upper bound among unlabelled rows.
    low = np.maximum(in_p - 1.5 * np.sqrt(in_p), 0) / n_p
    high = (in_u + 0.5 * np.sqrt(in_u) + 0.25) / n_u
    ratio = low / high
    best = np.argsort(-ratio, kind="stable")[:max_features]
    best = np.sort(best[ratio[best] > MIN_RATIO])
    if not len(best):
        return none
    renamed = np.full(size, -1)
    renamed[best] = np.arange(len(best))
    known = renamed[cols] >= 0
    row, cols = row[known], renamed[cols[known]]
    rng = np.random.default_rng(7)
    weights, bias = [], []
    for _ in range(models):
        use_u = unlabelled & (rng.random(len(positive)) < 0.7)
        # Case-control: a confirmed row that the unlabelled sample drew counts in both.
        number = np.concatenate([np.flatnonzero(positive), np.flatnonzero(use_u)])
        as_positive = np.arange(len(number)) < positive.sum()
        place = [np.full(len(positive), -1), np.full(len(positive), -1)]
        place[0][number[as_positive]] = np.flatnonzero(as_positive)
        place[1][number[~as_positive]] = np.flatnonzero(~as_positive)
        rs, cs = [], []
        for part in place:
            inside = part[row] >= 0
            rs.append(part[row[inside]])
            cs.append(cols[inside])
        w, b = nnpu_fit(np.concatenate(rs), np.concatenate(cs), as_positive, len(best), prior)
        weights.append(w)
        bias.append(b)
    used = np.unique(best // len(LEVELS))
    full = np.zeros((models, len(used), len(LEVELS)))
    full[:, np.searchsorted(used, best // len(LEVELS)), best % len(LEVELS)] = weights
    return Model(candidates[used], full.reshape(models, -1), np.array(bias))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = (model.hashes, model.weights, model.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*parts)
        for batch in batches:
            out = [own.scores(*utf8(batch.column(2).slice(start, n)))
                   for start, n in slices(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array(np.concatenate(out) if out else np.zeros(0))],
                names=["doc_id", "held_out", "score"])

    return (docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))

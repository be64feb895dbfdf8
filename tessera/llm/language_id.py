"""Operator 6: language identification with a byte convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows,
each filter is max-pooled over its window, and a softmax layer reads the
pooled values.  The network is trained with numpy on windows of a bounded
sample of labelled documents (about ``per_language`` documents a language,
chosen by a hash of the id) and applied to *all* windows of every text; a
text's probabilities are the mean over its windows, weighted by their bytes.

Defined results: ``und`` with score 0 for a null text, a text without any
letter, or when no label could be learned; documents with a null or held-out
label are never trained on; null ids count as not held out; repeated rows get
equal answers; an empty table gives an empty result; extra columns, source
and (beyond training) lang are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import is_held_out
from tessera.llm.textbytes import slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PER_LANGUAGE = 1500
WINDOWS_PER_DOC = 2
UNKNOWN = "und"


@dataclass
class Network:
    """Parameters: embedding (256, E); per width filters (w, E, F) and bias
    (F,); output layer (widths x F, classes) and bias."""

    classes: list[str]
    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    def tables(self) -> tuple:
        """A filter's response is a sum of per-byte table rows; neighbouring
        bytes share one table of all byte pairs."""
        single = [[(self.embed @ f[j]).astype(np.float32) for j in range(len(f))]
                  for f in self.filters]
        out = []
        for t in single:
            parts = []
            for j in range(0, len(t) - 1, 2):
                parts.append((j, True, (t[j][:, None, :] + t[j + 1][None]).reshape(65536, -1)))
            if len(t) % 2:
                parts.append((len(t) - 1, False, t[-1]))
            out.append(parts)
        return tuple(out)

    def probabilities(self, windows: np.ndarray, tables: tuple) -> np.ndarray:
        """(windows, WINDOW) bytes -> (windows, classes)."""
        columns = np.ascontiguousarray(windows.T)
        pairs = columns[:-1].astype(np.int32) * 256 + columns[1:]
        pooled = []
        n, shape = columns.shape[0], (columns.shape[1], self.filters[0].shape[2])
        a, b = np.empty(shape, np.float32), np.empty(shape, np.float32)
        for parts, bias, f in zip(tables, self.biases, self.filters):
            best = np.full(shape, -np.inf, np.float32)
            for p in range(n - len(f) + 1):
                for k, (j, double, table) in enumerate(parts):
                    index = pairs[p + j] if double else columns[p + j]
                    np.take(table, index, axis=0, out=b if k else a, mode="clip")
                    if k:
                        np.add(a, b, out=a)
                np.maximum(best, a, out=best)
            pooled.append(np.maximum(best + bias.astype(np.float32), 0))
        return softmax(np.concatenate(pooled, 1) @ self.out + self.out_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def fit(windows: np.ndarray, labels: np.ndarray, classes: list[str], steps: int = 600,
        batch: int = 128, rate: float = 3e-3, seed: int = 5, filters: int = FILTERS) -> Network:
    """Minibatch Adam on the cross-entropy of single windows; about *steps*
    minibatches, but at least six passes."""
    epochs = max(6, -(-steps * batch // max(1, len(windows))))
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBED))]
    params += [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, filters)) for w in WIDTHS]
    params += [np.zeros(filters) for _ in WIDTHS]
    params += [rng.normal(0, 0.1, (len(WIDTHS) * filters, len(classes))), np.zeros(len(classes))]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    k, step = len(WIDTHS), 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // batch)):
            x, y = windows[at].astype(np.int64), labels[at]
            embed, fs, bs = params[0], params[1:1 + k], params[1 + k:1 + 2 * k]
            out, out_bias = params[-2:]
            pooled, where = [], []
            for f, b in zip(fs, bs):
                n = x.shape[1] - len(f) + 1
                z = sum((embed @ f[j])[x[:, j:j + n]] for j in range(len(f)))
                arg = z.argmax(1)
                where.append(arg)
                pooled.append(np.take_along_axis(z, arg[:, None], 1)[:, 0] + b)
            hidden = np.concatenate(pooled, 1)
            active = np.maximum(hidden, 0)
            g = softmax(active @ out + out_bias)
            g[np.arange(len(y)), y] -= 1
            g /= len(y)
            d_hidden = (g @ out.T) * (hidden > 0)
            grads = [np.zeros_like(embed)]
            for i, (f, arg) in enumerate(zip(fs, where)):
                d = d_hidden[:, i * filters:(i + 1) * filters]
                df = np.zeros_like(f)
                for j in range(len(f)):
                    at_bytes = np.take_along_axis(x, arg + j, 1)          # (batch, filters)
                    df[j] = np.einsum("bf,bfe->ef", d, embed[at_bytes])
                    np.add.at(grads[0], at_bytes, d[:, :, None] * f[j].T[None])
                grads.append(df)
            grads += [d_hidden[:, i * filters:(i + 1) * filters].sum(0) for i in range(k)]
            grads += [active.T @ g, g.sum(0)]
            step += 1
            for p, (m, v), d in zip(params, moments, grads):
                m *= 0.9
                m += 0.1 * d
                v *= 0.999
                v += 0.001 * d * d
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Network(classes, params[0], params[1:1 + k], params[1 + k:1 + 2 * k], *params[-2:])


def training_windows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, window) of the bounded training sample; up to WINDOWS_PER_DOC
    windows a text, at places drawn by a hash of the text's length."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in  # one row per language name
              known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return known.select("lang", F.lit(None).cast("binary").alias("window")).limit(0)
    share = F.create_map(*[v for lang, n in counts.items()
                           for v in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) < (
        share[F.col("lang")] * 1_000_000)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                rng = np.random.default_rng(len(raw))
                for start in ([0] if len(raw) <= WINDOW else
                              rng.integers(0, len(raw) - WINDOW, WINDOWS_PER_DOC).tolist()):
                    langs.append(lang)
                    windows.append(raw[start:start + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()),
                                              pa.array(windows, pa.binary())],
                                             names=["lang", "window"])

    return known.filter(drawn).select("lang", "text").mapInArrow(cut, "lang string, window binary")


def as_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All fixed-length windows of all texts (the last one of a text padded
    with zero bytes), the text of each, and its bytes."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    text = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(counts) - counts
    inside = (np.arange(len(text)) - first[text]) * WINDOW
    size = np.minimum(WINDOW, lengths[text] - inside)
    windows = np.zeros((len(text), WINDOW), np.uint8)
    # Byte k of a text lands k bytes behind the text's first window.
    target = np.repeat(first * WINDOW - offsets[:-1], lengths) + np.arange(len(raw))
    windows.reshape(-1)[target] = raw
    return windows, text, size


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    sample = training_windows(docs, per_language).toPandas()
    if sample.empty:
        return None
    classes = sorted(sample["lang"].unique())
    windows = np.zeros((len(sample), WINDOW), np.uint8)
    for row, w in zip(windows, sample["window"]):
        row[:len(w)] = np.frombuffer(w, np.uint8)
    order = np.lexsort(windows.T[:8])  # no dependence on the order of arrival
    labels = sample["lang"].map({c: i for i, c in enumerate(classes)}).to_numpy()
    return fit(windows[order], labels[order], classes)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """*docs* (column text) plus lang_pred and score, appended last."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else ()
        for batch in batches:
            known = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best = np.full(batch.num_rows, -1)
            score = np.zeros(batch.num_rows)
            texts = batch.column(place)
            for start, n in slices(texts, 1 << 21) if network else ():
                windows, text, size = as_windows(*utf8(texts.slice(start, n)))
                total = np.zeros((n, len(network.classes)))
                for at in range(0, len(windows), 4096):
                    p = network.probabilities(windows[at:at + 4096], tables)
                    np.add.at(total, text[at:at + 4096], p * size[at:at + 4096, None])
                weight = np.maximum(total.sum(1, keepdims=True), 1e-300)
                best[start:start + n] = total.argmax(1)
                score[start:start + n] = (total / weight).max(1)
            names = pa.array([*(network.classes if network else []), UNKNOWN])
            known &= best >= 0
            pred = names.take(pa.array(np.where(known, best, len(names) - 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pred, pa.array(np.where(known, score, 0.0))],
                names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return (docs.withColumn("__letters", letters)
            .mapInArrow(run, f"{fields}, lang_pred string, score double"))


def drop_unidentified(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents whose language can be told, all input columns.  Where no
    label could be learned from, documents with a letter stay."""
    network = train(docs, per_language)
    if network is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text")
    known = identify(rows, network).filter(F.col("lang_pred") != UNKNOWN)
    return known.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c)
                          for c in docs.columns])


def languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    network = train(docs, per_language)
    rows = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "text")
    return identify(rows, network).drop("text")

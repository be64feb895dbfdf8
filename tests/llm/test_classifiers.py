"""Operators 1 and 6: held-out quality, the risk, the network, odd rows."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import language_id, toxicity
from tessera.llm.textbytes import IS_WHITE, IS_WORDY, SpanHash, spans, utf8

SF = "/root/testdata/sf0.1"


def test_spans_do_not_cross_texts():
    raw, offsets = utf8(pa.array(["ab c", "", None, "d  ef", " ", "g"])[1:])
    starts, ends, per_text = spans(raw, offsets, ~IS_WHITE)
    assert per_text.tolist() == [0, 0, 2, 0, 1]
    assert [bytes(raw[a:b]) for a, b in zip(starts, ends)] == [b"d", b"ef", b"g"]


def test_span_hashes_depend_on_the_bytes_alone():
    raw = np.frombuffer("xxabcdéabcdéyy".encode(), np.uint8)
    h = SpanHash(raw)
    assert h(np.array([2]), np.array([8]))[0] == h(np.array([8]), np.array([14]))[0]
    every = h.every(3)
    assert len(every) == len(raw) - 2 and len(np.unique(every)) == len({bytes(raw[i:i + 3])
                                                                        for i in range(len(raw) - 2)})


def test_features_find_words_and_prefixes():
    raw, offsets = utf8(pa.array(["Stupid, stupidly", "stup"]))
    text, h = toxicity.features(raw, offsets)
    assert len(set(h[text == 0])) == 2 + 4  # two words; the prefixes 4 and 5 are shared
    assert IS_WORDY[ord("a")] and not IS_WORDY[ord(",")]


def test_nnpu_risk_separates_and_stays_calibrated():
    rng = np.random.default_rng(0)
    n, prior = 4000, 0.2
    truth = rng.random(n) < prior
    x = np.column_stack([rng.random(n) < np.where(truth, 0.9, 0.02), rng.random(n) < 0.5])
    p = np.flatnonzero(truth)[:200]
    number = np.concatenate([p, np.arange(n)])
    positive = np.arange(len(number)) < len(p)
    rows, cols = np.nonzero(x[number])
    w, b = toxicity.nnpu_fit(rows, cols, positive, 2, prior)
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert score[x[:, 0]].min() > 0.5 > 0.2 > score[~x[:, 0]].max()


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    assert out.count() == docs.count()
    held = out.filter("held_out").join(labels, "doc_id")
    hit, said, real = held.agg(F.sum(F.col("predicted") * F.col("toxic")), F.sum("predicted"),
                               F.sum("toxic")).first()
    assert hit / real > 0.9 and hit / said > 0.9


def test_toxicity_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "you idiot", "x"), (4, "w " * 50_000, "x"),
            (4, "w " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, none).collect()
    assert len(out) == 5 and all(r.score == 0 and r.predicted == 0 for r in out)
    some = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    assert len(toxicity.toxicity(docs, some).collect()) == 5
    assert toxicity.toxicity(docs.limit(0), some).count() == 0


def test_network_tables_equal_the_plain_convolution():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (40, language_id.WINDOW)).astype(np.uint8)
    net = language_id.fit(x, rng.integers(0, 2, 40), ["a", "b"], steps=1)
    pooled = []
    for f, b in zip(net.filters, net.biases):
        n = x.shape[1] - len(f) + 1
        z = sum(net.embed[x[:, j:j + n]] @ f[j] for j in range(len(f)))
        pooled.append(np.maximum(z.max(1) + b, 0))
    want = language_id.softmax(np.concatenate(pooled, 1) @ net.out + net.out_bias)
    assert np.allclose(net.probabilities(x, net.tables()), want, atol=1e-4)


def test_windows_cover_every_byte():
    texts = ["a" * 300, "", "b" * 256, "c"]
    raw, offsets = utf8(pa.array(texts))
    windows, text, size = language_id.as_windows(raw, offsets)
    assert text.tolist() == [0, 0, 2, 3] and size.tolist() == [256, 44, 256, 1]
    for i, t in enumerate(texts):
        got = b"".join(bytes(w[:n]) for w, x, n in zip(windows, text, size) if x == i)
        assert got == t.encode()


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language_id.languages(docs)
    ok = out.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert ok > 0.95


def test_language_odd_rows(spark):
    rows = [(1, None, "en"), (2, "123 ?! ", "en"), (3, "the and of that " * 99, "en"),
            (None, "der und die das " * 9000, "de"), (3, "the and of that " * 99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = sorted((r.doc_id or 0, r.lang_pred) for r in language_id.languages(docs).collect())
    assert out[1:3] == [(1, "und"), (2, "und")] and len(out) == 5
    assert language_id.languages(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.languages(unlabelled).collect()} == {"und"}


def test_without_labels_documents_with_letters_stay(spark):
    docs = spark.createDataFrame([(1, "wörter", None), (2, "12 !", None), (3, None, None)],
                                 "doc_id long, text string, lang string")
    left = language_id.drop_unidentified(docs)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [1]

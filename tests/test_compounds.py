"""G05 over all documents and any number of compounds, against a plain loop."""

import random
from collections import Counter

import pytest

from tessera import registry
from tessera.functions import text as TX
from tessera.operators import compounds as C

from .conftest import SF_SMALL


def _merged(tokens, lexicon):
    out, i = [], 0
    while i < len(tokens):
        pair = tuple(tokens[i:i + 2])
        out.append("_".join(pair) if pair in lexicon else tokens[i])
        i += len(pair) if pair in lexicon else 1
    return out


def test_merge_pairs_left_to_right(spark):
    lexicon = {("new", "york"), ("york", "city"), ("a", "a"), ("city", "new")}
    texts = [["new", "york", "city", "new", "york"], [], ["a"], ["a"] * 5, ["york", "city", "x", "new"], None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, tokens array<string>")
    lex = spark.createDataFrame(sorted(lexicon), "a string, b string")
    got = {r.id: (r.merged, r.n_tokens) for r in C.merged_pairs(df, lex).collect()}
    want = {i: _merged(t or [], lexicon) for i, t in enumerate(texts)}
    assert got == {i: (" ".join(t), len(t)) for i, t in want.items()}


@pytest.mark.parametrize("most", [500_000, 0])
def test_pairs_frequent_only_in_some_chunks_are_found(spark, monkeypatch, most):
    """Tiny chunks; candidates counted through a broadcast and by a join."""
    monkeypatch.setattr(C, "CHUNK_TOKENS", 20)
    monkeypatch.setattr(C, "MOST_CANDIDATES", most)
    rng = random.Random(2)
    texts = [[rng.choice("abcdefgh") for _ in range(rng.randrange(30))] for _ in range(300)]
    texts += [["rare", "pair"] * 20, None, ["x"]]
    df = spark.createDataFrame([(t,) for t in texts], "tokens array<string>").repartition(3)
    counts = Counter(p for t in texts for p in zip(t or [], (t or [])[1:]))
    least = max(2, sum(counts.values()) * 0.015)
    got = {(r.a, r.b): r.n for r in C.frequent_pairs(df, 0.015).collect()}
    assert got == {p: n for p, n in counts.items() if n >= least} and got


def test_all_frequent_pairs_are_merged_in_all_texts(spark):
    tables = registry._t(spark, SF_SMALL)
    tokens = TX.split_words(TX.clean_full("text")).alias("tk")
    docs = {("documents", r.doc_id): r.tk for r in tables.documents.select("doc_id", tokens).collect()}
    rest = {("benchmark", r.item_id): r.tk for r in tables.benchmark.select("item_id", tokens).collect()}
    counts = Counter(p for t in docs.values() for p in zip(t or [], (t or [])[1:]))
    least = max(2, sum(counts.values()) * 1e-4)
    lexicon = {p for p, n in counts.items() if n >= least}
    assert len(lexicon) > 50
    got = {(r.source, r.id): (r.tokens, r.n_tokens)
           for r in registry.QUERIES["g05_compound_merge"](spark, SF_SMALL).collect()}
    want = {k: _merged(t or [], lexicon) for k, t in (docs | rest).items()}
    assert got == {k: (" ".join(t), len(t)) for k, t in want.items()}

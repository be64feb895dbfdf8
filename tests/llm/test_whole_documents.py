"""The mix as documents takes copies whole, with their texts untouched."""

from collections import Counter, defaultdict

from tessera.llm import mixing


def test_texts_are_whole_and_targets_met_within_a_document(spark):
    long = "one\t two\n\n three  " * 400
    rows = [(i, f"line {i}\n\tof  text " * (i % 7 + 1), f"s{i % 5}") for i in range(200)]
    rows += [(1000, long, "long"), (1001, long + "end", "long"), (1002, None, "long"),
             (1003, "x", None), (1004, " \n", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    texts = {r[0]: r[1] for r in rows}
    got = mixing.mixed_documents(docs).collect()
    assert all(r.text == texts[r.doc_id] for r in got)
    assert max(Counter(r.doc_id for r in got).values()) <= mixing.MAX_REPEATS

    taken, words, target, largest = Counter(), Counter(), {}, defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r.doc_id], target[r.source] = r.taken, r.target
        largest[r.source] = max(largest[r.source], r.size)
    for r in got:
        words[r.source] += len(r.text.split())
    assert {i for i, n in taken.items() if n} <= {r.doc_id for r in got}
    for source, t in target.items():
        assert t - 1e-6 <= words[source] < t + largest[source]

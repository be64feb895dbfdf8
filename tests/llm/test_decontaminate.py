"""Operator 13 against brute force, and its odd inputs."""

import hashlib
import random
import re

import pytest

from tessera.llm import decontaminate as D

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    held = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            held.setdefault(tuple(w[i:i + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in held}:
            for i in range(len(w) - n + 1):
                ids = held.get(tuple(w[i:i + n]))
                if ids:
                    found |= ids
                    hit.update(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def result(spark, docs, items, most=D.MAX_WINDOWS):
    got = D.contamination(spark.createDataFrame(docs, DOCS).repartition(3),
                          spark.createDataFrame(items, ITEMS), most)
    return sorted((tuple(r)[:6] for r in got.collect()), key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = ["der", "Ünd", "a", "b2", "C", "naïve", "42", "x" * 40]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "`", "_"])
                       for _ in range(n))

    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(25)]
    docs = [(i, text(rng.randrange(60)) + rng.choice([t for _, t in items]) + text(rng.randrange(9)))
            for i in range(60)]
    return docs, items


@pytest.mark.parametrize("most", [D.MAX_WINDOWS, 60])
def test_equals_brute_force_in_one_part_or_many(spark, most):
    docs, items = case(1)
    assert result(spark, docs, items, most) == brute(docs, items)


def test_odd_rows(spark):
    ten = "one two three four five six seven eight nine ten"
    items = [(1, ten), (1, ten + " more"), (2, None), (3, ""), (4, "... --"), (None, "lonely"),
             (5, "LONELY"), (10, ten.upper())]
    docs = [(1, None), (2, ""), (3, "!!"), (None, ten), (4, ten.replace(" ", "--")), (4, ten),
            (5, "one two three four five six seven eight nine"), (6, "so lonely"),
            (7, "ten " + ten + " one"), (8, ten + " x " * 500_000 + ten), (9, ten[:-3] + "Ten")]
    got = result(spark, docs, items)
    assert got == brute(docs, items)
    assert [r[3] for r in got if r[0] == 6] == [2]


def test_empty_tables(spark):
    docs, items = [(1, "some text"), (2, None)], [(1, "some text")]
    assert result(spark, docs, []) == brute(docs, [])
    assert result(spark, [], items) == []


def test_spans_and_masks_name_the_original_text(spark):
    item = "Größe zählt eins zwei drei vier fünf sechs sieben acht neun"
    text = "Ä vor: " + item.upper().replace("Ö", "ö").replace("Ä", "ä").replace("Ü", "ü").replace(
        " ", " - ") + "! nach"
    items = spark.createDataFrame([(1, item)], ITEMS)
    docs = spark.createDataFrame([(1, text, "a", 3), (2, "rein", None, 4), (3, None, "c", 5)],
                                 DOCS + ", items string, n_words int")
    # ß has no upper case of its own: write it back
    docs = docs.replace(text, text.replace("GRöSSE", "GRößE"))
    text = text.replace("GRöSSE", "GRößE")
    row = D.contamination(docs, items).filter("doc_id = 1").first()
    (span,) = row["spans"]
    assert text[span["char_first"]:span["char_end"]].startswith("GRößE")
    assert text[span["char_end"]:] == "! nach"
    clean = D.masked(docs, items, mask="[]")
    assert clean.columns == docs.columns
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert rows[1]["text"] == "Ä vor: []! nach" and rows[1]["n_words"] == 3
    assert rows[2]["text"] == "rein" and rows[3]["text"] is None and rows[3]["items"] == "c"
    assert D.contamination(clean, items).filter("contaminated").count() == 0


def test_a_passage_in_a_third_of_all_documents(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(i, passage if i % 3 == 0 else f"clean text number {i}") for i in range(900)]
    got = result(spark, docs, [(i, passage) for i in range(12)])
    assert sum(r[5] for r in got) == 300 and {r[3] for r in got} == {0, 12}

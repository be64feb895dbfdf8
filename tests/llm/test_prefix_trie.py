"""Operator 12 against a plain trie, for many and few shards."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
         "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0], t[1], digest(t[2], t[3])[:16]))
        own[c] = [t[2:] for t in turns]
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20
        built[c] = own.get(c - base, [])[:h] + turns[h:]
    member = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            member.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for path in member:
        if path:
            kids.setdefault(path[:-1], []).append(path)

    def below(path):
        leaves, saved = (0 if path in kids else 1), 0
        if path:
            saved = (len(member[path]) - 1) * len(path[-1][1].split())
        for x in kids.get(path, []):
            more = below(x)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for path, convs in member.items():
        ends = sorted(c for c in convs if len(built[c]) == len(path))
        out.append((min(convs), len(path), min(member[path[:-1]]) if path else None, len(convs),
                    len(kids.get(path, [])), *below(path),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, shard_turns=100_000):
    got = T.trie(T.rebuilt(spark.createDataFrame(rows, SCHEMA)), shard_turns)
    assert got.columns == NAMES
    return sorted(map(tuple, got.collect()), key=str)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 1, 2, 3, 4, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]),
                         rng.choice(["a b", "c", "", None, "d e f"])))
    return rows


@pytest.mark.parametrize("shard_turns", [100_000, 40, 5])
def test_equals_a_plain_trie(spark, shard_turns):
    rows = conversations(1, 300)
    assert result(spark, rows, shard_turns) == brute(rows)


def test_a_large_group_of_equal_conversations_spans_shards(spark, monkeypatch):
    monkeypatch.setattr(T, "ENDS", 7)
    rows = [(c, t, "user", f"w{t}") for c in range(400) for t in range(2)]
    rows += [(c, 0, "user", f"x {c}") for c in range(400, 500)]
    cuts = T.splitters(T.paths(T.rebuilt(spark.createDataFrame(rows, SCHEMA))), 20)
    paths = [p for p, _, _ in cuts]
    assert max(paths.count(p) for p in paths) > 3        # equal paths, cut by conv_id
    assert result(spark, rows, 30) == brute(rows)


def test_a_long_conversation(spark):
    rows = [(c, t, "user", f"w{t} {c if t == 300 else ''}") for c in (0, 20, 40) for t in range(400)]
    assert result(spark, rows, 50) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a"), (5, None, "user", "first"), (5, 1, "user", "b"),
            (5, 1, "user", "b"), (5, 1, "assistant", "b"), (-21, 3, None, None),
            (-20, 3, "", ""), (25, 2, "user", "only"), (27, 0, "user", "x y " * 20_000)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, 1) == brute(rows)


def test_role_and_text_are_kept_apart(spark):
    rows = spark.createDataFrame([(0, 0, "ab", "c"), (20, 0, "a", "bc")], SCHEMA)
    assert rows.select(T.turn_key(F.col("role"), F.col("text"))).distinct().count() == 2


def test_empty_table_and_clashing_columns(spark):
    assert result(spark, []) == []
    rows = spark.createDataFrame([(0, 0, "u", "a", "x", 3)], SCHEMA + ", path string, turns int")
    assert T.conversation_trie(rows).count() == 2

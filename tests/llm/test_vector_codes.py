"""Operator 11 against brute force, and its odd inputs."""

import hashlib

import numpy as np
import pytest

from tessera.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("n, width, entries, scale",
                         [(1, 1, 1, 3), (63, 2, 256, 2), (700, 16, 200, 300),
                          (3000, 16, 256, 40), (2000, 5, 90, 1 << 27), (900, 3, 256, 1)])
def test_trees_assign_as_brute_force_does(n, width, entries, scale):
    rng = np.random.default_rng(n)
    x = rng.integers(-scale, scale + 1, (n, width)).astype("<i4")
    x = x[V.arranged(x, V.LEAF)]
    codebook = x[rng.integers(0, n, entries)].astype(np.int64)       # equal entries tie
    block = V.Block(x, *V.boxes(x, V.LEAF), V.node_sums(x, V.LEAF))
    total, count, label = block.assign(V.Entries(codebook), points=True)
    want = ((x[:, None].astype(np.int64) - codebook[None]) ** 2).sum(2).argmin(1)
    sums = np.zeros((entries, width), np.int64)
    np.add.at(sums, want, x.astype(np.int64))
    assert (label == want).all()
    assert (sums[:len(total)] == total).all() and not sums[len(total):].any()
    assert (np.bincount(want, minlength=entries)[:len(count)] == count).all()


def test_whole_nodes_and_dropped_pairs_are_used():
    """Well separated clusters need no comparison of single points."""
    rng = np.random.default_rng(3)
    centres = np.arange(16)[:, None] * np.full((1, 4), 1000)
    x = (np.repeat(centres, 64, 0) + rng.integers(-5, 6, (1024, 4))).astype("<i4")
    x = x[V.arranged(x, V.LEAF)]
    block = V.Block(x, *V.boxes(x, V.LEAF), V.node_sums(x, V.LEAF))
    block._compared = None                                            # would fail
    assert sorted(block.assign(V.Entries(centres), points=False)[1].tolist()) == [64] * 16


def brute(rows):
    kept = [(i, [x for x in v], lab) for i, v, lab in rows if v is not None
            and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    length = -(-max(len(v) for _, v, _ in kept) // 4) * 4
    ints = [[int(np.floor(1024 * float(np.float32(x)))) for x in v] + [0] * (length - len(v))
            for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, ints[k]))
    x = np.array(ints, np.int64).reshape(len(kept), 4, length // 4).transpose(1, 0, 2)
    books = x[:, order[:256]].copy()
    for round_ in range(5):
        near = [((x[p][:, None] - books[p][None]) ** 2).sum(2) for p in range(4)]
        to = [d.argmin(1) for d in near]
        if round_ == 4:
            break
        for p in range(4):
            for e in set(to[p].tolist()):
                own = x[p][to[p] == e]
                books[p][e] = own.sum(0) // len(own)
    error = sum(d.min(1) for d in near)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    labels = [lab for _, _, lab in kept]
    return [(kept[k][0], "".join(f"{to[p][k]:02x}" for p in range(4)), int(error[k]),
             int(sum(e for e, lab in zip(error, labels) if lab == labels[k])), digest)
            for k in range(len(kept))]


def result(spark, rows):
    got = V.vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=12).astype("f4").tolist(), int(i) % 3 if i % 7 else None)
            for i in rng.permutation(700)]
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0, None, 0.0, 0.0], 1), (3, [nan, 0.0, 0.0, 0.0], 1),
            (4, [inf, 0.0, 0.0, 0.0], None), (5, [0.5, -0.5, 0.001, -0.001], None),
            (5, [0.5, -0.5, 0.001, -0.001], None), (None, [2.0, 1.0, 1.0, 1.0], 2),
            (6, [0.25], 2), (7, [], 2), (8, [1.0, 2.0, 3.0, 4.0, 5.0], 2)]
    got = result(spark, rows)
    assert got == sorted(brute(rows), key=str) and len(got) == 6


def test_huge_components_are_held(spark):
    rows = [(1, [3e38] * 8, 1), (2, [-3e38] * 8, 1), (3, [0.0] * 8, 1), (4, [3e38] * 8, None)]
    got = {r[0]: r for r in result(spark, rows)}
    assert got[1][1] == got[4][1] and len({r[1] for r in got.values()}) == 3
    assert all(r[2] >= 0 for r in got.values())


def test_empty_table_and_clashing_columns(spark):
    assert result(spark, []) == []
    rows = spark.createDataFrame([(1, [1.0] * 4, 1, 2, "x")], SCHEMA + ", code int, points string")
    assert V.vector_codes(rows).count() == 1


def test_rows_do_not_depend_on_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).astype("f4").tolist(), i % 2) for i in range(500)]
    whole = result(spark, rows)
    monkeypatch.setattr(V, "BLOCK_VALUES", 600)
    assert result(spark, rows) == whole

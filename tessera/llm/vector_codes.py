r"""Operator 11: product-quantised vector codes by a dual-tree Lloyd.

A vector's components become integers, ``floor(1024 * x)``, and the vector is
cut into four consecutive parts; each part position has a codebook of up to
256 entries that starts with the parts of the smallest ids and is moved by
four Lloyd rounds.  All arithmetic is exact on integers, so results do not
depend on the order of rows or tasks.

Vectors are written once as blocks.  A block holds, for every part position, a
balanced k-d tree over its parts with each node's box, sum and size.  A round
broadcasts the codebooks (4 x 256 entries) and every task walks, level by level,
the pairs of a block's nodes and the nodes of a tree over the entries:

* a pair is dropped if its least distance is above the largest distance from
  the node to some other entry node (box bounds, strictly, so ties stay);
* an entry is dropped if another one is nearer to every point of the node's
  box (the difference of the two distances is linear, so a corner decides);
* a node with one entry left is assigned as a whole through its cached sum;
* the points of a leaf with several entries left are compared one by one.

Tasks return sums and counts per (part, entry, position), which Spark adds up;
the driver sees only those 4 x 256 entries.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped; shorter vectors, and lengths that four does not divide,
are filled up with zeros; integers are held within ``sqrt(2^60 / part length)``
(components within +-262,144 for 64 dimensions), so that distances fit a long;
rows with a null vec_id come after all others, equal ids in the order of their
integers; repeated rows count separately; sums beyond a long end at its
largest value; fewer than 256 rows give a smaller codebook; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Points of a leaf of a block's tree, entries of a leaf of the entry tree.
LEAF = 64
ENTRY_LEAF = 4
#: Components of a block.
BLOCK_VALUES = 1 << 20
MOST = (1 << 63) - 1


def usable(table: DataFrame) -> DataFrame:
    """The rows whose vector is whole and finite."""
    return table.filter(F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def integers(vector: Column, length: int) -> Column:
    """The components as held integers, filled up to *length* with zeros."""
    most = float(held_within(length))
    whole = F.transform(vector, lambda x: F.floor(
        F.greatest(F.least(x.cast("double") * SCALE, F.lit(most)), F.lit(-most))).cast("int"))
    return F.concat(whole, F.array_repeat(F.lit(0), F.lit(length) - F.size(whole)))


def held_within(length: int) -> int:
    return int(((1 << 60) * PARTS // max(length, PARTS)) ** 0.5)


# Trees ---------------------------------------------------------------------------
def levels(n: int, leaf: int) -> int:
    return max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))


def cuts(n: int, level: int) -> np.ndarray:
    """First points of the nodes of a level, and the end."""
    return (np.arange((1 << level) + 1) * n) >> level


def arranged(x: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the points in which every node of every level is a run: each
    node is halved at the median of its widest component."""
    order = np.arange(len(x))
    for level in range(levels(len(x), leaf)):
        edge, half = cuts(len(x), level), cuts(len(x), level + 1)[1::2]
        for a, m, b in zip(edge[:-1].tolist(), half.tolist(), edge[1:].tolist()):
            own = x[order[a:b]]
            wide = int(np.argmax(own.max(0) - own.min(0))) if own.shape[1] else 0
            if own.shape[1]:
                order[a:b] = order[a:b][np.argpartition(own[:, wide], m - a)]
    return order


def boxes(x: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest components of all nodes, root first, level by level."""
    if not len(x):
        return x, x
    low, high = [], []
    for level in range(levels(len(x), leaf) + 1):
        edge = cuts(len(x), level)[:-1]
        low.append(np.minimum.reduceat(x, edge, axis=0))
        high.append(np.maximum.reduceat(x, edge, axis=0))
    return np.concatenate(low), np.concatenate(high)


def node_sums(x: np.ndarray, leaf: int) -> np.ndarray:
    return np.concatenate([np.add.reduceat(x.astype(np.int64), cuts(len(x), level)[:-1], axis=0)
                           for level in range(levels(len(x), leaf) + 1)])


class Entries:
    """The tree over one codebook; entries that equal an earlier one are left
    out, since the earlier one wins every tie."""

    def __init__(self, codebook: np.ndarray):
        _, first = np.unique(codebook, axis=0, return_index=True)
        first = np.sort(first)
        distinct = codebook[first]
        order = arranged(distinct, ENTRY_LEAF)
        self.index, self.x = first[order], distinct[order]
        self.depth = levels(len(self.x), ENTRY_LEAF)
        self.low, self.high = boxes(self.x, ENTRY_LEAF)

    def box(self, down: int, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Boxes of nodes of a level; a single entry is a box of its own."""
        if down > self.depth:
            return self.x[other], self.x[other]
        return self.low[_at(down, other)], self.high[_at(down, other)]

    def children(self, node: np.ndarray, other: np.ndarray, down: int
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with the children of their entry nodes; below the last level,
        with its single entries."""
        if down < self.depth:
            return np.repeat(node, 2), np.stack([2 * other, 2 * other + 1], 1).ravel()
        edge = cuts(len(self.x), self.depth)
        each = edge[other + 1] - edge[other]
        shift = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        return np.repeat(node, each), np.repeat(edge[other], each) + shift


class Block:
    """The tree over one part of a block."""

    def __init__(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.x, self.low, self.high, self.sums = x, low, high, sums
        self.depth = levels(len(x), LEAF)

    def assign(self, entries: Entries, points: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums and counts by entry index, and, if *points* is set, the entry
        index of every point."""
        n, width = self.x.shape
        most = int(entries.index.max()) + 1
        total, count = np.zeros((most, width), np.int64), np.zeros(most, np.int64)
        label = np.full(n if points else 0, -1, np.int64)
        node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)   # pairs, by node
        level = down = 0
        while len(node):
            single = down > entries.depth
            keep = self._in_reach(level, node, *entries.box(down, other))
            node, other = node[keep], other[keep]
            if not single:
                node, other = entries.children(node, other, down)
                down += 1
            else:
                keep = self._not_beaten(level, node, entries, other)
                node, other = node[keep], other[keep]
                edge = cuts(n, level)
                first, each = _runs(node)
                whole = first[each == 1]
                held, to = node[whole], entries.index[other[whole]]
                np.add.at(total, to, self.sums[_at(level, held)])
                np.add.at(count, to, edge[held + 1] - edge[held])
                if points:
                    for k, own in zip(to.tolist(), held.tolist()):
                        label[edge[own]:edge[own + 1]] = k
                if level == self.depth:
                    for at, many in zip(first[each > 1].tolist(), each[each > 1].tolist()):
                        a, b = edge[node[at]], edge[node[at] + 1]
                        to = self._compared(a, b, entries, other[at:at + many])
                        np.add.at(total, to, self.x[a:b].astype(np.int64))
                        count += np.bincount(to, minlength=most)
                        if points:
                            label[a:b] = to
                    break
                more = np.repeat(each > 1, each)
                node, other = node[more], other[more]
            if level < self.depth:
                level += 1
                node, other = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other])
                order = np.argsort(node, kind="stable")
                node, other = node[order], other[order]
        return total, count, label

    def _in_reach(self, level: int, node: np.ndarray, low: np.ndarray, high: np.ndarray
                  ) -> np.ndarray:
        """Pairs whose least distance is no more than the least of their
        node's largest distances."""
        a, b = (x[_at(level, node)].astype(np.int64) for x in (self.low, self.high))
        gap = np.maximum(np.maximum(low - b, a - high), 0)
        far = np.maximum(high - a, b - low)
        least, largest = (gap * gap).sum(1), (far * far).sum(1)
        first, each = _runs(node)
        return least <= np.repeat(np.minimum.reduceat(largest, first), each)

    def _not_beaten(self, level: int, node: np.ndarray, entries: Entries, other: np.ndarray
                    ) -> np.ndarray:
        """Pairs whose entry is not beaten everywhere in the node's box by the
        entry nearest to the middle of the box."""
        a, b = (x[_at(level, node)].astype(np.int64) for x in (self.low, self.high))
        x = entries.x[other].astype(np.int64)
        middle = 2 * x - a - b
        near = (middle * middle).sum(1) if _fits(entries.x, self.x, 16) else \
            (middle.astype(float) ** 2).sum(1)
        first, each = _runs(node)
        best = np.lexsort((near, node))[first]           # the nearest pair of each node
        rival = np.repeat(best, each)
        step = x - x[rival]
        # |p - x|^2 - |p - rival|^2 at the corner where it is least
        least = (x * x).sum(1) - (x[rival] ** 2).sum(1) - 2 * np.where(step > 0, b * step, a * step).sum(1)
        index = entries.index[other]
        beaten = (least > 0) | ((least == 0) & (index > index[rival]))
        return ~beaten | (rival == np.arange(len(node)))

    def _compared(self, a: int, b: int, entries: Entries, other: np.ndarray) -> np.ndarray:
        """The nearest of the entries for each point, lower indexes first."""
        other = other[np.argsort(entries.index[other])]
        kind = np.float64 if _fits(entries.x, self.x, 4, 53) else np.int64   # exact in either
        x, c = self.x[a:b].astype(kind), entries.x[other].astype(kind)
        return entries.index[other][((c * c).sum(1) - 2 * x @ c.T).argmin(1)]


def _fits(x: np.ndarray, y: np.ndarray, times: int, bits: int = 62) -> bool:
    """Whether *times* squared differences fit so many bits."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    return times * max(x.shape[1], 1) * most * most < 1 << bits


def _at(level: int, node: np.ndarray) -> np.ndarray:
    """Places of a level's nodes among all nodes."""
    return (1 << level) - 1 + node


def _runs(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First pair and number of pairs of each node."""
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    return first, np.diff(np.r_[first, len(node)])


# Spark ---------------------------------------------------------------------------
TREE = ("points", "low", "high", "sums")


def blocks(rows: DataFrame, length: int) -> DataFrame:
    """One row per block of *rows* (vec_id, label, v): its ids and labels, and
    for each part the points in tree order with their rows and the tree."""
    width = length // PARTS
    ids, labels = rows.schema["vec_id"].dataType, rows.schema["label"].dataType
    most = max(LEAF, BLOCK_VALUES // max(length, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                part = batch.slice(start, most)
                n = part.num_rows
                v = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, length)
                order, tree = [], {k: [] for k in TREE}
                for p in range(PARTS):
                    x = np.ascontiguousarray(v[:, p * width:(p + 1) * width], "<i4")
                    order.append(arranged(x, LEAF).astype("<i4"))
                    x = x[order[-1]]
                    low, high = boxes(x, LEAF)
                    for k, values in zip(TREE, (x, low, high, node_sums(x, LEAF))):
                        tree[k].append(values.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [_one_list(part.column(0)), _one_list(part.column(1)),
                     pa.array([[o.tobytes() for o in order]], pa.list_(pa.binary())),
                     *(pa.array([tree[k]], pa.list_(pa.binary())) for k in TREE)],
                    names=["ids", "labels", "order", *TREE])

    return rows.select("vec_id", "label", "v").mapInArrow(
        run, f"ids array<{ids.simpleString()}>, labels array<{labels.simpleString()}>, "
             "order array<binary>, " + ", ".join(f"{k} array<binary>" for k in TREE))


def _one_list(column: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def _trees(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, Block]]:
    """(row of the batch, part, tree)"""
    for row in range(batch.num_rows):
        n = len(batch.column("ids")[row])
        held = [batch.column(k)[row].as_py() for k in TREE]
        for p in range(PARTS):
            x, low, high = (np.frombuffer(h[p], "<i4") for h in held[:3])
            nodes = (2 << levels(n, LEAF)) - 1
            yield row, p, Block(x.reshape(n, width), low.reshape(nodes, width),
                                high.reshape(nodes, width),
                                np.frombuffer(held[3][p], "<i8").reshape(nodes, width))


def moved(trees: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after a Lloyd round over all blocks."""
    parts, k, width = codebooks.shape
    shared = trees.sparkSession.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Entries(c) for c in shared.value]
        total = np.zeros((parts, k, width + 1), np.int64)     # sums, then the count
        for batch in batches:
            for _, p, tree in _trees(batch, width):
                sums, count, _ = tree.assign(entries[p], points=False)
                total[p, :len(sums), :width] += sums
                total[p, :len(sums), width] += count
        p, entry, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(entry, pa.int32()), pa.array(at, pa.int32()),
             pa.array(total[p, entry, at])], names=["part", "entry", "at", "s"])

    rows = (trees.select("ids", *TREE).mapInArrow(run, "part int, entry int, at int, s long")
            .groupBy("part", "entry", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
            .collect())
    total = np.zeros((parts, k, width + 1), object)
    for r in rows:
        total[r["part"], r["entry"], r["at"]] = int(r["s"])
    out = codebooks.copy()
    used = total[:, :, width] > 0
    out[used] = total[used][:, :width] // total[used][:, width:]
    return out


def coded(trees: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row of the blocks."""
    width = codebooks.shape[2]
    shared = trees.sparkSession.sparkContext.broadcast(codebooks)
    kinds = [trees.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [Entries(c) for c in shared.value]
        for batch in batches:
            for row, p, tree in _trees(batch, width):
                if p == 0:
                    n = len(tree.x)
                    codes, error = np.zeros((n, PARTS), np.uint8), np.zeros(n, np.int64)
                order = np.frombuffer(batch.column("order")[row][p].as_py(), "<i4")
                label = tree.assign(entries[p], points=True)[2]
                codes[order, p] = label
                gap = tree.x.astype(np.int64) - shared.value[p][label]
                error[order] += (gap * gap).sum(1)
                if p == PARTS - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[row].values, batch.column("labels")[row].values,
                         pa.array([c.tobytes().hex() for c in codes], pa.string()),
                         pa.array(error)], names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(
        run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def vector_codes(table: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error,
    codebooks_sha256."""
    rows = usable(table.select("vec_id", "embedding", "label"))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    length = -(-longest // PARTS) * PARTS
    rows = rows.select("vec_id", "label", integers(F.col("embedding"), length).alias("v"))
    first = (rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v")
             .limit(ENTRIES).collect())
    x = np.array([r["v"] for r in first], np.int64).reshape(len(first), PARTS, length // PARTS)
    codebooks = np.ascontiguousarray(x.transpose(1, 0, 2))
    trees = materialise(blocks(rows, length), "blocks")
    if len(first):
        for _ in range(ROUNDS):
            codebooks = moved(trees, codebooks)
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    out = materialise(coded(trees, codebooks), "codes")
    by_label = out.groupBy(F.col("label").alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)"))
        .cast("long").alias("label_error"))
    return (out.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error",
                    F.lit(digest).alias("codebooks_sha256")))


def _oracle() -> str:
    parts = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r, vec_id, label, list_transform(
           embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, part, v[part * (len(v) // {PARTS}) + 1:(part + 1) * (len(v) // {PARTS})] AS x
  FROM kept CROSS JOIN (SELECT unnest(range({PARTS})) AS part)),
b0 AS MATERIALIZED (SELECT part, r AS entry, x FROM p WHERE r < {ENTRIES})"""
    near = """
a{n} AS MATERIALIZED (
  SELECT r, part, any_value(x) AS x, min(d) AS d, arg_min(entry, d * 1000 + entry) AS entry
  FROM (SELECT p.r, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.x),
               lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM p JOIN b{n} b ON p.part = b.part)
  GROUP BY r, part)"""
    move = """
m{n} AS (
  SELECT part, entry, pos, CAST(floor(sum(x[pos]) / count(*)) AS BIGINT) AS c
  FROM a{o} CROSS JOIN (SELECT unnest(range(1, (SELECT any_value(len(x)) FROM p) + 1)) AS pos)
  GROUP BY part, entry, pos),
b{n} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.x, b.x) AS x
  FROM b{o} b LEFT JOIN (SELECT part, entry, list(c ORDER BY pos) AS x FROM m{n} GROUP BY part, entry) m
       ON b.part = m.part AND b.entry = m.entry)"""
    steps = [parts]
    for n in range(ROUNDS + 1):
        steps += [move.format(n=n, o=n - 1)] if n else []
        steps.append(near.format(n=n))
    return ",".join(steps) + f""",
books AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM b{ROUNDS})),
e AS (
  SELECT r, CAST(sum(d) AS BIGINT) AS error,
         string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code
  FROM a{ROUNDS} GROUP BY r),
l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM kept JOIN e USING (r) GROUP BY label)
SELECT k.vec_id, e.code, e.error, l.label_error, books.codebooks_sha256
FROM kept k JOIN e ON k.r = e.r JOIN l ON k.label IS NOT DISTINCT FROM l.label CROSS JOIN books
"""


#: Vectors of one length; integers that are not held.
ORACLE = _oracle()

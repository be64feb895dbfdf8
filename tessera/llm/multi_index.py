"""Operator 5: nearest neighbours through an inverted multi-index.

Each vector half has its own k-means codebook (numpy, on a bounded sample); a
vector is indexed under its pair of nearest centroids.  A query walks the
centroid pairs by the sum of its two half distances with a heap until the
visited cells hold enough entries, and those entries are ranked by their exact
Euclidean distance in double precision.

How many entries are enough is measured, not guessed: for a few hash-chosen
queries the true neighbours among *all* rows are found by brute force, and the
walk length that reaches ``recall`` of them is used for every query.

Equal vectors are one entry with its k + 1 smallest ids (no answer can need
more), equal queries are searched once.  Entries are grouped by first-half
centroid, large groups are split into chunks, and a query is sent to the
chunks of the cells it visits; each chunk returns its best k + 1.

Defined results: vectors that are null, zero, of another length than most, or
that hold null or non-finite components take no part, and neither do null ids;
rows with the same id and vector are one; with k or fewer candidates all are
returned; ties go to the smaller id; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise

K = 10
EVERY = 100
RECALL = 0.96
SAMPLE = 16_384
TUNING_QUERIES = 64
CHUNK_ROWS = 20_000
SALTS = 32


def valid_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, vec): usable rows, the vector as little-endian doubles."""
    element = F.col("embedding")
    usable = table.filter(
        F.col("vec_id").isNotNull() & element.isNotNull()
        & F.forall(element, lambda x: x.isNotNull() & ~F.isnan(x)
                   & (F.abs(x) < float("inf")))
        & F.exists(element, lambda x: x != 0))
    usable = usable.select("vec_id", element.cast("array<double>").alias("embedding"))
    usual = (usable.groupBy(F.size("embedding").alias("n")).count()
             .orderBy(F.desc("count"), "n").limit(1).select("n").first())
    usable = usable.filter(F.size("embedding") == (usual[0] if usual else 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            # -0.0 and 0.0 are one value
            rows = (flat.reshape(batch.num_rows, -1) + 0.0).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()),
                 pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "vec"])

    return usable.mapInArrow(pack, "vec_id long, vec binary")


def distinct_entries(vectors: DataFrame, most: int) -> DataFrame:
    """(vec, ids): one row per distinct vector with its *most* smallest ids.
    Ids are cut per input batch, then per salt, then per vector, so no list
    grows with the size of a group."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[bytes, set[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own.setdefault(v, set()).add(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(own), pa.binary()),
                 pa.array([sorted(x)[:most] for x in own.values()], pa.list_(pa.int64()))],
                names=["vec", "ids"])

    def least(column):
        return F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(column)))), 1, most)

    rows = vectors.mapInArrow(local, "vec binary, ids array<long>")
    salted = rows.withColumn("_salt", F.spark_partition_id() % SALTS)
    return (salted.groupBy("vec", "_salt").agg(least("ids").alias("ids"))
            .groupBy("vec").agg(least("ids").alias("ids")))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(centres))
        used = count > 0
        centres[used] = total[used] / count[used, None]
    return centres


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None]
                      - 2 * x @ centres.T, 0)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squared(x, centres).argmin(1)


@dataclass
class Index:
    """Two codebooks and the number of entries in each cell."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.first.shape[1]], x[:, self.first.shape[1]:]

    def walk(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells by ascending sum of half distances (multi-sequence heap)."""
        a, b = self.halves(query[None])
        da, db = squared(a, self.first)[0], squared(b, self.second)[0]
        oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
        sa, sb = da[oa].tolist(), db[ob].tolist()
        oa, ob = oa.tolist(), ob.tolist()
        heap, reached = [(sa[0] + sb[0], 0, 0)], [-1] * (len(oa) + 1)
        # Row r may advance to column c once row r - 1 has passed it.
        while heap:
            _, r, c = heapq.heappop(heap)
            reached[r] = c
            yield oa[r], ob[c]
            if c + 1 < len(ob) and (r == 0 or reached[r - 1] > c):
                heapq.heappush(heap, (sa[r] + sb[c + 1], r, c + 1))
            if r + 1 < len(oa) and reached[r + 1] == c - 1:
                heapq.heappush(heap, (sa[r + 1] + sb[c], r + 1, c))

    def cells(self, query: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """Non-empty cells of the walk until they hold *enough* entries."""
        out, held = [], 0
        for i, j in self.walk(query):
            n = self.counts[i, j]
            if n:
                out.append((i, j))
                held += n
                if held >= enough:
                    break
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - query[None]) ** 2).sum(1))


def best(query: np.ndarray, rows: np.ndarray, lists: list[list[int]], most: int
         ) -> list[tuple[float, int]]:
    """The *most* nearest (score, id) of the rows, exactly, ties by id."""
    if len(rows) > 4 * most:
        rough = squared(rows, query[None])[:, 0]
        edge = np.partition(rough, most - 1)[most - 1]
        keep = np.flatnonzero(rough <= edge + 1e-9 * (1 + edge + (query * query).sum()))
    else:
        keep = np.arange(len(rows))
    scores = exact(query, rows[keep])
    found = [(s, i) for s, at in zip(scores.tolist(), keep.tolist()) for i in lists[at]]
    return sorted(found)[:most]


def build(entries: DataFrame, sample: int = SAMPLE, centroids: int | None = None
          ) -> tuple[Index, DataFrame]:
    """The index and its entries (vec, ids, i, j), a written table."""
    total = entries.count()
    rows = entries.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toPandas()
    x = _matrix(pa.array(rows["vec"].tolist(), pa.binary()))
    half = x.shape[1] // 2
    k = centroids or int(np.clip(np.sqrt(max(total, 1) / 12), 8, 1024))
    index = Index(kmeans(x[:, :half], k), kmeans(x[:, half:], k, seed=12))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = index.halves(_matrix(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest(a, index.first).astype(np.int32)),
                 pa.array(nearest(b, index.second).astype(np.int32))],
                names=["vec", "ids", "i", "j"])

    placed = materialise(entries.mapInArrow(assign, "vec binary, ids array<long>, i int, j int"),
                         "multi-index")
    counts = np.zeros((len(index.first), len(index.second)), np.int64)
    for i, j, n in placed.groupBy("i", "j").count().collect():  # at most 1024 x 1024 cells
        counts[i, j] = n
    index.counts = counts
    return index, placed


def walk_length(index: Index, placed: DataFrame, queries: DataFrame, k: int = K,
                recall: float = RECALL, tuning: int = TUNING_QUERIES) -> int:
    """Entries a query has to visit to meet *recall* of its true neighbours."""
    chosen = queries.orderBy(F.xxhash64("vec", F.lit("tune")), "vec").limit(tuning).toPandas()
    asked = _matrix(pa.array(chosen["vec"].tolist(), pa.binary()))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = squared(asked, _matrix(batch.column(0)))
            m = min(k + 1, d.shape[1])
            at = np.argpartition(d, m - 1, axis=1)[:, :m]
            q = np.repeat(np.arange(len(asked)), m)
            at = at.reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), pa.array(d[q, at]),
                 batch.column(1).take(pa.array(at)), batch.column(2).take(pa.array(at))],
                names=["q", "d", "i", "j"])

    near = (placed.select("vec", "i", "j").mapInArrow(brute, "q int, d double, i int, j int")
            .withColumn("_r", F.row_number().over(Window.partitionBy("q").orderBy("d")))
            .filter(F.col("_r") <= k + 1).collect())
    wanted: dict[int, list[tuple[int, int]]] = {}
    for r in near:
        wanted.setdefault(r["q"], []).append((r["i"], r["j"]))
    needed = []
    for q, cells in wanted.items():
        left, held = list(cells), 0
        for cell in index.walk(asked[q]):
            held += int(index.counts[cell])
            hits = left.count(cell)
            if hits:
                needed += [held] * hits
                left = [c for c in left if c != cell]
                if not left:
                    break
    return int(np.quantile(needed, recall, method="higher")) if needed else 1


def search(index: Index, placed: DataFrame, queries: DataFrame, enough: int, most: int
           ) -> DataFrame:
    """(vec, found): the *most* nearest (score, vec_id) of each distinct query."""
    per_block = index.counts.sum(1)
    chunks = np.maximum(1, -(-per_block // CHUNK_ROWS))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, chunk, vec, seconds = [], [], [], []
            for raw in batch.column(0).to_pylist():
                by_block: dict[int, list[int]] = {}
                for i, j in index.cells(np.frombuffer(raw, "<f8"), enough):
                    by_block.setdefault(i, []).append(j)
                for i, js in by_block.items():
                    for c in range(int(chunks[i])):
                        block.append(i)
                        chunk.append(c)
                        vec.append(raw)
                        seconds.append(js)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int32()), pa.array(chunk, pa.int32()),
                 pa.array(vec, pa.binary()), pa.array(seconds, pa.list_(pa.int32()))],
                names=["i", "chunk", "vec", "js"])

    split = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("i") + 1)
    dealt = placed.withColumn("chunk", F.pmod(F.xxhash64("vec"), split).cast("int"))
    asked = queries.mapInArrow(visits, "i int, chunk int, vec binary, js array<int>")
    cells = index.counts.shape[1]

    def rank(entries: pa.Table, visiting: pa.Table) -> pa.Table:
        vecs, found = [], []
        if entries.num_rows and visiting.num_rows:
            rows = _matrix(entries.column("vec").combine_chunks())
            j, lists = entries.column("j").to_numpy(), entries.column("ids").to_pylist()
            for raw, js in zip(visiting.column("vec").to_pylist(),
                               visiting.column("js").to_pylist()):
                open_cell = np.zeros(cells, bool)
                open_cell[js] = True
                at = np.flatnonzero(open_cell[j])
                vecs.append(raw)
                found.append([{"score": s, "vec_id": v} for s, v in best(
                    np.frombuffer(raw, "<f8"), rows[at], [lists[x] for x in at], most)])
        return pa.table([pa.array(vecs, pa.binary()), pa.array(found, pa.list_(pa.struct(
            [("score", pa.float64()), ("vec_id", pa.int64())])))], names=["vec", "found"])

    found = "array<struct<score:double,vec_id:bigint>>"
    partial = (dealt.groupBy("i", "chunk").cogroup(asked.groupBy("i", "chunk"))
               .applyInArrow(rank, f"vec binary, found {found}"))
    return partial.groupBy("vec").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, most).alias("found"))


def nearest_neighbours(table: DataFrame, k: int = K, every: int = EVERY,
                       recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id is divisible by *every*."""
    schema = "query_id long, rank int, vec_id long, score double"
    vectors = materialise(valid_vectors(table), "vectors")
    entries = materialise(distinct_entries(vectors, k + 1), "entries")
    asking = vectors.filter(F.col("vec_id") % every == 0).distinct()
    if asking.limit(1).count() == 0:
        return table.sparkSession.createDataFrame([], schema)
    queries = materialise(asking.select("vec").distinct(), "queries")
    index, placed = build(entries)
    enough = walk_length(index, placed, queries, k, recall)
    found = materialise(search(index, placed, queries, enough, k + 1), "found")
    other = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asking.withColumnRenamed("vec_id", "query_id").join(found, "vec")
            .select("query_id", F.posexplode(other).alias("_p", "_f"))
            .select("query_id", (F.col("_p") + 1).cast("int").alias("rank"),
                    F.col("_f.vec_id").alias("vec_id"), F.col("_f.score").alias("score")))

"""Dense vector spaces: PCA and LSI (truncated SVD) of TF-IDF, and exact
top-k search in those spaces (survey H08-H13).

The term space is bounded (the ``max_features`` most frequent terms), so the
PCA covariance / SVD Gram matrix is ``d × d`` with small ``d``.  Vectors are
held sparse, ``(id, terms, values)``, and made dense block by block inside the
tasks that multiply them.  Search scores every (query, document) pair
exactly, but never as rows: each document partition multiplies blocks of its
vectors with blocks of a bounded slice of the queries and keeps a running
top-k per query; a final top-k merges the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a broadcast slice of queries; rows and queries scored at a time.
QUERY_BYTES = 32 << 20
BLOCK_ROWS = 2048
BLOCK_QUERIES = 512
SCORE_DIGITS = 10


def term_places(docs: DataFrame, id_col: str, terms: list[str], tokens: Column) -> DataFrame:
    """``(id, terms array<int>, counts array<int>)``: which of *terms* (by place
    in that bounded list) a text holds, and how often.  Each task looks its
    texts' tokens up batch by batch; texts that share an id are brought
    together (their places may then repeat).  Ids without any term are left out."""
    kind = docs.schema[id_col].dataType.simpleString()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(terms, pa.string())
        for batch in batches:
            lists = batch.column("_t")
            place = pc.index_in(lists.flatten(), value_set=known)
            row = pc.list_parent_indices(lists).filter(place.is_valid()).to_numpy(zero_copy_only=False)
            place = place.drop_null().to_numpy(zero_copy_only=False)
            cell, n = np.unique(row.astype(np.int64) * len(terms) + place, return_counts=True)
            held, first = np.unique(cell // max(len(terms), 1), return_index=True)
            ends = pa.array(np.append(first, len(cell)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(held)),
                 pa.ListArray.from_arrays(ends, pa.array(cell % max(len(terms), 1), pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(n, pa.int32()))],
                names=["id", "terms", "counts"])

    rows = docs.select(F.col(id_col).alias("id"), tokens.alias("_t")).mapInArrow(
        look_up, f"id {kind}, terms array<int>, counts array<int>")
    return rows.groupBy("id").agg(F.collect_list(F.struct("terms", "counts")).alias("_r")).select(
        "id", F.flatten("_r.terms").alias("terms"), F.flatten("_r.counts").alias("counts"))


def unit_vectors(places: DataFrame, idf: np.ndarray) -> DataFrame:
    """``(id, terms, values)`` of ``(id, terms, counts)``: counts times *idf*,
    of unit length; weights of 0 are dropped, and ids without a weight."""
    kind, dim = places.schema["id"].dataType.simpleString(), len(idf)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                x = _sparse_block(part.column("terms"), part.column("counts"), dim) * idf
                norm = np.sqrt((x * x).sum(axis=1))
                x /= np.where(norm == 0, 1, norm)[:, None]
                row, place = np.nonzero(x)
                held, first = np.unique(row, return_index=True)
                ends = pa.array(np.append(first, len(row)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(held)),
                     pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(x[row, place]))],
                    names=["id", "terms", "values"])

    return places.select("id", "terms", "counts").mapInArrow(
        weigh, f"id {kind}, terms array<int>, values array<double>")


def _sparse_block(terms: pa.ListArray, values: pa.ListArray, dim: int) -> np.ndarray:
    """Rows x dim; values of one place are added up."""
    row = pc.list_parent_indices(terms).to_numpy(zero_copy_only=False).astype(np.int64)
    cell = row * dim + terms.flatten().to_numpy(zero_copy_only=False)
    value = values.flatten().to_numpy(zero_copy_only=False)
    return np.bincount(cell, value, len(terms) * dim).reshape(len(terms), dim)


def _blocks(batch: pa.RecordBatch, dim: int | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The id column and the dense rows of at most BLOCK_ROWS rows at a time;
    *dim* None: the rows are dense arrays ``vec``."""
    for start in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(start, BLOCK_ROWS)
        if dim is None:
            x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
        else:
            x = _sparse_block(part.column("terms"), part.column("values"), dim)
        yield (part.column("id") if "id" in part.schema.names else None), x


def _columns(dim: int | None) -> list[str]:
    return ["vec"] if dim is None else ["terms", "values"]


# H08 ---------------------------------------------------------------------------
@dataclass
class Pca:
    """Means and sample deviations of the features, and the first components
    (features x k)."""

    mean: np.ndarray
    deviation: np.ndarray
    components: np.ndarray


def covariance(vectors: DataFrame, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample covariance: the Gram matrix less n times the mean's
    square.  One pass sums the Gram matrix of (vector, 1), whose last row is
    the sum."""
    g = gram_matrix(vectors, dim, ones=True)
    n, total = g[-1, -1], g[-1, :-1]
    return total / n, (g[:-1, :-1] - np.outer(total, total) / n) / max(n - 1, 1)


def fit_pca(vectors: DataFrame, k: int, dim: int | None = None) -> Pca:
    """Centred (not scaled) PCA: the k first eigenvectors of the covariance."""
    mean, cov = covariance(vectors, dim)
    values, axes = np.linalg.eigh(cov)
    return Pca(mean, np.sqrt(np.maximum(np.diag(cov), 0)), axes[:, np.argsort(-values)[:k]])


def spectrum(vectors: DataFrame, dim: int | None = None) -> np.ndarray:
    """Variances along all principal components, largest first: eigenvalues of
    the covariance."""
    return np.maximum(np.linalg.eigvalsh(covariance(vectors, dim)[1])[::-1], 0)


def explained_variance(vectors: DataFrame, step: int = 100, dim: int | None = None) -> DataFrame:
    """(k, cumulative): the share of the variance that the first k components
    explain, for k = 0, step, 2 step ... and all; prefix sums of one spectrum."""
    values = spectrum(vectors, dim)
    cum = np.concatenate([[0.0], np.cumsum(values) / max(values.sum(), 1e-300)])
    grid = sorted({*range(0, len(values), step), len(values)})
    return vectors.sparkSession.createDataFrame([(k, float(cum[k])) for k in grid],
                                                "k int, cumulative double")


def project(vectors: DataFrame, axes: np.ndarray, mean: np.ndarray | None = None,
            dim: int | None = None) -> DataFrame:
    """``(id, vec)``: the vectors, less *mean*, along *axes* (features x k)."""
    kind = vectors.schema["id"].dataType.simpleString()

    def along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _blocks(batch, dim):
                y = (x if mean is None else x - mean) @ axes
                ends = pa.array(np.arange(len(y) + 1) * axes.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], names=["id", "vec"])

    return vectors.select("id", *_columns(dim)).mapInArrow(along, f"id {kind}, vec array<double>")


# H13 ---------------------------------------------------------------------------
def reconstruction_error(pca: Pca, vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """RMSE of reconstructing the centred vectors from k components, next
    to the mean per-feature standard deviation."""
    mean, axes = pca.mean, pca.components

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _blocks(batch, dim):
                x = x - mean
                rest = x - (x @ axes) @ axes.T
                yield pa.RecordBatch.from_arrays([pa.array((rest * rest).sum(axis=1))], names=["se"])

    e = vectors.select(*_columns(dim)).mapInArrow(squares, "se double")
    rmse = e.agg(F.sqrt(F.sum("se") / (F.count(F.lit(1)) * len(mean))).alias("rmse"))
    return rmse.withColumn("mean_feature_std", F.lit(float(pca.deviation.mean())))


# H09 ---------------------------------------------------------------------------
def gram_matrix(vectors: DataFrame, dim: int | None = None, ones: bool = False) -> np.ndarray:
    """The Gram matrix (d x d, d bounded by the term space) of all rows of
    *vectors*, with a last feature of 1 if *ones*.  Every task sums the matrix
    of its own rows block by block; the tasks' matrices are dealt out by row
    number and added up row by row in Spark."""
    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _blocks(batch, dim):
                if ones:
                    x = np.hstack([x, np.ones((len(x), 1))])
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield _rows(np.arange(len(total)), total)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.column("row").flatten().to_numpy(zero_copy_only=False)
            for i, row in zip(batch.column("i").to_pylist(), rows.reshape(batch.num_rows, -1)):
                sums[i] = sums[i] + row if i in sums else row.copy()
        if sums:
            yield _rows(np.array(list(sums)), np.stack(list(sums.values())))

    schema = "i int, row array<double>"
    parts = vectors.select(*_columns(dim)).mapInArrow(gram, schema)
    full = parts.repartition("i").mapInArrow(add_up, schema).orderBy("i").toArrow()     # d rows
    if not full.num_rows:
        raise ValueError("no vectors")
    flat = full.column("row").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(full.num_rows, -1)


def _rows(numbers: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(matrix) + 1) * matrix.shape[1], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(matrix.ravel()))],
        names=["i", "row"])


def fit_lsi(vectors: DataFrame, k: int, dim: int | None = None) -> np.ndarray:
    """Truncated SVD of the (uncentred) document × term matrix; returns the
    term-side singular vectors V (d × k), by falling singular value."""
    values, vectors_ = np.linalg.eigh(gram_matrix(vectors, dim))
    order = np.argsort(-values)[:k]
    return vectors_[:, order]


# H10 / H11 / H12 ---------------------------------------------------------------------
def best_rows(key: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of *key* (rows x columns, smaller is better) and its *ids*
    the k best by (key, id), filled up with infinity and -1."""
    out_key = np.full((len(key), k), np.inf)
    out_id = np.full((len(key), k), -1, np.int64)
    if key.shape[1] == 0:
        return out_key, out_id
    bound = np.partition(key, k - 1, axis=1)[:, k - 1] if key.shape[1] > k else np.full(len(key), np.inf)
    row, column = np.nonzero(key <= bound[:, None])          # ties at the bound stay in
    order = np.lexsort((ids[row, column], key[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    first = place < k
    row, column, place = row[first], column[first], place[first]
    out_key[row, place] = key[row, column]
    out_id[row, place] = np.where(np.isfinite(key[row, column]), ids[row, column], -1)
    return out_key, out_id


def _distances(q: np.ndarray, d: np.ndarray, metric: str) -> np.ndarray:
    """Queries x documents; smaller is better."""
    if metric == "euclid":
        square = (q * q).sum(1)[:, None] + (d * d).sum(1)[None, :] - 2 * q @ d.T
        return np.round(np.sqrt(np.maximum(0.0, square)), SCORE_DIGITS)
    if metric == "cosine":
        q, d = (x / np.where((n := np.linalg.norm(x, axis=1)) == 0, 1, n)[:, None] for x in (q, d))
    return np.round(-(q @ d.T), SCORE_DIGITS)


def dense_top_k(queries: DataFrame, docs: DataFrame, k: int = 5, metric: str = "cosine",
                max_bytes: int = QUERY_BYTES) -> DataFrame:
    """Exact top-k documents per query in a dense space, ties by id.

    ``metric``: ``cosine`` (desc), ``dot`` (linear kernel, desc) or ``euclid``
    (asc).  Queries are dealt by a hash of their id into slices of about
    ``max_bytes``, broadcast one at a time; a task scores blocks of
    BLOCK_QUERIES x BLOCK_ROWS and keeps the k best of each query as it goes,
    so its memory does not depend on the number of queries or rows."""
    sizes = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vec")), F.lit(0))).first()
    slices = max(1, -(-(8 * (sizes[0] + sizes[1])) // max_bytes))
    sign = 1 if metric == "euclid" else -1
    out = None
    for part in range(slices):
        held = queries.filter(F.pmod(F.xxhash64("id"), F.lit(slices)) == part).toArrow()
        ids = held.column("id").to_numpy()
        flat = held.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        shared = docs.sparkSession.sparkContext.broadcast((ids, flat.reshape(len(ids), -1)))

        def score(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            qid, q = shared.value
            key = np.full((len(qid), k), np.inf)
            best = np.full((len(qid), k), -1, np.int64)
            for batch in batches:
                every = batch.column("id").to_numpy(zero_copy_only=False)
                vectors = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
                vectors = vectors.reshape(batch.num_rows, -1)
                for r in range(0, batch.num_rows, BLOCK_ROWS):
                    d, did = vectors[r:r + BLOCK_ROWS], every[r:r + BLOCK_ROWS]
                    for b in range(0, len(qid), BLOCK_QUERIES):
                        at = slice(b, b + BLOCK_QUERIES)
                        here = _distances(q[at], d, metric)
                        key[at], best[at] = best_rows(
                            np.concatenate([key[at], here], axis=1),
                            np.concatenate([best[at], np.broadcast_to(did, here.shape)], axis=1), k)
            found = best >= 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(qid, found.sum(1)), pa.int64()), pa.array(best[found]),
                 pa.array(sign * key[found])], names=["query_id", "doc_id", "score"])

        rows = docs.select("id", "vec").mapInArrow(score, "query_id long, doc_id long, score double")
        out = rows if out is None else out.unionByName(rows)
    order = F.col("score").asc() if sign == 1 else F.col("score").desc()
    w = Window.partitionBy("query_id").orderBy(order, F.col("doc_id"))
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

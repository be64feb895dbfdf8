"""Operator 4: MinHash near-de-duplication by a multi-index Hamming join.

A document's set are its distinct 5-word shingles.  Its signature has 48
symbols of 16 bits (b-bit MinHash), in 12 chunks of 4.  Two signatures that
differ in at most 23 symbols differ in at most one symbol of some chunk
(pigeonhole), so every signature is indexed under each chunk with each one of
its symbols left out: 48 keys.  All pairs within distance 23 meet under a key;
a pair at similarity 0.75 misses all twelve chunks with probability 1e-7.

Candidates are confirmed on the full shingle sets, without all pairs of a
group ever being listed:

1. documents with equal sets become one class (representative: smallest id);
2. under each key, every class is compared with one pivot only, the class that
   meets most others; confirmed links are contracted to components;
3. keys that still hold several components are worked off exactly: up to 64
   classes by a join filtered by size and signature distance, whose pairs are
   confirmed (at most 64 a row); larger keys as families, whose chunks are
   intersected as matrices, cell by cell, returning only joining links.

A pair left untested is thus already connected, so components are those of
all links.  Links and labels stay in written tables.

Defined results: null, empty or blank texts have an empty set, are linked with
nothing and are kept; fewer than five words form one shingle; rows with a null
id follow their class (id null only if all ids there are); rows that share an
id are one document; an empty table gives an empty result; extra columns are
ignored by :func:`near_duplicates` and returned by :func:`drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fits, materialise
from tessera.llm.components import components
from tessera.llm.textbytes import IS_WHITE, LOWER, SpanHash, mixed, slices, spans, utf8

SHINGLE = 5
CHUNKS = 12
PER_CHUNK = 4
#: Pairs further apart than this are not confirmed (expected distance of a pair
#: at similarity 0.75 is 12, with a standard deviation of 3).
MOST_DISTANCE = 26
SIMILARITY = (75, 100)
#: Candidate ids up to this number are broadcast, more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Rounds of comparing every key's rows with one pivot.
ROUNDS = 1
#: Keys that still hold more classes than this are compared family by family.
MOST_MEETING = 64
CHUNK_ROWS = 256

_RNG = np.random.default_rng(48)
_FLIP = _RNG.integers(0, 1 << 63, CHUNKS * PER_CHUNK, dtype=np.uint64)
_TIMES = _RNG.integers(0, 1 << 63, CHUNKS * PER_CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), distinct and ascending, of all texts."""
    raw = LOWER[raw]
    starts, ends, words = spans(raw, offsets, ~IS_WHITE)
    h = SpanHash(raw)(starts, ends)
    text = np.repeat(np.arange(len(words)), words)
    left = np.cumsum(words)[text] - np.arange(len(h))      # words to the end of the text
    size = np.minimum(words[text], SHINGLE)
    value = size.astype(np.uint64)
    padded = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        value = value * _STEP + np.where(k < size, padded[k:k + len(h)], np.uint64(0))
    first = left >= size
    text, value = text[first], mixed(value[first])
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return text[new], value[new]


def signatures(text: np.ndarray, value: np.ndarray, n: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: set size, two digests of the set, CHUNKS words of symbols."""
    sizes = np.bincount(text, minlength=n)
    some = np.flatnonzero(sizes)
    digests, chunks = np.zeros((n, 2), np.uint64), np.zeros((n, CHUNKS), np.uint64)
    if len(some):
        cuts = np.cumsum(sizes)[some] - sizes[some]
        digests[some, 0] = np.add.reduceat(mixed(value ^ np.uint64(0x5851F42D4C957F2D)), cuts)
        digests[some, 1] = np.add.reduceat(mixed(value * _STEP), cuts)
        for k in range(CHUNKS * PER_CHUNK):
            least = np.minimum.reduceat((value ^ _FLIP[k]) * _TIMES[k], cuts)
            symbol = mixed(least) & np.uint64(0xFFFF)
            chunks[some, k // PER_CHUNK] |= symbol << np.uint64(16 * (k % PER_CHUNK))
    return sizes, digests, chunks


def sketches(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, d1, d2, s0 ... s11."""
    names = ["n_shingles", "d1", "d2"] + [f"s{i}" for i in range(CHUNKS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(1)):
                raw, offsets = utf8(batch.column(1).slice(start, n))
                sizes, digests, chunks = signatures(*shingles(raw, offsets), n)
                columns = [sizes, *digests.T, *chunks.T]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, n),
                     *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in columns)],
                    names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names))


def _distance(a: str, b: str) -> Column:
    """Symbols in which the signatures of two aliased rows differ."""
    total = None
    for i in range(CHUNKS):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        for shift in (8, 4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        bits = F.bit_count(x.bitwiseAND(F.lit(0x0001000100010001)))
        total = bits if total is None else total + bits
    return total


def _near(a: str, b: str) -> Column:
    """Sizes and signature distance allow the similarity."""
    num, den = SIMILARITY
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return ((F.least(n, m) * den >= F.greatest(n, m) * num)
            & (_distance(a, b) <= MOST_DISTANCE))


def _keys(classes: DataFrame) -> DataFrame:
    """(key, id): every chunk of a class with each one symbol left out."""
    masks = np.array([(1 << 64) - 1 - (0xFFFF << (16 * p)) for p in range(PER_CHUNK)],
                     np.uint64).view(np.int64).tolist()
    keys = [F.xxhash64(F.lit(c * PER_CHUNK + p), F.col(f"s{c}").bitwiseAND(F.lit(m)))
            for c in range(CHUNKS) for p, m in enumerate(masks)]
    return classes.select("id", F.explode(F.array(*keys)).alias("key"))


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar, as written rows."""
    num, den = SIMILARITY
    pairs = materialise(pairs.select("a", "b").distinct(), "candidates")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = (docs.select(F.col("doc_id").alias("id"), "text")
             .join(_small(ids), "id", "left_semi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, n in slices(batch.column(3), 1 << 20):
                part = batch.slice(start, n)
                # A's and B's sets of a row, one behind the other: equal neighbours meet.
                (ta, va), (tb, vb) = (shingles(*utf8(part.column(i))) for i in (2, 3))
                order = np.lexsort((np.concatenate([va, vb]), np.concatenate([ta, tb])))
                t, v = np.concatenate([ta, tb])[order], np.concatenate([va, vb])[order]
                same = t[1:][(t[1:] == t[:-1]) & (v[1:] == v[:-1])]
                shared = np.bincount(same, minlength=n)
                every = np.bincount(t, minlength=n) - shared
                yield part.select([0, 1]).filter(pa.array(shared * den >= every * num))

    kind = dict(pairs.dtypes)["a"]
    left = texts.select(F.col("id").alias("b"), F.col("text").alias("_tb"))
    right = texts.select(F.col("id").alias("a"), F.col("text").alias("_ta"))
    # The a side may repeat (a pivot); its text joins last and is not shuffled again.
    rows = pairs.join(left, "b").join(right, "a").select("a", "b", "_ta", "_tb")
    return materialise(rows.mapInArrow(run, f"a {kind}, b {kind}").distinct(), "links")


def links(classes: DataFrame, docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Confirmed links (a, b) between classes; their components are those of
    all links at the similarity.  *classes* is a written table (id, sizes,
    signature)."""
    keys = _keys(classes)
    met = keys.groupBy("key").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    rows = materialise(keys.join(met, "key"), "shared")
    # A class that meets many others is likely the middle of its group.
    degree = rows.groupBy("id").agg(F.sum("met").alias("degree"))
    degree = materialise(degree, "degree")
    rows = materialise(rows.select("key", "id").join(_small(degree), "id")
                       .withColumn("c", F.col("id")), "shared")
    found = None
    for _ in range(rounds):
        pivots = (rows.groupBy("key")
                  .agg(F.max_by("id", F.struct("degree", "id")).alias("pivot"),
                       F.min("c").alias("_c0"), F.max("c").alias("_c1"))
                  .filter("_c0 < _c1").select("key", "pivot"))
        rows = materialise(rows.join(pivots, "key"), "open")
        star = (rows.filter("id <> pivot")
                .select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b"))
                .distinct())
        p, q = classes.alias("p"), classes.alias("q")
        star = (star.join(q, star["b"] == F.col("q.id")).join(p, star["a"] == F.col("p.id"))
                .filter(_near("p", "q")).select("a", "b"))
        if found is not None:
            star = star.join(_small(found), ["a", "b"], "left_anti")
        confirmed = _confirmed(star, docs)
        found = confirmed if found is None else materialise(found.union(confirmed), "links")
        # All pairs of a pivot under its key are done; the others go on with their component.
        labels = components(found).withColumnsRenamed({"node": "id", "component": "_c"})
        rows = materialise(
            rows.filter("id <> pivot").select("key", "id", "degree")
            .join(_small(labels), "id", "left")
            .select("key", "id", "degree", F.coalesce("_c", "id").alias("c")), "open")
    sizes = (rows.groupBy("key")
             .agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("_c0"),
                  F.max("c").alias("_c1"), F.min("id").alias("first"))
             .filter("_c0 < _c1").select("key", "size", "first"))
    rows = materialise(rows.join(sizes, "key"), "open")
    few = rows.filter(F.col("size") <= MOST_MEETING).join(classes, "id")
    meet = ((F.col("l.key") == F.col("r.key")) & (F.col("l.c") != F.col("r.c"))
            & (F.col("l.id") < F.col("r.id")) & _near("l", "r"))
    rest = few.alias("l").join(few.alias("r"), meet).select(F.col("l.id").alias("a"),
                                                            F.col("r.id").alias("b"))
    found = found.unionByName(_confirmed(rest, docs))
    return found.unionByName(_family_links(rows.filter(F.col("size") > MOST_MEETING), docs))


def _families(rows: DataFrame) -> DataFrame:
    """(id, family): classes that meet under the keys of *rows* (key, id,
    first), directly or through others.

    Every class is first connected with the smallest class of its keys only
    (one edge a class); what is connected is contracted, and the edges between
    contracted groups that are left, far fewer, go on until there is none."""
    edges = materialise(rows.filter("id <> first").select(
        F.least("first", "id").alias("a"), F.greatest("first", "id").alias("b")).distinct(),
        "family-edges")
    member = None
    while edges.limit(1).count():
        least = materialise(edges.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"),
                            "least-edges")
        labels = components(least)
        if member is None:
            member = labels.withColumnsRenamed({"node": "id", "component": "family"})
        else:
            member = materialise(
                member.join(_small(labels), F.col("family") == F.col("node"), "left")
                .select("id", F.coalesce("component", "family").alias("family")), "families")
        side = _small(labels)
        at = lambda c: side.select(F.col("node").alias(c), F.col("component").alias(f"_{c}"))
        now = edges.join(at("a"), "a", "left").join(at("b"), "b", "left").select(
            F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
        left = materialise(now.filter("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "family-edges")
        # Classes that are an edge's smaller end only join the table as they are.
        new = (edges.select(F.col("a").alias("id")).distinct()
               .join(member.select("id"), "id", "left_anti").withColumn("family", F.col("id")))
        member = materialise(member.unionByName(new), "families")
        edges = left
    return member


def _family_links(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between the components of large open keys.

    Classes that meet under such keys form families.  A family is dealt into
    chunks of about CHUNK_ROWS classes and every pair of chunks is one cell; a
    cell intersects all its shingle sets at once (a product of 0/1 matrices)
    and returns only links that join two components."""
    num, den = SIMILARITY
    kind = dict(rows.dtypes)["id"]
    if rows.limit(1).count() == 0:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    member = _families(rows)
    chunks = member.groupBy("family").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(CHUNK_ROWS)).cast("int").alias("chunks"))
    labels = rows.select("id", "c").distinct()
    member = materialise(
        member.join(chunks, "family").join(labels, "id")
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")), "families")
    cells = (docs.select(F.col("doc_id").alias("id"), "text").join(_small(member), "id")
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("family", F.least("chunk", "other").alias("ci"),
                     F.greatest("chunk", "other").alias("cj"), "chunk", "id", "c", "text"))

    def compare(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        n = cell.num_rows
        ids, comps = cell.column("id").to_pylist(), cell.column("c").to_pylist()
        chunk = cell.column("chunk").to_numpy()
        one = np.flatnonzero(chunk == cell.column("ci")[0].as_py())
        two = np.flatnonzero(chunk == cell.column("cj")[0].as_py())
        text, value = shingles(*utf8(cell.column("text").chunk(0)))
        sizes = np.bincount(text, minlength=n)
        _, column, times = np.unique(value, return_inverse=True, return_counts=True)
        text, column = text[times[column] > 1], column[times[column] > 1]
        _, column = np.unique(column, return_inverse=True)
        shared = np.zeros((len(one), len(two)), np.float32)
        for start in range(0, int(column.max(initial=-1)) + 1, 4096):
            here = (column >= start) & (column < start + 4096)
            marks = np.zeros((n, 4096), np.float32)
            marks[text[here], column[here] - start] = 1
            shared += marks[one] @ marks[two].T
        every = sizes[one][:, None] + sizes[two][None] - shared
        label = np.unique(np.array(comps), return_inverse=True)[1]
        link = (shared * den >= every * num) & (label[one][:, None] != label[two][None])
        root = list(range(n))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        a, b = [], []
        for i, j in zip(*(x.tolist() for x in np.nonzero(link))):
            x, y = find(label[one[i]]), find(label[two[j]])
            if x != y:
                root[x] = y
                a.append(ids[one[i]])
                b.append(ids[two[j]])
        id_type = cell.schema.field("id").type
        return pa.table({"a": pa.array(a, id_type), "b": pa.array(b, id_type)})

    found = cells.groupBy("family", "ci", "cj").applyInArrow(compare, f"a {kind}, b {kind}")
    return materialise(found.distinct(), "family-links")


def _small(table: DataFrame) -> DataFrame:
    """Hint a broadcast for a written table of bounded size, else a shuffle."""
    return F.broadcast(table) if fits(table, BROADCAST_IDS) else table


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    drawn = materialise(sketches(docs), "sketches")
    digest = ["n_shingles", "d1", "d2"]
    grouped = (drawn.filter("n_shingles > 0").groupBy(*digest)
               .agg(F.min("doc_id").alias("id"),
                    *[F.first(f"s{i}").alias(f"s{i}") for i in range(CHUNKS)]))
    grouped = materialise(grouped, "classes")
    known = grouped.filter("id IS NOT NULL").drop("d1", "d2")
    found = components(materialise(links(known, docs), "edges"))
    named = (grouped.select(*digest, "id").join(found, F.col("id") == F.col("node"), "left")
             .select(*digest, F.coalesce("component", "id").alias("_class")))
    out = drawn.select("doc_id", *digest).join(named, digest, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_class")).otherwise(F.col("doc_id"))
    return (out.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, with all their columns
    (every row of a kept id stays)."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti").select(*docs.columns)

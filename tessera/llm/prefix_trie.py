r"""Operator 12: the prefix trie of conversations by a splitter skeleton.

A conversation is a path of turns.  Conversations are sorted by (path, id) and
cut into shards by splitters from a bounded sample; a splitter is such a pair,
so equal conversations, however many, fall into several shards.  The trie of
the splitters' paths, the skeleton, is broadcast (its size is bounded by the
number of splitters times ``SPLITTER_TURNS``).  A node that is not on the
skeleton has all its members in one shard: the sorted shard finishes it with a
stack, without a shuffle.  Skeleton nodes get partial aggregates from every
shard, which Spark adds up; what a shard knows of a skeleton node's subtree is
added to all skeleton nodes above it when the few sums are rolled up.

A turn is known by 16 bytes of the SHA-256 of its role and text, and only
these bytes and its word count are shuffled.

:func:`rebuilt` makes the conversations of the query: the first h turns of
another conversation, then the own turns from h on.

Defined results: rows without a conv_id take no part; null role or text is
empty; rows of one conversation with equal turns are ordered by the digest of
role and text, null turns come first; repeated rows are turns of their own; a
conversation without turns ends at the root; an empty table gives an empty
result; extra columns are ignored.  The ids that end at a node are hashed as
one stream, since SHA-256 has no partial form: shards join them to strings of
at most ``ENDS`` ids and one task streams these strings in order.  A
conversation's path is held in one row, 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialise

HEAD = 3
EVERY = 20
KEY = 16
#: Turns of a shard, at most and (while tasks are idle) at least; the most shards.
SHARD_TURNS = 100_000
LEAST_TURNS = 200
MOST_SHARDS = 8192
#: Sampled conversations for each splitter; turns of a splitter that count.
OVERSAMPLE = 4
SPLITTER_TURNS = 64
#: Ids of one string on the way to a node's digest.
ENDS = 4096
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes that stand for a turn's role and text."""
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, KEY)


def original_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (key, words)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct(F.col("turn"), turn_key(role, text).alias("key"),
                            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")).alias("t"))
    # Nulls sort first, so turns without a number come first.
    return (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["key"], x["words"])).alias("turns")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of every conversation c: the first h turns of
    conversation c - c % 20, then its own after its first h; h is
    crc32(c as text) % 4."""
    own = materialise(original_turns(conversations), "turns")
    c = F.col("conv_id")
    heads = own.filter(c % EVERY == 0).select(
        c.alias("_base"), F.slice("turns", 1, HEAD).alias("_head"))
    h = (F.crc32(c.cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return (own.join(heads, c - c % EVERY == F.col("_base"), "left")
            .select("conv_id", F.concat(F.coalesce(F.slice("_head", 1, h), none), rest).alias("turns")))


# Paths and splitters ---------------------------------------------------------------
def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words): the keys of all turns one behind the other, and
    their word counts as little-endian longs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            keys = b"".join(flat.field(0).slice(offsets[0], offsets[-1] - offsets[0]).to_pylist())
            words = np.ascontiguousarray(flat.field(1).to_numpy(zero_copy_only=False), "<i8")
            edge = offsets - offsets[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([keys[KEY * a:KEY * b] for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                 pa.array([words[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])],
                          pa.binary())], names=["conv_id", "path", "words"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv_id {kind}, path binary, words binary")


def splitters(rows: DataFrame, shards: int) -> list[tuple[bytes, int, bytes]]:
    """(path, conv_id, words) of up to shards - 1 rows at even steps of a
    bounded sample (the smallest hashes), the path cut to SPLITTER_TURNS."""
    if shards < 2:
        return []
    sample = (rows.orderBy(F.xxhash64("conv_id")).limit(OVERSAMPLE * shards)
              .select(F.substring("path", 1, KEY * SPLITTER_TURNS), "conv_id",
                      F.substring("words", 1, 8 * SPLITTER_TURNS)).collect())
    found = sorted((bytes(p), c, bytes(w)) for p, c, w in sample)
    return [found[len(found) * i // shards] for i in range(1, min(shards, len(found)))]


class Skeleton:
    """The trie of the splitters' paths; node 0 is the root."""

    def __init__(self, cuts: list[tuple[bytes, int, bytes]]):
        self.child: list[dict[bytes, int]] = [{}]
        self.parent, self.depth, self.words = [-1], [0], [0]
        for path, _, words in cuts:
            node = 0
            for i, w in enumerate(np.frombuffer(words, "<i8").tolist()):
                key = path[KEY * i:KEY * (i + 1)]
                if key not in self.child[node]:
                    self.child[node][key] = len(self.parent)
                    self.child.append({})
                    self.parent.append(node)
                    self.depth.append(i + 1)
                    self.words.append(w)
                node = self.child[node][key]


# Shards ------------------------------------------------------------------------------
NODES = ("kind string, conv_id long, depth long, parent_conv_id long, parent_skeleton int, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
         "skeleton int, ends string")
NAMES = [f.split()[0] for f in NODES.split(", ")]


class Shard:
    """Finishes the nodes of one sorted run of conversations.

    The stack holds the open nodes of the current path: first the skeleton
    nodes, as far as the path follows them, then the shard's own nodes."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton = skeleton
        self.out: list[tuple] = []
        self.part: dict[int, list[int]] = {}     # skeleton node: least id, n, children, leaves, saved
        self.ends: dict[int, list[int]] = {}     # skeleton node: ids that end there, not yet written
        self.last = b""
        self.on = [0]                            # skeleton nodes of the current path
        self.own: list[list] = []                # own open nodes below them
        self.done: list[list] = []               # closed nodes of the open subtree

    def add(self, conv: int, path: bytes, words: bytes) -> None:
        depth = len(path) // KEY
        same = self._common(path, depth)
        self._close(same)
        for i in range(len(self.on) + len(self.own) - 1, depth):
            node = None if self.own else self.skeleton.child[self.on[-1]].get(path[KEY * i:KEY * (i + 1)])
            if node is not None:
                self.on.append(node)
                continue
            if self.own:
                self.own[-1][3] += 1
            else:
                self._partial(self.on[-1], conv)[2] += 1
            w = int.from_bytes(words[8 * i:8 * i + 8], "little")
            # least id, depth, n, children, leaves, saved, words, hash of ends, place of the parent
            self.own.append([conv, i + 1, 0, 0, 0, 0, w, None, None])
        self.last = path
        for node in self.on:
            self._partial(node, conv)[1] += 1
        for x in self.own:
            x[2] += 1
            if conv < x[0]:
                x[0] = conv
        if self.own:
            top = self.own[-1]
            if top[7] is None:
                top[7] = hashlib.sha256(b"%d" % conv)
            else:
                top[7].update(b",%d" % conv)
        else:
            self.ends.setdefault(self.on[-1], []).append(conv)
            if len(self.ends[self.on[-1]]) >= ENDS:
                self._write_ends(self.on[-1])

    def _common(self, path: bytes, depth: int) -> int:
        """Turns that *path* shares with the path before it."""
        most = min(depth, len(self.last) // KEY)
        if self.last[:KEY * most] == path[:KEY * most]:
            return most
        low, high = 0, most                       # shared, not shared
        while high - low > 1:
            middle = (low + high) // 2
            if self.last[:KEY * middle] == path[:KEY * middle]:
                low = middle
            else:
                high = middle
        return low

    def _partial(self, node: int, conv: int) -> list[int]:
        part = self.part.setdefault(node, [conv, 0, 0, 0, 0])
        part[0] = min(part[0], conv)
        return part

    def _close(self, depth: int) -> None:
        """Close the open nodes below *depth*."""
        while self.own and self.own[-1][1] > depth:
            x = self.own.pop()
            x[4] += x[3] == 0
            x[5] += (x[2] - 1) * x[6]
            self.done.append(x)
            if self.own:
                self.own[-1][4] += x[4]
                self.own[-1][5] += x[5]
                x[8] = self.own[-1]
                continue
            part = self.part[self.on[-1]]
            part[3] += x[4]
            part[4] += x[5]
            for n in self.done:                   # the whole subtree is known now
                up = n[8]
                self.out.append(("node", n[0], n[1], up[0] if up else None, None if up else self.on[-1],
                                 n[2], n[3], n[4], n[5], n[7].hexdigest() if n[7] else EMPTY,
                                 None, None))
            self.done = []
        while len(self.on) - 1 > depth and not self.own:
            self.on.pop()

    def _write_ends(self, node: int) -> None:
        ids = self.ends.pop(node)
        self.out.append(("ends", ids[0], *[None] * 8, node, ",".join(map(str, ids))))

    def write_ends(self) -> None:
        for node in list(self.ends):
            self._write_ends(node)

    def finish(self) -> None:
        self._close(0)
        self.write_ends()
        for node, (conv, n, children, leaves, saved) in self.part.items():
            self.out.append(("part", conv, None, None, None, n, children, leaves, saved, None, node, None))
        self.part = {}

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else [()] * len(NAMES), TYPES)],
            names=NAMES)


TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(),
         pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string()]


def sharded(rows: DataFrame, cuts: list[tuple[bytes, int, bytes]], shards: int) -> DataFrame:
    """*rows* (conv_id, path, words) dealt into shards and sorted there."""
    keys = rows.sparkSession.sparkContext.broadcast([(p, c) for p, c, _ in cuts])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(keys.value, x) for x in
                     zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield batch.append_column("shard", pa.array(found, pa.int32()))

    dealt = rows.mapInArrow(deal, "conv_id long, path binary, words binary, shard int")
    return dealt.repartition(shards, "shard").sortWithinPartitions("path", "conv_id")


def finished(rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    """Own nodes, partial aggregates and ends of every sorted shard."""
    shared = rows.sparkSession.sparkContext.broadcast(skeleton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(shared.value), None
        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist()
                                 for c in ("shard", "conv_id", "path", "words"))):
                if k != number:                  # a task may hold shards that are not neighbours
                    shard.write_ends()
                    number = k
                shard.add(*row)
                if len(shard.out) >= 20_000:
                    yield shard.batch()
        shard.finish()
        yield shard.batch()

    return rows.mapInArrow(run, NODES)


def rolled_up(parts: list, skeleton: Skeleton) -> list[tuple]:
    """The skeleton's nodes from their reduced partials: (skeleton, conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)."""
    least, n, children, leaves, saved = {}, {}, {}, {}, {}
    for r in parts:
        k = r["skeleton"]
        least[k], n[k], children[k], leaves[k], saved[k] = (
            r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"])
    for k in sorted(n, reverse=True):                # children have larger numbers than parents
        children[k] += len(skeleton.child[k])
        leaves[k] += children[k] == 0
        saved[k] += (n[k] - 1) * skeleton.words[k]
        if k:
            leaves[skeleton.parent[k]] += leaves[k]
            saved[skeleton.parent[k]] += saved[k]
    return [(k, least[k], skeleton.depth[k], least[skeleton.parent[k]] if k else None, n[k],
             children[k], leaves[k], saved[k]) for k in sorted(n)]


def digests(ends: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): the strings of each node, streamed in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k != node:
                    out += [(node, state.hexdigest())] if state else []
                    node, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _digest_rows(out)
        yield _digest_rows([(node, state.hexdigest())] if state else [])

    return (ends.select("skeleton", "conv_id", "ends").repartition("skeleton")
            .sortWithinPartitions("skeleton", "conv_id").mapInArrow(run, "skeleton int, ends_sha256 string"))


def _digest_rows(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()),
                                       pa.array([d for _, d in rows], pa.string())],
                                      names=["skeleton", "ends_sha256"])


def trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of *turns* (conv_id, turns): conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    spark: SparkSession = turns.sparkSession
    rows = materialise(paths(turns.withColumn("conv_id", F.col("conv_id").cast("long"))), "paths")
    total = int(rows.agg(F.sum(F.octet_length("path") / KEY + 1)).first()[0] or 0)
    # A small table still uses the cluster's tasks.
    usual = min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // LEAST_TURNS)
    shards = int(min(MOST_SHARDS, max(1, usual, -(-total // shard_turns))))
    cuts = splitters(rows, shards)
    skeleton = Skeleton(cuts)
    out = materialise(finished(sharded(rows, cuts, shards), skeleton), "trie")
    parts = (out.filter("kind = 'part'").groupBy("skeleton")
             .agg(F.min("conv_id").alias("conv_id"),
                  *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
             .collect())                             # one row per skeleton node
    upper = spark.createDataFrame(
        rolled_up(parts, skeleton),
        "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256"]
    top = (upper.join(digests(out.filter("kind = 'ends'")), "skeleton", "left")
           .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))).select(*names))
    # Bounded like the skeleton itself.
    above = F.broadcast(upper.select(F.col("skeleton").alias("_k"), F.col("conv_id").alias("_conv")))
    own = (out.filter("kind = 'node'").join(above, F.col("parent_skeleton") == F.col("_k"), "left")
           .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_conv")).select(*names))
    return top.unionByName(own)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(conversations))


ORACLE = r"""
WITH RECURSIVE o AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
           length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS rn
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, c - c % 20 AS base, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, length(CAST(c AS VARCHAR)) + 1),
                  lambda i: ascii(substr(CAST(c AS VARCHAR), i, 1))::BIGINT)),
      lambda a, x: list_reduce(list_concat([xor(a, x)], range(8)),
                               lambda b, i: xor(b >> 1, 3988292384 * (b & 1))))) % 4 AS h
  FROM (SELECT DISTINCT c FROM o)),
t AS (
  SELECT ids.c, o.rn AS k, o.role, o.text FROM ids JOIN o ON o.c = ids.base AND o.rn <= ids.h
  UNION ALL
  SELECT ids.c, 1000 + o.rn, o.role, o.text FROM ids JOIN o ON o.c = ids.c AND o.rn > ids.h),
n AS MATERIALIZED (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY k) AS d, sha256(length(role) || ':' || role || text) AS turn,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS words
  FROM t),
member AS (
  SELECT c, 0::BIGINT AS d, '' AS node, CAST(NULL AS VARCHAR) AS up, 0::BIGINT AS words FROM ids
  UNION ALL
  SELECT n.c, n.d, sha256(m.node || n.turn), m.node, n.words FROM member m JOIN n ON n.c = m.c AND n.d = m.d + 1),
size AS (SELECT c, max(d) AS long FROM member GROUP BY c),
node AS MATERIALIZED (
  SELECT m.node, any_value(m.up) AS up, min(m.c) AS conv_id, any_value(m.d) AS depth, count(*) AS n_convs,
         any_value(m.words) AS words,
         sha256(coalesce(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) FILTER (m.d = s.long), '')) AS ends_sha256
  FROM member m JOIN size s ON s.c = m.c GROUP BY m.node),
kids AS (SELECT up, count(*) AS n_children FROM node WHERE up IS NOT NULL GROUP BY up),
above AS (
  SELECT node AS top, node FROM node
  UNION ALL
  SELECT p.up, a.node FROM above a JOIN node p ON p.node = a.top WHERE p.up IS NOT NULL),
sub AS (
  SELECT a.top AS node, count(*) FILTER (k.up IS NULL) AS n_leaves,
         CAST(sum((x.n_convs - 1) * x.words) AS BIGINT) AS saved_tokens
  FROM above a JOIN node x ON x.node = a.node LEFT JOIN kids k ON k.up = a.node GROUP BY a.top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM node n LEFT JOIN node p ON p.node = n.up LEFT JOIN kids k ON k.up = n.node
     JOIN sub s ON s.node = n.node
"""

"""Operator 7: removal of repeated 200-byte strings by sparse prefix doubling.

A byte is removed if some 200-byte string covering it also starts anywhere
else, in the same or another text.  Prefix doubling ranks positions by ever
longer strings and drops those that have become unique; ranking all bytes from
the start would shuffle many times the input.  So early rounds rank sample
positions that stand for whole runs of windows (windows are the 200-byte
strings), and only what stays undecided is ranked byte by byte:

1. length 64: every window is represented by its smallest-hashed 64-byte string
   (a minimizer, about one position in 70).  Equal windows have equal
   minimizers, so windows of unique 64-byte strings leave.
2. lengths 185 and 215: the windows of a surviving position fall into aligned
   blocks of 16.  Block strings are named by the 185 bytes common to all 16
   windows and by the 215 bytes they cover.  A block whose 215 bytes repeat is
   settled (all 16 windows repeat); one whose 185 bytes are unique leaves.
3. length 200: blocks between the two are opened; single positions are ranked
   by the pair (rank of the first 100 bytes, rank of the next 100), and those
   with an equal pair elsewhere repeat.

Every round is a Spark aggregate over rank keys with a join back, both safe
for strings that occur in a third of all texts.  Decisions rest on 128 bits of
hash.  Texts are padded at both ends with bytes that UTF-8 never holds, so
padding never equals text, ends need no special case and matches never cross
texts.

Defined results: null text is empty; texts that occur more than once are
wholly removed if they have 200 bytes; repeated rows count as occurrences; ids
are only carried (null allowed); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fits, materialise
from tessera.llm.textbytes import SpanHash, mixed, slices, utf8

LENGTH = 200
GRAM = 64
BLOCK = 16
#: Bytes of padding on either side of a text.
PAD = BLOCK
#: Texts worked on at a time; longer ones are cut into overlapping stretches.
STRETCH = 1 << 20
#: Text keys up to this number are broadcast (some 10 MB), more are joined by a shuffle.
BROADCAST_TEXTS = 200_000

_REACH = LENGTH - GRAM + 1  # 64-byte strings in a window


def text_key(raw: bytes) -> int:
    return int.from_bytes(hashlib.sha256(raw).digest()[:8], "little", signed=True)


def padded(raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray]:
    """The texts with PAD bytes, drawn from their key, on either side; they are
    0xF8 to 0xFF, which no text holds."""
    lengths = np.diff(offsets)
    out_offsets = np.concatenate([[0], np.cumsum(lengths + 2 * PAD)])
    out = np.empty(out_offsets[-1], np.uint8)
    out[np.repeat(out_offsets[:-1] + PAD - offsets[:-1], lengths) + np.arange(len(raw))] = raw
    words = mixed(keys.view(np.uint64)[:, None]
                  ^ np.arange(1, 2 * PAD // 8 + 1, dtype=np.uint64)[None] * np.uint64(0x9E3779B9))
    fill = np.ascontiguousarray(words).view(np.uint8).reshape(len(keys), 2 * PAD) | np.uint8(0xF8)
    at = np.arange(PAD)
    out[out_offsets[:-1, None] + at] = fill[:, :PAD]
    out[out_offsets[1:, None] - PAD + at] = fill[:, PAD:]
    return out, out_offsets


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every *n* neighbours."""
    full = np.concatenate([x, np.full(-len(x) % n, np.iinfo(np.uint64).max, np.uint64)])
    rows = full.reshape(-1, n)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = len(x) - n + 1
    return np.minimum(behind[:count], ahead[n - 1:n - 1 + count])


def sample_positions(raw: np.ndarray, offsets: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of padded texts: sampled positions, their 64-byte hashes, and the first
    and last window (start) that each stands for."""
    parts = []
    for begin in range(0, max(len(raw) - LENGTH + 1, 0), STRETCH):
        end = min(begin + STRETCH, len(raw) - LENGTH + 1)      # windows begin ... end - 1
        h = SpanHash(raw[begin:end + LENGTH - 1]).every(GRAM)
        # The leftmost smallest hash: the place breaks ties.
        place = np.arange(len(h), dtype=np.uint64)
        key = (h & ~np.uint64(0xFFFFFF)) | place
        least = sliding_min(key, _REACH)
        at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        start = np.arange(begin, end)
        text = np.searchsorted(offsets, start, "right") - 1
        inside = (start >= offsets[text] + PAD) & (start + LENGTH <= offsets[text + 1] - PAD)
        start, at = start[inside], at[inside]
        if len(start):
            new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            last = np.concatenate([new[1:], [len(at)]]) - 1
            parts.append((at[new] + begin, h[at[new]], start[new], start[last]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none
    at, h, first, last = (np.concatenate(x) for x in zip(*parts))
    # A position found in two stretches is one position.
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[new], h[new], first[new], np.concatenate([last[new[1:] - 1], last[-1:]])


def hashes(raw: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of the spans [a, b), of at most a window and a block each."""
    out = np.zeros(len(a), np.uint64)
    for begin in range(0, len(raw), STRETCH):
        here = np.flatnonzero((a >= begin) & (a < begin + STRETCH))
        if len(here):
            h = SpanHash(raw[begin:begin + STRETCH + LENGTH + BLOCK])
            out[here] = h(a[here] - begin, b[here] - begin)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of the texts that have a window: rows, lengths, padded bytes, offsets."""
    for start, n in slices(column, STRETCH):
        raw, offsets = utf8(column.slice(start, n))
        lengths = np.diff(offsets)
        rows = np.flatnonzero(lengths >= LENGTH)
        if not len(rows):
            continue
        if len(rows) < n:
            raw = raw[np.repeat(lengths >= LENGTH, lengths)]
            lengths = lengths[rows]
            offsets = np.concatenate([[0], np.cumsum(lengths)])
        keys = np.array([text_key(raw[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])],
                        np.int64)
        out, out_offsets = padded(raw, offsets, keys)
        yield start + rows, lengths, keys, out, out_offsets


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text_key, n_bytes and the text's digest."""
    for batch in batches:
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        digests = [hashlib.sha256(t).digest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], pa.int64()),
             pa.array([len(t) for t in texts], pa.int64()),
             pa.array([d.hex() for d in digests], pa.string())],
            names=["doc_id", "u", "n", "sha"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 1: (g, u, at) of every sampled position; at packs place and length."""
    for batch in batches:
        for _, lengths, keys, raw, offsets in _texts(batch.column(0)):
            at, h, _, _ = sample_positions(raw, offsets)
            text = np.searchsorted(offsets, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [_signed(h), pa.array(keys[text]),
                 pa.array(((at - offsets[text]) << 32) | lengths[text])], names=["g", "u", "at"])


def _joined_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Stretches of (text, places) rows: lengths, keys, bytes, offsets, and the
    text number and value of every place."""
    for rows, lengths, keys, raw, offsets in _texts(batch.column(0)):
        lists = batch.column(1).take(pa.array(rows))
        cuts = lists.offsets.to_numpy()
        values = lists.values.to_numpy()[cuts[0]:cuts[-1]]
        yield (lengths, keys, raw, offsets,
               np.repeat(np.arange(len(rows)), np.diff(cuts)), values)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 2: (core, cover, u, at) of the blocks of surviving positions."""
    for batch in batches:
        for lengths, keys, raw, offsets, owner, places in _joined_rows(batch):
            at, _, first, last = sample_positions(raw, offsets)
            alive = np.isin(at, offsets[owner] + places)
            at, first, last = at[alive], first[alive], last[alive]
            low, high = (at - last) // BLOCK, (at - first) // BLOCK
            count = high - low + 1
            j = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(
                np.cumsum(count) - count, count)
            nearest = np.repeat(at, count) - BLOCK * j            # last window of the block
            begin = nearest - (BLOCK - 1)
            text = np.searchsorted(offsets, nearest, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [_signed(hashes(raw, nearest, begin + LENGTH)),
                 _signed(hashes(raw, begin, nearest + LENGTH)),
                 pa.array(keys[text]),
                 pa.array(((begin - offsets[text]) << 32) | lengths[text])],
                names=["core", "cover", "u", "at"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Round 3: (r1, r2, u, at, asked) of the windows of opened blocks."""
    for batch in batches:
        for lengths, keys, raw, offsets, owner, coded in _joined_rows(batch):
            p = (coded >> 1)[:, None] + np.arange(BLOCK)[None]
            owner = np.repeat(owner, BLOCK)
            asked = np.repeat(coded & 1, BLOCK).astype(bool)
            p = p.reshape(-1)
            real = (p >= PAD) & (p + LENGTH <= lengths[owner] + PAD)
            p, owner, asked = p[real], owner[real], asked[real]
            a, half = p + offsets[owner], LENGTH // 2
            yield pa.RecordBatch.from_arrays(
                [_signed(hashes(raw, a, a + half)), _signed(hashes(raw, a + half, a + LENGTH)),
                 pa.array(keys[owner]), pa.array((p << 32) | lengths[owner]), pa.array(asked)],
                names=["r1", "r2", "u", "at", "asked"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """u, n, n_removed, n_spans, kept_sha256 from the repeated window starts;
    a code is twice the start, plus one for a whole block of starts."""
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for lengths, keys, raw, offsets, owner, coded in _joined_rows(batch):
            begin = (coded >> 1) + offsets[owner]
            end = begin + np.where(coded & 1, BLOCK - 1, 0) + LENGTH
            # Windows of a settled block may lie outside the text's own bytes; cut there.
            begin = np.maximum(begin, offsets[owner] + PAD)
            end = np.minimum(end, offsets[owner + 1] - PAD)
            edge = np.zeros(len(raw) + 1, np.int32)
            np.add.at(edge, begin, 1)
            np.add.at(edge, end, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for i in range(len(keys)):
                a, b = offsets[i] + PAD, offsets[i + 1] - PAD
                mask = gone[a:b]
                runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                for column, value in zip(out, (
                        int(keys[i]), int(lengths[i]), int(mask.sum()), runs,
                        hashlib.sha256(raw[a:b][~mask].tobytes()).hexdigest())):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())],
            names=["u", "n", "n_removed", "n_spans", "kept"])


def _listed(rows: DataFrame, value) -> DataFrame:
    """(u, n, list) of a text's values; a list is bounded by the text's length."""
    return (rows.select("u", F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("n"),
                        value.alias("v"))
            .groupBy("u", "n").agg(F.collect_set("v").alias("places")))


def _with_places(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(u, n, text, places): texts joined with their lists, by a shuffle at
    every size."""
    return texts.select("u", "n", "text").join(lists.hint("merge"), ["u", "n"])


def repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    narrow = materialise(rows.mapInArrow(
        _summary, f"doc_id {kind}, u long, n long, sha string"), "texts")
    occurrence = F.xxhash64("u", "at")
    place = F.shiftright("at", 32)

    # Round 1: sampled positions by their 64 bytes.
    grams = rows.select("text").mapInArrow(_grams, "g long, u long, at long")
    again = (grams.groupBy("g").agg(F.min(occurrence).alias("_a"), F.max(occurrence).alias("_b"))
             .filter("_a < _b").select("g"))
    # Written, so that a hot string's rows can be split when they are joined.
    again = materialise(again, "again")
    alive = grams.join(again, "g", "left_semi")
    alive = materialise(_listed(alive, place), "alive")

    # One row of each text with survivors carries the bytes from here on.
    chosen = (narrow.join(alive.select("u", "n"), ["u", "n"], "left_semi")
              .groupBy("u", "n").agg(F.min("doc_id").alias("_first")))
    chosen = materialise(chosen, "chosen")
    side = F.broadcast(chosen) if fits(chosen, BROADCAST_TEXTS) else chosen
    texts = (rows.withColumn("_u", _key_of(F.col("text")))
             .join(side, (F.col("_u") == F.col("u")) & (F.octet_length("text") == F.col("n"))
                   & F.col("doc_id").eqNullSafe(F.col("_first"))))
    texts = materialise(_with_places(texts, alive), "repeated-texts")

    # Round 2: blocks of 16 windows.
    blocks = texts.select("text", "places").mapInArrow(
        _blocks, "core long, cover long, u long, at long")
    named = (blocks.groupBy("core", "cover")
             .agg(F.min(occurrence).alias("_a"), F.max(occurrence).alias("_b")))
    named = materialise(named.withColumn("settled", F.col("_a") < F.col("_b")).drop("_b"), "named")
    cores = (named.groupBy("core").agg(F.count(F.lit(1)).alias("_covers"),
                                       F.min("settled").alias("_all"))
             .withColumn("opened", (F.col("_covers") > 1) & ~F.col("_all"))
             .drop("_covers", "_all"))
    useful = named.join(cores, "core").filter("settled OR opened")
    found = materialise(
        blocks.join(useful, ["core", "cover"])
        .withColumn("opened", F.col("opened") & (occurrence == F.col("_a")))
        .select("u", "at", "settled", "opened"), "blocks")

    # Round 3: single windows of opened blocks; settled ones only bear witness.
    code = place * 2 + (~F.col("settled")).cast("long")
    opened = materialise(_with_places(texts, _listed(found.filter("opened"), code)), "opened-texts")
    windows = opened.select("text", "places").mapInArrow(
        _windows, "r1 long, r2 long, u long, at long, asked boolean")
    equal = (windows.groupBy("r1", "r2")
             .agg(F.min(occurrence).alias("_a"), F.max(occurrence).alias("_b"),
                  F.max("asked").alias("_asked"))
             .filter("_a < _b AND _asked").select("r1", "r2"))
    single = windows.filter("asked").join(equal, ["r1", "r2"], "left_semi").select(
        "u", "at", (place * 2).alias("code"))
    whole = found.filter("settled").select("u", "at", (place * 2 + 1).alias("code"))
    starts = _listed(single.unionByName(whole), F.col("code"))
    cut = materialise(_with_places(texts, starts).select("text", "places").mapInArrow(
        _removed, "u long, n long, n_removed long, n_spans long, kept string")
        .dropDuplicates(["u", "n"]), "removed")

    copies = (narrow.filter(F.col("n") >= LENGTH).groupBy("u", "n", "sha").count()
              .filter("count > 1").select("u", "n", F.lit(True).alias("_copied")))
    empty = hashlib.sha256(b"").hexdigest()
    out = narrow.join(cut, ["u", "n"], "left").join(copies, ["u", "n"], "left")
    copied = F.col("_copied").isNotNull()
    return out.select(
        "doc_id", F.col("n").alias("n_bytes"),
        F.when(copied, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long")
        .alias("n_spans"),
        F.when(copied, F.lit(empty)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


def _key_of(text):
    """text_key as built-ins: the first eight digest bytes, little-endian."""
    digest = F.sha2(text.cast("binary"), 256)
    backwards = F.concat(*[F.substring(digest, i, 2) for i in range(15, 0, -2)])
    return F.conv(backwards, 16, -10).cast("long")

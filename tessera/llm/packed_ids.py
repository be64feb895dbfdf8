"""Operator 8: token ids packed into matrices and written as binary.

Each task tokenises its documents, cuts overlong ones losslessly into pieces
of at most one sequence, gathers up to ``window_ids`` ids and packs that
window by best-fit decreasing with a segment-tree search over the bins' free
capacities.  A packed sequence is one row of the id matrix:

* ``ids``: little-endian unsigned 16-bit ids, padded with ``pad_id`` to the
  sequence length;
* ``cu_seqlens``: cumulative segment lengths, from 0 to the ids used;
* ``positions``: the position of every id, restarting at 0 in each segment;
* ``segments``: (doc_id, piece, start) of every segment, in order.

Nothing is shuffled, a task's memory is bounded by its window, and Spark's own
writer commits the files, so a lost executor only repeats its tasks.

Defined results: a null or empty text is the end id alone; ids may be null or
repeated; an empty table writes an empty matrix; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.binpack import best_fit_decreasing
from tessera.llm.tokens import MAX_TOKENS, default_vocabulary, encoder, in_runs, piece_bounds

#: Ids that one window of a task holds before it is packed.
WINDOW_IDS = 1 << 23


def packed_sequences(docs: DataFrame, vocabulary: str | None = None,
                     capacity: int = MAX_TOKENS, window_ids: int = WINDOW_IDS,
                     pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, ids, cu_seqlens, positions, segments."""
    vocabulary = vocabulary or default_vocabulary()
    kind = docs.schema["doc_id"].dataType.simpleString()
    segment = f"array<struct<doc_id:{kind},piece:int,start:bigint>>"

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        encode = encoder(vocabulary).encode
        held: list[tuple[object, int, int, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal done, size
            lengths = np.array([len(h[3]) for h in held], np.int64)
            bins, offsets, opened = best_fit_decreasing(lengths, capacity)
            order = np.lexsort((offsets, bins))
            cuts = np.searchsorted(bins[order], np.arange(opened + 1))
            for at in range(0, opened, 1024):
                out: list[list] = [[], [], [], [], []]
                for b in range(at, min(at + 1024, opened)):
                    members = order[cuts[b]:cuts[b + 1]]
                    row = np.full(capacity, pad_id, "<u2")
                    places = np.zeros(capacity, "<u2")
                    for m in members:
                        o, n = offsets[m], lengths[m]
                        row[o:o + n] = held[m][3]
                        places[o:o + n] = np.arange(n)
                    out[0].append((task << 33) + done + b)
                    out[1].append(row.tobytes())
                    out[2].append([0, *np.cumsum(lengths[members]).tolist()])
                    out[3].append(places.tobytes())
                    out[4].append([{"doc_id": held[m][0], "piece": held[m][1],
                                    "start": held[m][2]} for m in members])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                     pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.binary()),
                     pa.array(out[4], pa.list_(pa.struct([
                         ("doc_id", id_type), ("piece", pa.int32()), ("start", pa.int64())])))],
                    names=["sequence_id", "ids", "cu_seqlens", "positions", "segments"])
            done += opened
            held.clear()
            size = 0

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            doc_ids, row = batch.column(0).to_pylist(), 0
            for run in in_runs(batch.column(1).to_pylist()):
                for ids in encode(run):
                    for k, (s, n) in enumerate(piece_bounds(len(ids), capacity)):
                        held.append((doc_ids[row], k, s, ids[s:s + n]))
                    size += len(ids)
                    row += 1
                if size >= window_ids:
                    yield from flush()
        if held:
            yield from flush()

    return docs.select("doc_id", "text").mapInArrow(
        sequences, "sequence_id long, ids binary, cu_seqlens array<int>, positions binary,"
                   f" segments {segment}")


def write_packed(docs: DataFrame, path: str, vocabulary: str | None = None,
                 capacity: int = MAX_TOKENS, window_ids: int = WINDOW_IDS) -> None:
    """Write the packed matrices of *docs* to the folder *path*."""
    (packed_sequences(docs, vocabulary, capacity, window_ids)
     .write.option("compression", "zstd").parquet(path))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def unpacked(matrix: DataFrame) -> DataFrame:
    """One row per segment of a written matrix: doc_id, piece, start, length,
    ids_crc32 (of the ids as unsigned 32-bit), sequence_id, offset.  Fails if
    positions do not restart with every segment or the padding is not last."""
    kind = matrix.schema["segments"].dataType.elementType["doc_id"].dataType.simpleString()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], "<u2")
                places = np.frombuffer(row["positions"], "<u2")
                cuts = row["cu_seqlens"]
                for a, b, s in zip(cuts[:-1], cuts[1:], row["segments"], strict=True):
                    if places[a] or places[b - 1] != b - a - 1:
                        raise ValueError(f"positions of sequence {row['sequence_id']}")
                    crc = zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for column, value in zip(out, (s["doc_id"], s["piece"], s["start"], b - a,
                                                   crc, row["sequence_id"], a)):
                        column.append(value)
            id_type = batch.schema.field("segments").type.value_type.field("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], id_type), pa.array(out[1], pa.int32()),
                 *(pa.array(c, pa.int64()) for c in out[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                       "offset"])

    return matrix.mapInArrow(
        segments, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long,"
                  " sequence_id long, offset long")

"""Operator 2: bound-certified best-fit-decreasing packing.

Every document becomes its ids plus an end id; only documents longer than a
sequence are cut, into full pieces (the first takes the remainder).  Pieces
are dealt to groups of bounded size.  Each group packs its pieces by best-fit
decreasing and certifies its bin count with a dual-feasible-function lower
bound.  Groups whose count is above their bound keep their full bins; the
pieces of their other bins are pooled over all such groups, dealt anew into
fewer groups and packed again, until every group is certified, the pool is one
group, or ``rounds`` is used up.

Only piece rows (a few numbers each) are shuffled; a group has about
``group_rows`` rows whatever the input, and repeated rows are dealt by their
place in a written table, so no id can overfill a group.

Defined results: a null or empty text is the end id alone; ids may be null or
repeated (each row is packed for itself); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.binpack import best_fit_decreasing, lower_bound
from tessera.llm.common import materialise
from tessera.llm.tokens import MAX_TOKENS, default_vocabulary, encoder, in_runs, piece_bounds

GROUP_ROWS = 65_536
ROUNDS = 4


def token_pieces(docs: DataFrame, vocabulary: str | None = None,
                 capacity: int = MAX_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    vocabulary = vocabulary or default_vocabulary()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            row, rows, piece, start, length, crc = 0, [], [], [], [], []
            for run in in_runs(batch.column(1).to_pylist()):
                for ids in encode(run):
                    raw = ids.astype("<u4").tobytes()
                    for k, (s, n) in enumerate(piece_bounds(len(ids), capacity)):
                        rows.append(row)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(raw[4 * s:4 * (s + n)]))
                    row += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        pieces, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _packer(capacity: int, round_no: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets, opened = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        full = np.bincount(bins, weights=lengths, minlength=opened).astype(np.int64) == capacity
        number = int(group["_group"].iloc[0]) if len(group) else 0
        return group.drop(columns=["_group"]).assign(
            sequence_id=(round_no << 56) + (number << 24) + bins, offset=offsets,
            group_bins=opened, group_bound=bound, settled=full[bins] | (opened == bound))

    return pack


def pack(pieces: DataFrame, capacity: int = MAX_TOKENS, group_rows: int = GROUP_ROWS,
         rounds: int = ROUNDS) -> DataFrame:
    """*pieces* (any columns, with ``length`` from 1 to *capacity*) plus
    sequence_id and offset, and of the group that packed the row group_bins
    and group_bound.  ``pieces`` must be a written table (it is read twice)."""
    whole = (pieces.filter(F.col("length") == capacity)
             .withColumn("sequence_id", F.monotonically_increasing_id() + F.lit(1 << 62))
             .withColumn("offset", F.lit(0).cast("long"))
             .withColumn("group_bins", F.lit(1).cast("long"))
             .withColumn("group_bound", F.lit(1).cast("long")))
    result, pool, before = whole, pieces.filter(F.col("length") < capacity), None
    for round_no in range(1, rounds + 1):
        rows = pool.count()
        groups = max(1, -(-rows // group_rows))
        if before is not None:
            groups = min(groups, max(1, before // 2))
        place = F.xxhash64(F.monotonically_increasing_id(), F.lit(round_no))
        dealt = pool.withColumn("_place", place).withColumn(
            "_group", F.pmod("_place", F.lit(groups)).cast("int")).drop("_place")
        fields = ", ".join(f"`{c}` {t}" for c, t in dealt.drop("_group").dtypes)
        packed = materialise(dealt.groupBy("_group").applyInPandas(
            _packer(capacity, round_no),
            f"{fields}, sequence_id long, offset long, group_bins long, group_bound long,"
            " settled boolean"), "packed")
        last = round_no == rounds or before == 1 or groups == 1
        result = result.unionByName((packed if last else packed.filter("settled")).drop("settled"))
        if last:
            break
        pool = packed.filter(~F.col("settled")).select(*pieces.columns)
        before = groups
    return result


def packed_documents(docs: DataFrame, vocabulary: str | None = None,
                     capacity: int = MAX_TOKENS, group_rows: int = GROUP_ROWS,
                     rounds: int = ROUNDS) -> DataFrame:
    """Tokenise and pack: one row per piece with its sequence and place there."""
    pieces = materialise(token_pieces(docs, vocabulary, capacity), "pieces")
    return pack(pieces, capacity, group_rows, rounds)

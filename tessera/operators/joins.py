"""Joins (survey 2C) and the size-checked broadcast used across the library.

Broadcasting is only done behind an explicit check of rows and bytes (one
distributed aggregate); above the bounds the join falls back to a shuffle
join, where AQE's skew-join split handles hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Bounds under which a join side is shipped to every executor.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 8 a number, 16 and its length a string or
    binary, anything nested by the length of its JSON form."""
    total = F.lit(0).cast("long")
    for field in df.schema:
        kind, c = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (StringType, BinaryType)):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            total = total + 16 + F.octet_length(F.to_json(F.struct(c)))
        else:
            total = total + 8
    return total


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether *df* is within both bounds; counted on the executors."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its size is proven small, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def inner_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """C01."""
    return left.join(right, on, "inner")


def left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Single or composite key."""
    return left.join(right, on, "left")


def semi_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """``key IN (subquery)``."""
    return left.join(right, on, "left_semi")


def remove_keys(df: DataFrame, unwanted: DataFrame, key: str = "UserID") -> DataFrame:
    """Anti-join (``NOT IN`` without its NULL trap).  The exclusion list
    grows with the data, so no broadcast hint: AQE broadcasts it at run time
    when its measured size is under the threshold, else it is a shuffle join."""
    return df.join(unwanted.select(key).distinct(), key, "left_anti")


def star_left_join(base: DataFrame, parts: Sequence[DataFrame], key: str = "UserID") -> DataFrame:
    """Left-join per-key feature tables onto a one-row-per-key base.

    Every part must already be at key grain (one row per key); then the join
    keeps one row per key by construction and no de-duplication pass is
    needed.  All parts are aggregated by ``key``, so their hash partitioning
    on ``key`` is reused by the joins."""
    out = base
    for part in parts:
        out = out.join(part, key, "left")
    return out


def compare_on_key(a: DataFrame, b: DataFrame, key: str, col: str) -> DataFrame:
    """Rows whose ``col`` disagrees between two tables (null-safe)."""
    left = a.select(key, F.col(col).alias(f"{col}_a"))
    right = b.select(key, F.col(col).alias(f"{col}_b"))
    j = left.join(right, key, "left")
    return j.filter(~F.col(f"{col}_a").eqNullSafe(F.col(f"{col}_b")))


def salted_equi_join(big: DataFrame, small: DataFrame, key: str | Sequence[str],
                     salts: int = 16, how: str = "inner",
                     salt_of: Column | None = None) -> DataFrame:
    """Equi-join that spreads hot keys of ``big`` across ``salts`` tasks by
    replicating the (smaller) side ``salts`` times."""
    keys = [key] if isinstance(key, str) else list(key)
    # Deterministic salt (a hash of the row), so a recomputed partition after
    # an executor loss routes every row exactly as the first attempt did.
    salt_expr = salt_of if salt_of is not None else F.hash(*[F.col(c) for c in big.columns])
    b = big.withColumn("_salt", F.pmod(F.hash(salt_expr), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return b.join(s, keys + ["_salt"], how).drop("_salt")

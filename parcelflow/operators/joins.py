"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A check list or key set above this many rows or bytes is joined by shuffle instead.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 ** 2


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row's values take."""
    total = F.lit(16)
    for f in schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
        else:
            total = total + 8
    return total.cast("long")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only if it holds at most ``max_rows`` rows and
    ``max_bytes`` bytes.

    The check reads ``limit(max_rows + 1)`` rows, so it stops once the bound is
    passed; above either bound the join falls back to a shuffle join (and
    AQE may still convert it at runtime from real shuffle sizes).  The small
    side is computed twice -- for the check and inside the plan -- which costs
    far less than shuffling the big side, and nothing stays cached.
    """
    size = df.limit(max_rows + 1).select(row_bytes(df.schema).alias("b"))
    rows, total = size.agg(F.count(F.lit(1)), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and total <= max_bytes else df


def null_safe_on(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond

"""Primary keys across loads: a Bloom filter over the stored keys in front of
an exact semi join.

The filter is a table of bit maps (``bitmap_construct_agg``), one row per block
of ``BLOCK_BITS`` bits; a key sets ``HASHES`` bits of the block that its hash
names.  Filters of several loads are kept side by side, so a load adds its own
rows and never rebuilds.  A key whose bits are not all set in any load's block
is new for certain, and only the others, a few false ones among them, are
looked up in the stored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.operators.joins import bounded_broadcast, null_safe_on

BLOCK_BITS = 32_768
HASHES = 4
#: Bits per key: 4 hashes in blocks of this load give about 0.3 % false ones.
BITS_PER_KEY = 16

FILTER = T.StructType([T.StructField("blocks", T.LongType()), T.StructField("block", T.LongType()),
                       T.StructField("bits", T.BinaryType())])


def _block(pk: list[str], blocks) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), *pk), blocks)


def _positions(pk: list[str]) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *pk), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def key_filter(rows: DataFrame, pk: list[str]) -> DataFrame:
    """The filter of the rows' keys (blocks, block, bits); 4 KB a block."""
    need = -(-rows.count() * BITS_PER_KEY // BLOCK_BITS)
    blocks = 1 << max(0, need - 1).bit_length()  # powers of two: all filters have a few sizes
    bits = rows.select(_block(pk, F.lit(blocks)).alias("block"), F.explode(F.array(*_positions(pk))).alias("at"))
    return (bits.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))
            .select(F.lit(blocks).cast("long").alias("blocks"), "block", "bits"))


def _is_set(at: Column) -> Column:
    byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1


def might_be_stored(rows: DataFrame, filters: DataFrame, pk: list[str]) -> DataFrame:
    """The rows whose key some filter may hold: all stored ones, few others."""
    sizes = [r.blocks for r in filters.select("blocks").distinct().collect()]  # powers of two: at most 63
    if not sizes:
        return rows.where("false")
    probe = rows.withColumn("_blocks", F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")))
    probe = probe.withColumn("_block", _block(pk, F.col("_blocks")))
    hit = F.lit(True)
    for at in _positions(pk):
        hit = hit & _is_set(at)
    # a row has one block per size, which several loads may have filled
    maps = filters.select(F.col("blocks").alias("_blocks"), F.col("block").alias("_block"), "bits")
    return probe.join(maps, ["_blocks", "_block"]).where(hit).select(*rows.columns).distinct()


def stored_duplicates(rows: DataFrame, stored: DataFrame, pk: list[str],
                      filters: DataFrame | None = None) -> DataFrame:
    """The distinct rows whose key is in ``stored``.  With ``filters`` of the
    stored keys only rows that may be stored are looked up, and nothing of
    ``stored`` is read where there are none."""
    if filters is not None:
        rows = might_be_stored(rows, filters, pk).checkpoint()
        if rows.isEmpty():
            return rows
    wanted = bounded_broadcast(rows.select(*pk).distinct())
    keys = stored.select(*pk)
    keys = keys.join(wanted, null_safe_on(keys, wanted, pk), "left_semi").distinct()
    return rows.distinct().join(keys, null_safe_on(rows, keys, pk), "left_semi")

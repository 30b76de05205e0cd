"""Sets of keys as bitmaps: a filter that lets every member through, and few others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Places of a bitmap as powers of two. Spark keeps 2 ** 15 of them (4 KB) in one row, so the
# whole set is broadcast as 4 KB at least and 8 MB at most, however many keys it holds.
LEAST_BITS, MOST_BITS = 15, 26


def place_bits(rows: int) -> int:
    """Sixteen places a key, so that about one foreign key in sixteen passes; a set of more than
    four million keys lets more of them through, never a member less."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * rows).bit_length()))


def _place(keys: list[str], bits: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1)) + 1


def key_bitmap(rows: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """The keys of `rows` as bitmaps (bucket, bits). Combined before the shuffle, so a map task
    sends its bitmaps and no keys. Null keys are members like others."""
    place = _place(keys, bits)
    return rows.groupBy(F.bitmap_bucket_number(place).alias("key_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("key_bits")
    )


def perhaps_in(rows: DataFrame, bitmap: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """The rows whose key is in the set, and few others; no shuffle of `rows`.

    Use it before an exact comparison. `bits` is that of the bitmap.
    """
    place = _place(keys, bits)
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("key_bits", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("long"), position.bitwiseAND(F.lit(7)).cast("int")) == 1
    found = rows.join(F.broadcast(bitmap), F.bitmap_bucket_number(place) == F.col("key_bucket"))
    return found.filter(is_set).select(*rows.columns)

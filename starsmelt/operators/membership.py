"""A set of keys as a bitmap of fixed size, to ask of every row of a large table whether its key may be in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 4096 buckets of 32,768 bits, 16 MB, whatever the number of keys.
BUCKETS, BUCKET_BITS = 4096, 32_768
_WORDS = BUCKET_BITS // 64


def _place(keys: Sequence[str]) -> Column:
    """Bit of a key, NULL members included. Equal keys have equal bits."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS * BUCKET_BITS))


def key_bitmap(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``bucket, words``: the bits of all members, at most 4096 rows of 512 longs.

    The bits of a task are united before they move, so that every task sends 16 MB at most.
    """
    placed = members.select(_place(keys).alias("place"))
    bits = placed.groupBy(F.floor(F.col("place") / BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("place") % BUCKET_BITS).alias("bits"))
    word = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda k: F.conv(
        F.hex(F.substring(F.col("bits"), k * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    return bits.select("bucket", word.alias("words"))


def mark_members(df: DataFrame, keys: Sequence[str], bitmap: DataFrame, mark: str) -> DataFrame:
    """``df`` with a boolean column ``mark``: false where the key is not among the members.

    True is not certain: other keys may share a bit. With k members, a share of 1 - exp(-k / 2**27) of
    the others is marked too, 1 in 100 at 1.3 million. The rows stay where they are: the bitmap, of
    fixed size, is broadcast, also where nothing else may be.
    """
    place = _place(keys)
    # bytes hold their bits from the lowest, words their bytes from the highest
    at = place % BUCKET_BITS
    word, byte, bit = F.floor(at / 64), F.floor(at / 8) % 8, at % 8
    shift = ((7 - byte) * 8 + bit).cast("int")
    wide = df.withColumn("_of_bucket", F.floor(place / BUCKET_BITS))
    bits = bitmap.select(F.col("bucket").alias("_in_bucket"), F.col("words").alias("_in_words"))
    joined = wide.join(F.broadcast(bits), F.col("_of_bucket") == F.col("_in_bucket"), "left")
    found = F.call_function("shiftrightunsigned", F.get("_in_words", word.cast("int")), shift).bitwiseAND(F.lit(1)) == 1
    return joined.select(*[F.col(name) for name in df.columns], F.coalesce(found, F.lit(False)).alias(mark))

"""Blocked Bloom filters as Spark tables (DataFrame functions only).

A 64-bit hash picks one 64-bit word and two bits in it. A filter is a table
``(bloom_word long, bloom_mask long)`` holding the words with any bit set; a
row passes when both its bits are set, one broadcast hash lookup per row.

The number of words follows the number of rows (32 bits a row) up to
``max_words``, so the broadcast has a proven bound: 2**21 words of 16 bytes,
32 MB of data. Past the bound the filter is fuller and lets more rows
through; filters have no false negatives, so results stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WORDS = 1 << 21


def n_words(rows: int, max_words: int = MAX_WORDS) -> int:
    """Power of two with 32 bits a row, at least 1024 words, at most ``max_words``."""
    want = 1024
    while want < max_words and want * 2 < rows:
        want *= 2
    return want


def with_bits(df: DataFrame, hash_col: Column, words: int) -> DataFrame:
    """Adds ``bloom_word`` and two different bits in it, ``bloom_b1`` and ``bloom_b2``."""
    b1 = hash_col.bitwiseAND(F.lit(63)).cast("int")
    step = F.pmod(F.shiftrightunsigned(hash_col, 6).bitwiseAND(F.lit(1023)), F.lit(63)).cast("int")
    word = F.shiftrightunsigned(hash_col, 16).bitwiseAND(F.lit(words - 1).cast("long"))
    return df.withColumns({"bloom_word": word, "bloom_b1": b1, "bloom_b2": (b1 + 1 + step) % 64})


def _bit(name: str) -> Column:
    return F.expr(f"shiftleft(1L, {name})")


def member_filter(df: DataFrame) -> DataFrame:
    """Filter of every row of ``df`` (which has the columns of ``with_bits``)."""
    return df.groupBy("bloom_word").agg(F.bit_or(_bit("bloom_b1").bitwiseOR(_bit("bloom_b2"))).alias("bloom_mask"))


def repeat_filter(df: DataFrame) -> DataFrame:
    """Filter of the bits that two or more rows of ``df`` set.

    Each bit is counted, combined in every map task first, so a hash that a
    third of the rows share sends one row a task.
    """
    bits = df.select(F.explode(F.expr("array(bloom_word * 64 + bloom_b1, bloom_word * 64 + bloom_b2)")).alias("bit"))
    twice = bits.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (twice.groupBy(F.shiftrightunsigned("bit", 6).alias("bloom_word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bloom_mask")))


def probe(df: DataFrame, bloom: DataFrame, flag: str) -> DataFrame:
    """Adds the boolean ``flag`` (possibly in the filter), drops the bit columns."""
    need = _bit("bloom_b1").bitwiseOR(_bit("bloom_b2"))
    hit = F.coalesce(F.col("bloom_mask").bitwiseAND(need) == need, F.lit(False))
    return (df.join(F.broadcast(bloom), "bloom_word", "left").withColumn(flag, hit)
              .drop("bloom_word", "bloom_b1", "bloom_b2", "bloom_mask"))

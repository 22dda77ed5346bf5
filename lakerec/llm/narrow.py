"""Rows that cannot meet a set of keys are told before a shuffle, by a broadcast bitmap of the keys' hashes.

A join of few keys with whole texts shuffles every text, although most meet nothing. The bitmap has ``BITS`` bits a key
and ``WORDS`` words of 64 bits at most, so what is broadcast is bounded. It never leaves out a row whose key is
wanted; about one in ``BITS`` of the others passes as well, more where there are so many keys that the bound holds.
The join itself still follows and decides. A null in a key hashes like any other value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 16
WORDS = 1 << 20


def _place(key: list[Column], words: int) -> tuple[Column, Column]:
    """The word and the bit of a key."""
    value = F.xxhash64(*key)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(value, F.lit(64)).cast("int"))
    return F.pmod(F.shiftrightunsigned(value, 6), F.lit(words)), bit


def marked(rows: DataFrame, key: list[Column], wanted: DataFrame, wanted_key: list[Column], name: str = "__met") -> DataFrame:
    """``rows`` and the boolean ``name``: false where ``key`` is none of the ``wanted_key`` of stored ``wanted``.

    Both keys have the same types.
    """
    words = min(WORDS, max(1, wanted.count() * BITS // 64))
    word, bit = _place(wanted_key, words)
    bits = wanted.select(word.alias("__word"), bit.alias("__bit")).groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    word, bit = _place(key, words)
    joined = rows.withColumn("__at", word).join(F.broadcast(bits), F.col("__at") == F.col("__word"), "left")
    met = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return joined.withColumn(name, met).drop("__at", "__word", "__bits")


def meeting(rows: DataFrame, key: list[Column], wanted: DataFrame, wanted_key: list[Column]) -> DataFrame:
    """The ``rows`` that may have a ``key`` of stored ``wanted``."""
    return marked(rows, key, wanted, wanted_key).where("__met").drop("__met")

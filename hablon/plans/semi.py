"""Semi-join reduction by a bitmap of fixed size, for large inputs of which few rows have a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _place(key: str, bits: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    return F.shiftright(at, 6), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64({key}), {1 << bits}L), 64L) as int))")


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """``word, mask``: at most 2^(bits - 6) rows, whatever the number of keys."""
    word, bit = _place(key, bits)
    return keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))


def maybe_in(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """Rows whose key may be among those of the bitmap; all that are stay. With more keys than bits few rows go, and the
    join that follows does the rest. The broadcast is bounded by the size of the bitmap."""
    word, bit = _place(key, bits)
    marked = df.select("*", word.alias("word"), bit.alias("bit"))
    return marked.join(F.broadcast(words), "word").where(F.col("mask").bitwiseAND(F.col("bit")) != 0).select(*df.columns)


def maybe_not_in(df: DataFrame, key: str, words: DataFrame, bits: int) -> DataFrame:
    """The rows that ``maybe_in`` leaves out."""
    word, bit = _place(key, bits)
    marked = df.select("*", word.alias("word"), bit.alias("bit"))
    return marked.join(F.broadcast(words), "word", "left").where(F.coalesce(F.col("mask"), F.lit(0)).bitwiseAND(F.col("bit")) == 0).select(*df.columns)

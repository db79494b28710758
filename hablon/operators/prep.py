"""Corpus preparation: counts, seeded order, exact samples, balancing and splits without a global sort in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hablon.functions.text import pytrim, squeeze, word_count

BUCKET_ROWS = 1_000_000  # rows of a bucket of the first hash digits; ranks are counted per bucket


def shuffle_key(seed: int, *keys: str) -> Column:
    """A reproducible pseudorandom sort key of a row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def dense_rank_by(df: DataFrame, key: Column, name: str, *ties: str) -> DataFrame:
    """``df`` with its 1-based rank by a hexadecimal hash key: buckets of the key are counted first, so that each window
    holds one bucket of about ``BUCKET_ROWS`` rows and not the table. Building the result counts the table once."""
    digits = 2 if df.count() <= 256 * BUCKET_ROWS else 3  # a bucket of three digits has 2^-12 of the rows
    keyed = df.withColumns({"__key": key}).withColumn("__bucket", F.substring("__key", 1, digits))
    sums = keyed.groupBy("__bucket").agg(F.count("*").alias("__n"))  # at most 4,096 rows
    before = sums.select("__bucket", (F.sum("__n").over(Window.orderBy("__bucket")) - F.col("__n")).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy("__key", *ties))
    return keyed.withColumn("__r", inside).join(F.broadcast(before), "__bucket").withColumn(name, F.col("__base") + F.col("__r")).drop("__bucket", "__n", "__base", "__r", "__key")


def corpus_counts(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, and their white-space separated words, per ``side``."""
    return lines.where(pytrim("text") != "").groupBy("side").agg(F.count("*").alias("lines"), F.sum(word_count("text")).alias("words"))


def corpus_ratio(lines: DataFrame, first: str, second: str) -> DataFrame:
    """``line_ratio, word_ratio``: lines and words of one side for each of the other; NULL if that side is empty."""
    n = lambda side, c: F.coalesce(F.max(F.when(F.col("side") == side, F.col(c))), F.lit(0))
    ratio = lambda c: F.try_divide(n(first, c), n(second, c))
    return corpus_counts(lines).agg(ratio("lines").alias("line_ratio"), ratio("words").alias("word_ratio"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """White space collapsed, blank lines dropped."""
    return lines.where(F.col("text").rlike(r"(?U)\S")).withColumn("text", squeeze("text"))


def shuffled(df: DataFrame, seed: int, *keys: str) -> DataFrame:
    """``df`` with ``position``, its 1-based place in a seeded order. Equal keys are ordered by nothing else."""
    return dense_rank_by(df, shuffle_key(seed, *keys), "position", *keys)


def downsample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """Exactly min(n, rows) rows without replacement; none for n <= 0."""
    return shuffled(df, seed, *keys).where(F.col("position") <= n).drop("position")


def upsample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """Exactly n rows with replacement, with ``draw``; none from an empty table."""
    numbered = shuffled(df, seed, *keys)
    rows = df.count()
    if rows == 0 or n <= 0:
        return numbered.withColumnRenamed("position", "draw").limit(0)
    pick = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("draw").cast("string"))), 1, 8), 16, 10).cast("long"), F.lit(rows)) + 1
    draws = df.sparkSession.range(1, n + 1).select(F.col("id").alias("draw")).withColumn("position", pick)
    return draws.join(numbered, "position").drop("position")


def balance(first: DataFrame, second: DataFrame, strategy: str, seed: int, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Both corpora after ``down_first`` (to the size of the second), ``up_second`` (to that of the first) or
    ``balanced`` (both to the smaller size)."""
    a, b = first.count(), second.count()
    if strategy == "down_first":
        return downsample(first, b, seed, *keys), second
    if strategy == "up_second":
        return first, (upsample(second, a, seed, *keys).drop("draw") if b < a else second)
    if strategy == "balanced":
        return downsample(first, min(a, b), seed, *keys), downsample(second, min(a, b), seed, *keys)
    raise ValueError(f"unknown strategy {strategy}")


def concat(*parts: DataFrame) -> DataFrame:
    """Parts below each other, in an order kept by ``(part, line_no)``."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn("part", F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out


def split(df: DataFrame, dev_share: float, seed: int, *keys: str) -> DataFrame:
    """``df`` with ``split``: the first ceil(n (1 - share)) rows of a seeded order are ``train``, the rest ``dev``."""
    n = df.count()
    return shuffled(df, seed, *keys).withColumn("split", F.when(F.col("position") <= math.ceil(n * (1 - dev_share)), "train").otherwise("dev")).drop("position")

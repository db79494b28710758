"""Joins by position and by key, incremental merges, overlays and checks of completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RANGES, MOST_RANGES = 64, 1024  # ranges of the order key that are numbered side by side, at least and at most
RANGE_ROWS = 1_000_000  # rows of a range beyond the least number of ranges
SAMPLE = 100  # keys a range about which the bounds of the ranges are guessed; they decide on balance only


def _range_of(key: Column, bounds: list) -> Column:
    """How many of the sorted bounds are not above the key, found by halving."""
    if not bounds:
        return F.lit(0)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(bounds))


def numbered(df: DataFrame, order: str, *partition: str) -> DataFrame:
    """``line_no`` from 1 by order, within a partition or over the whole table.

    Ranges of the order key are counted and numbered side by side, so that neither the table nor a partition that holds
    much of it is in one task. The bounds of the ranges are constants of the plan, so that counting and numbering see the
    same ranges; their number grows with the table. Building the result counts the table and samples its keys. NULL keys come first, NULL partitions are one partition; the order among equal keys is open.
    """
    rows = df.count()
    ranges = min(MOST_RANGES, max(RANGES, rows // RANGE_ROWS))
    wanted = ranges * SAMPLE
    seen = sorted(r[0] for r in df.select(order).where(F.col(order).isNotNull()).sample(min(1.0, wanted / max(rows, 1)), 7).limit(4 * wanted).collect())
    bounds = sorted({seen[i * len(seen) // ranges] for i in range(1, ranges)}) if seen else []
    at = _range_of(F.col("__k"), bounds)
    ranged = df.withColumn("__k", F.col(order)).withColumn("__p", F.when(F.col("__k").isNull(), 0).otherwise(at))
    keys = [F.col(c).alias(f"__{i}") for i, c in enumerate(partition)]
    names = [f"__{i}" for i in range(len(partition))]
    sums = ranged.groupBy(*keys, F.col("__p").alias("__q")).agg(F.count("*").alias("__n"))  # at most RANGES rows per partition
    before = sums.select(*names, "__q", (F.sum("__n").over(Window.partitionBy(*names).orderBy("__q")) - F.col("__n")).alias("__b"))
    inside = ranged.withColumn("__r", F.row_number().over(Window.partitionBy(*partition, "__p").orderBy(order)))
    same = F.col("__p") == F.col("__q")
    for c, n in zip(partition, names):
        same = same & inside[c].eqNullSafe(before[n])
    return inside.join(before if partition else F.broadcast(before), same).withColumn("line_no", F.col("__b") + F.col("__r")).select(*[inside[c] for c in df.columns if c != "line_no"], "line_no")


def zip_truncate(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """Lines of equal number side by side, as far as the shorter side goes."""
    on = [*keys, "line_no"]
    return first.select(*on, F.col("text").alias("src")).join(second.select(*on, F.col("text").alias("tgt")), on)


def zip_pad(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """Lines of equal number side by side, the shorter side padded with empty text."""
    on = [*keys, "line_no"]
    out = first.select(*on, F.col("text").alias("src")).join(second.select(*on, F.col("text").alias("tgt")), on, "full")
    return out.fillna("", ["src", "tgt"])


def aligned(first: DataFrame, second: DataFrame, *keys: str) -> DataFrame:
    """Verses of both versions by their key."""
    return first.select(*keys, F.col("text").alias("src")).join(second.select(*keys, F.col("text").alias("tgt")), list(keys))


def merge_new(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """The old rows and those new ones whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def intersection(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows that both have."""
    return first.intersect(second)


def difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second has not."""
    return first.subtract(second)


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been visited."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def _last(changes: DataFrame, key: str, order: str | None) -> DataFrame:
    """One row per key: the last by ``order``; without one, of differing rows the one with the greatest content."""
    row = F.struct(*changes.columns)
    at = F.struct(F.col(order), F.to_json(row)) if order else F.to_json(row)
    return changes.groupBy(F.col(key).alias("__k")).agg(F.max_by(row, at).alias("__r")).select("__r.*")


def overlay(rows: DataFrame, edits: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """Rows with edited values where there are edits; of several edits of a key the last by ``order`` counts."""
    e = _last(edits, key, order).select(key, F.col(value).alias("__v"), F.lit(True).alias("__e"))
    return rows.join(e, key, "left").withColumn(value, F.when(F.col("__e"), F.col("__v")).otherwise(F.col(value))).select(*rows.columns)


def upsert(rows: DataFrame, changes: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Rows replaced or added by key, columns as in ``rows``; of several changes of a key the last by ``order`` counts. A NULL
    key equals no other, so such changes are one further row."""
    last = _last(changes, key, order)
    kept = rows.join(last.select(key), key, "left_anti")
    return kept.select(*rows.columns).unionByName(last.select(*rows.columns))


def incomplete(parts: DataFrame, expected: DataFrame, group: str, part: str, n: str) -> DataFrame:
    """Groups of which fewer distinct parts are there than expected."""
    have = parts.groupBy(group).agg(F.count_distinct(part).alias("have"))
    return expected.join(have, group, "left").select(group, n, F.coalesce("have", F.lit(0)).alias("have")).where(F.col("have") < F.col(n))

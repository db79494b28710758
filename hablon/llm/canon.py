"""Duplicates hidden by formatting: canonical text, 128-bit keys, map-side counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.functions.text import letters_digits

SALTS = 64  # a group of copies is spread over so many tasks


def canonical_pair(first: str, second: str) -> tuple[Column, Column]:
    """Both fields as lower-cased letters and digits, in an order that does not depend on the field order."""
    a, b = letters_digits(first), letters_digits(second)
    return F.least(a, b), F.greatest(a, b)


def pair_keys(first: Column, second: Column) -> tuple[Column, Column]:
    """A 128-bit key of the two canonical fields, and an independent 64-bit hash that tells colliding keys apart.

    The length prefix keeps ("ab", "c") and ("a", "bc") apart.
    """
    whole = F.concat(F.length(first).cast("string"), F.lit(":"), first, F.lit("|"), second)
    return F.unhex(F.md5(whole)), F.xxhash64(whole)


def keyed(df: DataFrame, id_col: str, first: str, second: str) -> DataFrame:
    """``rid, k, x``: id and keys of every row."""
    lo, hi = canonical_pair(first, second)
    return (
        df.select(F.col(id_col).alias("rid"), lo.alias("lo"), hi.alias("hi"))
        .select("rid", *[c.alias(n) for c, n in zip(pair_keys(F.col("lo"), F.col("hi")), ("k", "x"))])
    )


def _partial(rows: DataFrame) -> DataFrame:
    """Counts per key and salt, so no task ever sees a whole hot group."""
    return rows.groupBy("k", "x", "salt").agg(F.min("rid").alias("least"), F.count("*").alias("n"))


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))


def collapse(df: DataFrame, id_col: str = "row_id", first: str = "src", second: str = "tgt") -> DataFrame:
    """One row per distinct record with the number of its copies.

    Result: every column of ``df`` for the row with the smallest id of each group, and ``n_copies``. NULL fields count
    as empty, so records with two empty fields form one group; an empty table gives an empty result. A second hash in
    the grouping key separates records whose 128-bit keys collide. A column of the input named ``n_copies`` is
    replaced. A row repeated with its id counts as a copy; rows without an id are copies that never represent a group.
    """
    groups = _partial(_salted(keyed(df, id_col, first, second))).groupBy("k", "x").agg(F.min("least").alias("__rep"), F.sum("n").alias("__n"))
    rest = [c for c in df.columns if c != "n_copies"]
    return df.select(*[df[c] for c in rest]).join(groups.select("__rep", "__n"), F.col(id_col) == F.col("__rep")).select(*rest, F.col("__n").alias("n_copies")).dropDuplicates([id_col])


def copies(df: DataFrame, id_col: str = "row_id", first: str = "src", second: str = "tgt") -> DataFrame:
    """``row_id_a, row_id_b``: the smallest id of each group of copies with each other id of the group.

    A row without copies gives no row. The representative travels only to the (key, salt) parts in which its group has
    rows, so a group that holds a third of the table is still joined by many tasks.
    """
    rows = _salted(keyed(df, id_col, first, second))
    groups = (
        _partial(rows)
        .groupBy("k", "x")
        .agg(F.min("least").alias("rep"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
        .where("n > 1")
        .select("k", "x", "rep", F.explode("salts").alias("salt"))
    )
    return rows.join(groups, ["k", "x", "salt"]).where("rid <> rep").select(F.col("rep").alias("row_id_a"), F.col("rid").alias("row_id_b"))

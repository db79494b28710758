"""Positional and keyed row edits. Positions are 0-based and dense in ``position``; edits keep them dense.

Renumbering after deletions counts the deleted positions below each row, which needs only the deleted set, not a global
window over the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.operators.extract import slug
from hablon.operators.keyed import numbered

POS = "position"
MOST_LISTED = 1000  # deleted positions that are written into the plan; more are joined


def update_cell(df: DataFrame, row: int, col: str, value: str) -> DataFrame:
    """One cell set; a row out of range changes nothing."""
    return df.withColumn(col, F.when(F.col(POS) == row, F.lit(value)).otherwise(F.col(col)))


def delete_rows(df: DataFrame, rows: list[int]) -> DataFrame:
    """Rows removed, the rest moved up. Repeated and unknown positions are harmless."""
    gone = sorted(set(rows))
    if not gone:
        return df
    if len(gone) > MOST_LISTED:
        return delete_many(df, df.sparkSession.createDataFrame([(r,) for r in gone], f"`{POS}` {df.schema[POS].dataType.simpleString()}"))
    below = F.size(F.filter(F.array(*map(F.lit, gone)), lambda g: g < F.col(POS)))
    return df.where(~F.col(POS).isin(gone)).withColumn(POS, (F.col(POS) - below).cast(df.schema[POS].dataType))


def delete_many(df: DataFrame, gone: DataFrame) -> DataFrame:
    """The same for positions given as a table, which may be of any size: rows are removed by an anti-join and numbered anew."""
    left = df.join(gone.select(POS), POS, "left_anti").withColumn("__old", F.col(POS))
    out = numbered(left, "__old")
    return out.withColumn(POS, (F.col("line_no") - 1).cast(df.schema[POS].dataType)).select(*df.columns)


def delete_row(df: DataFrame, row: int) -> DataFrame:
    return delete_rows(df, [row])


def move_rows(df: DataFrame, rows: list[int], up: bool) -> DataFrame:
    """Each selected row trades places with its neighbour unless that one is selected or missing, so that of a run only
    the edge row moves."""
    chosen = set(rows)
    n = df.count()
    moves: dict[int, int] = {}
    for r in sorted(chosen):
        other = r - 1 if up else r + 1
        if 0 <= r < n and 0 <= other < n and other not in chosen and other not in moves:
            moves[r], moves[other] = other, r
    if not moves:
        return df
    table = F.create_map(*[F.lit(x) for kv in moves.items() for x in kv])
    return df.withColumn(POS, F.coalesce(F.element_at(table, F.col(POS).cast("int")), F.col(POS)).cast(df.schema[POS].dataType))


def move_block(df: DataFrame, first: int, last: int, up: bool) -> DataFrame:
    """A whole run of rows moved by one place."""
    n = df.count()
    other = first - 1 if up else last + 1
    if not (0 <= first <= last < n and 0 <= other < n):
        return df
    step = -1 if up else 1
    p = F.col(POS)
    new = F.when((p >= first) & (p <= last), p + step).when(p == other, p - step * (last - first + 1)).otherwise(p)
    return df.withColumn(POS, new.cast(df.schema[POS].dataType))


def insert_blank(df: DataFrame, after: int) -> DataFrame:
    """A row of empty text after a position, which is clamped to the table."""
    n = df.count()
    at = max(0, min(after + 1, n))
    moved = df.withColumn(POS, F.when(F.col(POS) >= at, F.col(POS) + 1).otherwise(F.col(POS)).cast(df.schema[POS].dataType))
    blank = [F.lit(at).cast(f.dataType).alias(f.name) if f.name == POS else (F.lit("") if f.dataType.simpleString() == "string" else F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema]
    return moved.unionByName(df.sparkSession.range(1).select(*blank))


def append_blank(df: DataFrame) -> DataFrame:
    return insert_blank(df, df.count())


def page(df: DataFrame, number: int, size: int, order: str = POS, most: int = 500) -> DataFrame:
    """One page by order; number and size are clamped."""
    size = max(1, min(size, most))
    return df.orderBy(order).offset(max(0, number) * size).limit(size)


def search(df: DataFrame, cols: list[str], text: str) -> DataFrame:
    """Rows with the text in any cell, ignoring case."""
    hit = lambda c: F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(text.lower()))
    return df.where(reduce(Column.__or__, [hit(c) for c in cols]))


def replace_all(df: DataFrame, cols: list[str], pattern: str, new: str) -> DataFrame:
    return df.withColumns({c: F.regexp_replace(F.col(c), pattern, new) for c in cols})


def replace_one(df: DataFrame, row: int, col: str, start: int, end: int, new: str) -> DataFrame:
    """One found span (0-based, end exclusive) of one cell replaced; a row out of range changes nothing."""
    value = F.overlay(F.col(col), F.lit(new), F.lit(start + 1), F.lit(end - start))
    return df.withColumn(col, F.when((F.col(POS) == row) & (F.length(col) >= end), value).otherwise(F.col(col)))


def next_position(rows: DataFrame, collection: str) -> DataFrame:
    """The place after the last row of each collection."""
    return rows.groupBy(collection).agg((F.coalesce(F.max(POS), F.lit(-1)) + 1).alias("next"))


def import_rows(rows: DataFrame, new: DataFrame, collection: str, order: str) -> DataFrame:
    """New rows appended to their collections after the last position, in their own order."""
    start = next_position(rows, collection)
    placed = numbered(new.drop("line_no"), order, collection).join(start, collection, "left")
    placed = placed.withColumn(POS, (F.coalesce("next", F.lit(0)) + F.col("line_no") - 1).cast(rows.schema[POS].dataType))
    return rows.unionByName(placed.select(*rows.columns))


def row_counts(rows: DataFrame, collections: DataFrame, key: str) -> DataFrame:
    """Rows per collection, collections without rows included."""
    return collections.select(key).join(rows.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def delete_collection(rows: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """Rows of deleted collections go with them."""
    return rows.join(deleted.select(key), key, "left_anti")


def export_lines(rows: DataFrame, headers: list[str], data: str = "data") -> DataFrame:
    """``position, line``: values of a map column in header order, joined by tabs, missing ones empty."""
    cells = F.array(*[F.coalesce(F.element_at(data, h), F.lit("")) for h in headers])
    return rows.select(POS, F.array_join(cells, "\t").alias("line"))


def export(rows: DataFrame, headers: list[str], data: str = "data") -> DataFrame:
    """``position, line`` of a whole export: the header line at -1, then the rows of ``export_lines``."""
    head = rows.sparkSession.range(1).select(F.lit(-1).cast(rows.schema[POS].dataType).alias(POS), F.lit("\t".join(headers)).alias("line"))
    return head.unionByName(export_lines(rows, headers, data))


def export_name(name: Column) -> Column:
    """The file name of an export."""
    return F.concat(slug(name), F.lit(".tsv"))


def map_columns(df: DataFrame, mapping: dict[str, str | None], headers: list[str]) -> DataFrame:
    """File columns brought under collection headers: by the mapping, else by equal name ignoring case, else empty."""
    by_name = {c.lower(): c for c in df.columns}
    pick = {h: mapping.get(h) or by_name.get(h.lower()) for h in headers}
    keep = [POS] if POS in df.columns else []
    return df.select(*keep, *[(F.coalesce(F.col(c), F.lit("")) if c else F.lit("")).alias(h) for h, c in pick.items()])


def language_columns(columns: list[str]) -> dict[str, str | None]:
    """Which columns hold which language, by their names."""
    import re

    find = lambda p: next((c for c in columns if re.search(p, c, re.I)), None)
    return {"hil": find("hil"), "en": find(r"\ben\b|english")}

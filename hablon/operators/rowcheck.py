"""Rows that fail to parse: quoting, field count and value rules as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "\u0001"  # field mark after parsing; the same character in the input is turned into U+0002 first
NOT_TEXT = "[\\x{0000}-\\x{0008}\\x{000B}\\x{000C}\\x{000E}-\\x{001F}\\x{007F}-\\x{009F}\\x{FFFD}]"


@dataclass(frozen=True)
class Field:
    """A named field with its SQL type and the rule a good value keeps (a function of the text column)."""

    name: str
    type: str
    good: object


def _not_blank_text(x: Column) -> Column:
    return x.rlike(r"(?U)[^\s\p{Z}]") & ~x.rlike(NOT_TEXT)


#: Values of the pair files, as their specification states them.
PAIR_FIELDS = (
    Field("pair_no", "decimal(38,0)", lambda x: x.rlike(r"\A[1-9][0-9]*\z")),
    Field("split", "string", lambda x: x.isin("train", "dev", "test")),
    Field("src", "string", _not_blank_text),
    Field("tgt", "string", _not_blank_text),
    Field("score", "double", lambda x: x.rlike(r"\A(|0|1|0?\.[0-9]+|0\.|1\.0*|0\.[0-9]+)\z")),
    Field("added_on", "date", lambda x: x.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & F.try_to_date(x, "yyyy-MM-dd").isNotNull()),
)
SEPARATORS = {"tsv": "\t", "csv": ",", "psv": "|", "ssv": ";"}


def separator_of(file_name: Column) -> Column:
    """The separator that the suffix of a file name stands for; NULL for another suffix."""
    suffix = F.lower(F.regexp_extract(file_name, r"\.([^.]+)\z", 1))
    out = F.lit(None).cast("string")
    for name, sep in SEPARATORS.items():
        out = F.when(suffix == name, F.lit(sep)).otherwise(out)
    return out


def pieces_of(raw: Column) -> Column:
    """A record cut at its quotes."""
    return F.split(F.translate(F.coalesce(raw, F.lit("")), MARK, "\u0002"), '"', -1)


def parse_record(pieces: Column, n: Column, sep: Column) -> tuple[Column, Column]:
    """(quoting is right, array of field values) of one whole record, from its pieces and their number.

    Even pieces lie outside quotes, odd ones inside. A piece between two quoted pieces is empty (a doubled quote) or
    begins and ends with the separator; no outside piece holds a line break. Both arguments must be columns of the
    input, since expressions inside a lambda are evaluated for each element.
    """

    def right(p: Column, i: Column) -> Column:
        inside = (i % 2) == 1
        breaks = F.contains(p, F.lit("\n")) | F.contains(p, F.lit("\r"))
        before = (i == 0) | (p == "") | p.startswith(sep)
        after = (i == n - 1) | (p == "") | p.endswith(sep)
        return inside | (~breaks & before & after)

    checked = F.transform(pieces, right)
    ok = ((n % 2) == 1) & F.forall(checked, lambda v: v)

    def shown(p: Column, i: Column) -> Column:
        doubled = (p == "") & (i > 0) & (i < n - 1)
        return F.when((i % 2) == 1, p).when(doubled, F.lit('"')).otherwise(F.replace(p, sep, F.lit(MARK)))

    values = F.split(F.array_join(F.transform(pieces, shown), ""), MARK, -1)
    return ok, values


def examine(df: DataFrame, fields: tuple[Field, ...] = PAIR_FIELDS, file_col: str = "file_name", no_col: str = "record_no", raw_col: str = "raw") -> DataFrame:
    """``df`` with ``values`` (map of field to text) and ``errors`` (array, empty for a good record); headers excepted.

    Record 1 of each file gives the order of its fields; a file without a readable header, or with one that does not
    name all fields, has ``column_count`` in every record. A NULL record counts as an empty one. Errors come in the
    order ``broken_quote``, ``column_count``, ``bad_value:<field>`` and stop at the first of these classes that holds.
    Columns of the input named ``values`` or ``errors`` are replaced.
    """
    keep = [c for c in df.columns if c not in ("values", "errors")]
    cut = df.select(*keep, pieces_of(F.col(raw_col)).alias("__pieces"), separator_of(F.col(file_col)).alias("__sep"))
    cut = cut.select("*", F.size("__pieces").alias("__n"))
    ok, parts = parse_record(F.col("__pieces"), F.col("__n"), F.col("__sep"))
    parsed = cut.select(*keep, F.coalesce(ok, F.lit(False)).alias("__ok"), parts.alias("__parts"))
    heads = cut.where(F.col(no_col) == 1).select(F.col(file_col).alias("__file"), F.when(ok, parts).alias("__names"))
    heads = heads.groupBy("__file").agg(F.first("__names", ignorenulls=True).alias("__names"))
    joined = parsed.where(F.col(no_col) != 1).join(heads, F.col(file_col) == F.col("__file"), "left")
    names = [f.name for f in fields]
    known = F.coalesce(F.size(F.array_intersect("__names", F.array(*map(F.lit, names)))) == len(names), F.lit(False)) & (F.size("__names") == len(names))
    counted = known & (F.size("__parts") == len(names))
    mapped = F.when(F.col("__ok") & counted, F.map_from_arrays("__names", "__parts"))
    out = joined.select(*keep, "__ok", counted.alias("__counted"), mapped.alias("values"))
    bad = [F.when(~F.coalesce(f.good(F.col("values")[f.name]), F.lit(False)), F.lit(f"bad_value:{f.name}")) for f in fields]
    errors = (
        F.when(~F.col("__ok"), F.array(F.lit("broken_quote")))
        .when(~F.col("__counted"), F.array(F.lit("column_count")))
        .otherwise(F.array_compact(F.array(*bad)))
    )
    return out.select(*keep, "values", errors.alias("errors"))


def split_rows(df: DataFrame, fields: tuple[Field, ...] = PAIR_FIELDS, **names: str) -> tuple[DataFrame, DataFrame]:
    """(good records as typed rows, bad records with ``reason`` and all ``errors``).

    A typed row has ``raw_id`` and other input columns only where their names do not clash with a field.
    """
    seen = examine(df, fields, **names)
    taken = {f.name for f in fields}
    rest = [c for c in seen.columns if c not in taken | {"values", "errors"}]
    typed = [F.expr(f"try_cast(values['{f.name}'] as {f.type})").alias(f.name) for f in fields]
    good = seen.where(F.size("errors") == 0).select(*rest, *typed)
    bad = seen.where(F.size("errors") > 0).withColumn("reason", F.split_part(F.col("errors")[0], F.lit(":"), F.lit(1)))
    return good, bad

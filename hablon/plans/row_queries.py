"""Queries over raw records that may fail to parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.operators import rowcheck
from hablon.session import table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rowcheck.split_rows(table(spark, sf_dir, "raw_rows"))[1].select("raw_id", "reason")


def p6_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = rowcheck.split_rows(table(spark, sf_dir, "raw_rows"))[0]
    return good.select("raw_id", F.col("pair_no").cast("bigint").alias("pair_no"), "split", "src", "tgt", "score", F.col("added_on").cast("string").alias("added_on"))


def queries():
    return {"p6_found": p6_found, "p6_loaded": p6_loaded}


def _parsed() -> str:
    """Records by suffix: whether their quoting is right, and their values."""
    parts = []
    for suffix, sep in rowcheck.SEPARATORS.items():
        c = r"\t" if sep == "\t" else sep
        field = f'"(?:[^"]|"")*"|[^"{c}\\r\\n]*'
        parts.append(
            f"select raw_id, file_name, record_no, raw, regexp_full_match(raw, '(?:{field})(?:[{c}](?:{field}))*') as ok, "
            f"regexp_extract_all(chr({ord(sep)}) || raw, '[{c}]({field})', 1) as cells from raw_rows where ends_with(file_name, '.{suffix}')"
        )
    return " union all ".join(parts)


def _sql() -> str:
    value = lambda name: f"v[list_position(names, '{name}')]"
    text = lambda x: rf"({x} is not null and regexp_matches({x}, '[^\p{{Z}}\t\n\x0b\f\r\x{{85}}]') and not regexp_matches({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x{{7f}}-\x{{9f}}\x{{fffd}}]'))"
    good = " and ".join(
        [
            f"regexp_full_match({value('pair_no')}, '[1-9][0-9]*')", f"{value('split')} in ('train', 'dev', 'test')", text(value("src")), text(value("tgt")),
            rf"({value('score')} = '' or (regexp_full_match({value('score')}, '[0-9]*\.?[0-9]*') and coalesce(try_cast({value('score')} as double), 2) <= 1))",
            f"regexp_full_match({value('added_on')}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') and try_strptime({value('added_on')}, '%Y-%m-%d') is not null",
        ]
    )
    return f"""with r as ({_parsed()}),
u as (select *, list_transform(cells, lambda c: case when starts_with(c, '"') then replace(substr(c, 2, length(c) - 2), '""', '"') else c end) v from r),
h as (select file_name, v as names from u where record_no = 1 and ok),
e as (select u.*, names, case when not ok then 'broken_quote' when len(v) <> 6 or names is null or len(names) <> 6 then 'column_count' when not coalesce({good}, false) then 'bad_value' end as reason from u left join h using (file_name) where record_no <> 1)
"""


def oracle_sql() -> dict[str, str]:
    v = lambda name: f"v[list_position(names, '{name}')]"
    return {
        "p6_found": _sql() + "select raw_id, reason from e where reason is not null",
        "p6_loaded": _sql() + f"select raw_id, cast({v('pair_no')} as bigint) as pair_no, {v('split')} as split, {v('src')} as src, {v('tgt')} as tgt, try_cast({v('score')} as double) as score, {v('added_on')} as added_on from e where reason is null",
    }

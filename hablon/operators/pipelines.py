"""Whole pipelines as one plan each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hablon.functions.text import pytrim
from hablon.operators import prep
from hablon.operators.extract import verses
from hablon.operators.keyed import aligned, merge_new


def converted_pairs(pairs: DataFrame, keep_empty: bool = False, shuffle_seed: int | None = None, most: int | None = None) -> DataFrame:
    """Pairs read from any source: empty ones dropped, shuffled by seed, cut to a number of rows; ``line_no`` is renewed
    by the shuffle."""
    out = pairs if keep_empty else pairs.where((pytrim("src") != "") & (pytrim("tgt") != ""))
    if shuffle_seed is not None:
        out = prep.shuffled(out, shuffle_seed, "line_no").withColumn("line_no", F.col("position")).drop("position")
    return out.orderBy("line_no").limit(most) if most is not None else out


def prepared(first: DataFrame, second: DataFrame, strategy: str, seed: int) -> DataFrame:
    """Two monolingual corpora cleaned, balanced, concatenated and shuffled: ``part, line_no, text, position``."""
    a, b = prep.clean_lines(first), prep.clean_lines(second)
    return prep.shuffled(prep.concat(*prep.balance(a, b, strategy, seed, "line_no")), seed, "part", "line_no")


def verse_corpus(first_pages: DataFrame, second_pages: DataFrame, html: str, old: DataFrame | None = None) -> DataFrame:
    """``book, chapter, verse, src, tgt`` of both versions, added to what an earlier run left."""
    new = aligned(verses(first_pages, html), verses(second_pages, html), "book", "chapter", "verse")
    return new if old is None else merge_new(old.select(*new.columns), new, "book", "chapter", "verse")

"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.llm import align, boilerplate, canon, langid, mixing, overlap, packing, pii
from hablon.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlaps(table(spark, sf_dir, "test"))


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_report(table(spark, sf_dir, "test"))


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlap_classes(table(spark, sf_dir, "test"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "paired_lines"), table(spark, sf_dir, "test")).select("file_id", "src_line", "tgt_line")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.main_body(table(spark, sf_dir, "scraped_pages")).select("page_id", "paragraph_index")


def p3_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.classify(table(spark, sf_dir, "scraped_pages")).groupBy("role").agg(F.count("*").alias("paragraphs"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.relabel(table(spark, sf_dir, "bombo"), table(spark, sf_dir, "lang_samples")).select("row_id", "seg_no", "lang")


def p4_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.row_languages(table(spark, sf_dir, "bombo"), table(spark, sf_dir, "lang_samples"))


def p4_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "bombo"), table(spark, sf_dir, "lang_samples"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.copies(table(spark, sf_dir, "test"))


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.collapse(table(spark, sf_dir, "test")).select("row_id", "src", "tgt", "n_copies")


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p7_packed(spark, sf_dir))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.share_report(p8_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_spans(table(spark, sf_dir, "documents"))


def p9_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.sanitise(table(spark, sf_dir, "documents"))


def p9_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.disclosure(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_report, p1_classes, p2_found, p3_found, p3_roles, p4_found, p4_rows, p4_segments, p5_found, p5_collapsed, p7_packed, p7_report, p8_mixture, p8_shares, p9_found, p9_sanitised, p9_disclosure)}


_CANON = r"regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_CLASSES = f"""
with c as (select row_id, src, tgt, {_CANON.format(c='src')} a, {_CANON.format(c='tgt')} b from test),
g as (select *, least(a, b) lo, greatest(a, b) hi from c),
m as (select *, min(row_id) over (partition by lo, hi) rep, count(*) over (partition by lo, hi) n from g)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p5_found": _CLASSES + "select rep as row_id_a, row_id as row_id_b from m where row_id <> rep",
        "p5_collapsed": _CLASSES + "select row_id, src, tgt, cast(n as bigint) as n_copies from m where row_id = rep",
    }

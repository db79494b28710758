"""Queries of the analyzer, the cleaner and corpus preparation over the pair and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.operators import analyze, clean, pipelines, prep
from hablon.plans.sqltext import LINES, PAIRS, WS, fold, ntok, nwords, squeeze, strip_html, tags, toks, trim  # noqa: F401
from hablon.session import table


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The pair table as a parallel corpus; missing text is empty."""
    t = table(spark, sf, "test")
    return t.select(F.col("row_id").alias("line_no"), F.coalesce("src", F.lit("")).alias("src"), F.coalesce("tgt", F.lit("")).alias("tgt"))


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the documents as a monolingual corpus, numbered by document and place."""
    d = table(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text")).select((F.col("doc_id") * 100000 + F.col("i")).alias("line_no"), "text")


def analysis_pairs(spark, sf):
    """Tighter limits than the defaults, so that every issue occurs in the table."""
    return pairs(spark, sf), (0.7, 1.3), (12, 45)


def parallel_metrics(spark, sf):
    return analyze.parallel_metrics(*analysis_pairs(spark, sf))


def parallel_features(spark, sf):
    f = analyze.pair_features(*analysis_pairs(spark, sf))
    return f.select("line_no", F.col("sl").cast("long").alias("sl"), F.col("tl").cast("long").alias("tl"), "ratio", *analyze.FLAGS)


def parallel_flagged(spark, sf):
    return analyze.flagged(*analysis_pairs(spark, sf)).select("line_no", "issues")


def parallel_top_src(spark, sf):
    return analyze.top_tokens(pairs(spark, sf).where("src <> '' and tgt <> ''"), "src")


def parallel_top_tgt(spark, sf):
    return analyze.top_tokens(pairs(spark, sf).where("src <> '' and tgt <> ''"), "tgt")


def parallel_histogram(spark, sf):
    return analyze.histogram(analyze.pair_features(pairs(spark, sf)), "sl")


def parallel_recommendations(spark, sf):
    return analyze.recommendations(parallel_metrics(spark, sf))


def parallel_report(spark, sf):
    return analyze.report(parallel_metrics(spark, sf).select("total", *analyze.FLAGS, "pair_extra", "src_extra", "tgt_extra"))


def parallel_samples(spark, sf):
    return analyze.samples(analyze.pair_features(*analysis_pairs(spark, sf)), "ratio_issue")


def mono_metrics(spark, sf):
    return analyze.mono_metrics(lines(spark, sf))


def mono_top_tokens(spark, sf):
    return analyze.top_tokens(lines(spark, sf), "text")


def mono_histogram(spark, sf):
    return analyze.histogram(analyze.line_features(lines(spark, sf)), "n")


def mono_recommendations(spark, sf):
    return analyze.mono_recommendations(mono_metrics(spark, sf))


CLEAN = {"max_tokens": 45, "min_tokens": 12, "ratio": (0.7, 1.3)}


def html_pairs(spark, sf):
    """Paragraphs with their markup as pairs, for the markup step."""
    p = table(spark, sf, "scraped_pages").select("page_id", F.explode("paragraphs").alias("p"))
    return p.select((F.col("page_id") * 1000 + F.col("p.index")).alias("line_no"), F.coalesce("p.html", F.lit("")).alias("src"), F.coalesce("p.text", F.lit("")).alias("tgt"))


def clean_rows(spark, sf):
    return clean.clean(pairs(spark, sf), ["src", "tgt"], **CLEAN)


def clean_steps(spark, sf):
    return clean.accounting(pairs(spark, sf), ["src", "tgt"], **CLEAN)


def clean_html_rows(spark, sf):
    return clean.clean(html_pairs(spark, sf), ["src", "tgt"], max_tokens=200, min_tokens=1)


def clean_html_steps(spark, sf):
    return clean.accounting(html_pairs(spark, sf), ["src", "tgt"], max_tokens=200, min_tokens=1)


def clean_modified_cells(spark, sf):
    return clean.modified_cells(html_pairs(spark, sf), ["src", "tgt"], max_tokens=200, min_tokens=1)


def clean_dropped(spark, sf):
    return clean.label(pairs(spark, sf), ["src", "tgt"], **CLEAN).where("dropped_by is not null").select("line_no", "dropped_by")


def sides(spark, sf):
    p = pairs(spark, sf)
    return p.select("line_no", F.lit("src").alias("side"), F.col("src").alias("text")).unionByName(p.select("line_no", F.lit("tgt").alias("side"), F.col("tgt").alias("text")))


def prep_counts(spark, sf):
    return prep.corpus_counts(sides(spark, sf))


def prep_clean_lines(spark, sf):
    return prep.clean_lines(lines(spark, sf))


def prep_shuffled(spark, sf):
    return prep.shuffled(pairs(spark, sf), 42, "line_no").select("line_no", "position")


def prep_downsample(spark, sf):
    p = pairs(spark, sf)
    return prep.downsample(p, table(spark, sf, "documents").count(), 42, "line_no").select("line_no")


def prep_upsample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return prep.upsample(d, table(spark, sf, "test").count(), 42, "doc_id").select("draw", "doc_id")


def _corpora(spark, sf):
    """Two corpora of unequal size, with keys that tell their rows apart."""
    return table(spark, sf, "bombo").select(F.col("row_id").alias("doc_id")), table(spark, sf, "documents").select("doc_id")


def prep_balanced(spark, sf):
    return prep.concat(*prep.balance(*_corpora(spark, sf), "balanced", 42, "doc_id")).select("part", "doc_id")


def prep_down_first(spark, sf):
    return prep.concat(*prep.balance(*_corpora(spark, sf), "down_first", 42, "doc_id")).select("part", "doc_id")


def prep_up_second(spark, sf):
    return prep.concat(*prep.balance(*_corpora(spark, sf), "up_second", 42, "doc_id")).select("part", "doc_id")


def prep_ratio(spark, sf):
    return prep.corpus_ratio(sides(spark, sf), "src", "tgt")


def prep_split(spark, sf):
    return prep.split(pairs(spark, sf), 0.05, 42, "line_no").select("line_no", "split")


def prep_concat(spark, sf):
    return prep.concat(pairs(spark, sf).select("line_no", F.col("src").alias("text")), lines(spark, sf)).select("part", "line_no", F.md5("text").alias("h"))


def prep_pipeline(spark, sf):
    """Clean, balance, concatenate and shuffle in one plan."""
    p = pairs(spark, sf)
    a, b = (p.select("line_no", F.col(c).alias("text")) for c in ("src", "tgt"))
    return pipelines.prepared(a, b, "balanced", 7).select("part", "line_no", "position")


def pipeline_converted(spark, sf):
    """Pairs with both sides filled, shuffled and cut."""
    return pipelines.converted_pairs(pairs(spark, sf), shuffle_seed=11, most=5000).select("line_no", "src", "tgt")


QUERIES = (
    parallel_metrics, parallel_features, parallel_flagged, parallel_top_src, parallel_top_tgt, parallel_histogram, parallel_recommendations, parallel_report,
    parallel_samples, mono_metrics, mono_top_tokens, mono_histogram, mono_recommendations, clean_rows, clean_steps, clean_html_rows, clean_html_steps,
    clean_modified_cells, clean_dropped, prep_counts, prep_clean_lines, prep_shuffled, prep_downsample, prep_upsample, prep_balanced, prep_down_first, prep_up_second, prep_ratio, prep_split, prep_concat,
    prep_pipeline, pipeline_converted,
)


def queries():
    return {f.__name__: f for f in QUERIES}


_CTRL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def features_sql(low_ratio: float, high_ratio: float, low: int, high: int) -> str:
    digits = lambda t: rf"(len({t}) > 0 and len(list_filter({t}, lambda w: not regexp_full_match(w, '\p{{Nd}}+'))) = 0)"
    return rf"""
with {PAIRS},
b as (select *, {trim('src')} s, {trim('tgt')} t from pairs),
c as (select *, s <> '' and t <> '' as full_ from b),
d as (select *, case when full_ then {toks('src')} else [] end st, case when full_ then {toks('tgt')} else [] end tt from c),
e as (select *, len(st) sl, len(tt) tl from d),
f as (select *, case when tl > 0 then sl / tl when sl > 0 then cast('Infinity' as double) end ratio from e),
x as (select *, s = '' and t = '' as both_empty, s = '' and t <> '' as src_empty, s <> '' and t = '' as tgt_empty,
  full_ and not regexp_matches(src, '[\p{{L}}\p{{N}}_]') as src_punctuation, full_ and not regexp_matches(tgt, '[\p{{L}}\p{{N}}_]') as tgt_punctuation,
  full_ and (regexp_matches(src, '{_CTRL}') or regexp_matches(tgt, '{_CTRL}')) as control,
  full_ and {digits('st')} and {digits('tt')} as numeric,
  full_ and {tags('src')} <> {tags('tgt')} as html_mismatch,
  full_ and coalesce(ratio < {low_ratio} or ratio > {high_ratio}, false) as ratio_issue,
  full_ and ((sl > 0 and sl < {low}) or (tl > 0 and tl < {low})) as short,
  full_ and (sl > {high} or tl > {high}) as long from f)
"""


_F = features_sql(0.7, 1.3, 12, 45)
_SUM = lambda c: f"cast(count(*) filter (where {c}) as bigint) as {c}"
_FLAGS = ", ".join(_SUM(c) for c in analyze.FLAGS)
_FLAGS = _FLAGS.replace("where numeric", 'where "numeric"').replace("as numeric", 'as "numeric"')


def _stats(c: str, name: str) -> str:
    v = f"(case when {c} > 0 then {c} end)"
    return (
        f"cast(coalesce(min({v}), 0) as bigint) as {name}_min, cast(coalesce(max({v}), 0) as bigint) as {name}_max, cast(coalesce(avg({v}), 0) as double) as {name}_mean, "
        f"cast(coalesce(percentile_disc(0.5) within group (order by {v} desc), 0) as bigint) as {name}_median"
    )


def _pen(c: str, w: int) -> str:
    return f"least({c} / greatest(total, 1) * {w} * 100, {w * 10}.0)"


_METRICS = (
    _F
    + f""", y as (select *, case when full_ then length(s) else 0 end sc, case when full_ then length(t) else 0 end tc from x),
one as (select count(*) as total, {_FLAGS}, cast(coalesce(sum(sl), 0) as bigint) as src_tokens, cast(coalesce(sum(tl), 0) as bigint) as tgt_tokens, {_stats('sl', 'src_len')}, {_stats('tl', 'tgt_len')}, {_stats('sc', 'src_char')}, {_stats('tc', 'tgt_char')} from y),
pd as (select cast(coalesce(sum(n - 1), 0) as bigint) pair_extra, count(*) filter (where n > 1) pair_types from (select count(*) n from x where full_ group by s, t)),
sd as (select cast(coalesce(sum(n - 1), 0) as bigint) src_extra from (select count(*) n from x where full_ group by s)),
td as (select cast(coalesce(sum(n - 1), 0) as bigint) tgt_extra from (select count(*) n from x where full_ group by t)),
sv as (select count(distinct w) src_vocab from (select unnest(st) w from x)), tv as (select count(distinct w) tgt_vocab from (select unnest(tt) w from x)),
m as (select * from one, pd, sd, td, sv, tv),
h as (select *, greatest(0, cast(round_even(100 - ({_pen('src_empty', 5)} + {_pen('tgt_empty', 5)} + {_pen('both_empty', 5)} + {_pen('ratio_issue', 2)} + {_pen('pair_extra', 2)} + {_pen('short', 1)}), 0) as bigint)) as health from m)
"""
)


def _hist(rel: str, col: str) -> str:
    return f"""e as (select min({col}) lo, max({col}) hi from {rel}), q as (select cast(floor(({col} - lo) / greatest(1, floor((hi - lo) / 10))) * greatest(1, floor((hi - lo) / 10)) + lo as bigint) low, cast(greatest(1, floor((hi - lo) / 10)) as bigint) step from {rel}, e)
select low, low + step - 1 as high, count(*) as n from q group by all"""


def _top(rel: str, col: str) -> str:
    return f"""w as (select line_no, unnest({toks(col)}) token, generate_subscripts({toks(col)}, 1) pos from {rel})
select token, n from (select token, count(*) n, min((line_no, pos)) f from w group by token) order by n desc, f limit 10"""


def _clean_sql(rel: str, mx: int, mn: int, lo: float, hi: float) -> str:
    return rf"""
a as (select *, {ntok('src')} sl, {ntok('tgt')} tl from {rel}),
b as (select *, case when greatest(sl, tl) > {mx} then 'long' when least(sl, tl) < {mn} then 'short' when sl / greatest(tl, 1) < {lo} or sl / greatest(tl, 1) > {hi} then 'ratio' end early from a),
c as (select *, row_number() over (partition by src, tgt, early is null order by line_no) rk, {strip_html('src')} cs, {strip_html('tgt')} ct from b),
d as (select *, coalesce(early, case when rk > 1 then 'duplicate' when not (regexp_matches(cs, '[a-zA-Z\x{{00C0}}-\x{{FFFF}}]') and regexp_matches(ct, '[a-zA-Z\x{{00C0}}-\x{{FFFF}}]')) then 'punctuation' end) dropped_by from c)
"""


_HTML = "hp as (select page_id * 1000 + p.index as line_no, coalesce(p.html, '') as src, coalesce(p.text, '') as tgt from (select page_id, unnest(paragraphs) p from scraped_pages))"
_STEPS = """, s(step, n) as (
select 'long', count(*) filter (where dropped_by = 'long') from d union all select 'short', count(*) filter (where dropped_by = 'short') from d union all
select 'ratio', count(*) filter (where dropped_by = 'ratio') from d union all select 'duplicate', count(*) filter (where dropped_by = 'duplicate') from d union all
select 'html', count(*) filter (where (regexp_matches(src, '<[^>]+>') or regexp_matches(tgt, '<[^>]+>')) and coalesce(dropped_by, '') not in ('long', 'short', 'ratio', 'duplicate')) from d union all
select 'punctuation', count(*) filter (where dropped_by = 'punctuation') from d) select step, n from s"""
_C1 = "with " + PAIRS + "," + _clean_sql("pairs", 45, 12, 0.7, 1.3)
_C2 = "with " + _HTML + "," + _clean_sql("hp", 200, 1, 0.5, 9.0)
_KEY = lambda seed, *keys: "md5(concat_ws(':', '" + str(seed) + "', " + ", ".join(f"cast({k} as varchar)" for k in keys) + "))"
_POS = lambda seed, *keys: f"row_number() over (order by {_KEY(seed, *keys)}, {', '.join(keys)})"
_REC = """select severity, issue, n from (
select case when "long" / greatest(total, 1) * 100 > 5 then 'HIGH' else 'MED' end severity, 'long' issue, "long" n from h union all
select case when short / greatest(total, 1) * 100 > 2 then 'HIGH' else 'MED' end, 'short', short from h union all
select case when ratio_issue / greatest(total, 1) * 100 > 2 then 'HIGH' else 'MED' end, 'ratio', ratio_issue from h union all
select 'MED', 'duplicate', pair_extra from h union all
select case when html_mismatch / greatest(total, 1) * 100 > 1 then 'MED' else 'LOW' end, 'html', html_mismatch from h union all
select 'LOW', 'useless', greatest(src_punctuation, tgt_punctuation) + "numeric" from h union all
select 'MED', 'skew', case when src_len_mean > src_len_median * 3 then 1 else 0 end from h) where n > 0"""
_MONO = rf"""with {LINES}, a as (select line_no, {trim('text')} s from lines), b as (select *, {toks('s')} tok, length(s) chars from a), f as (select *, len(tok) n from b),
one as (select count(*) total, count(*) filter (where s = '') as empty, count(*) filter (where s <> '' and not regexp_matches(s, '[\p{{L}}\p{{N}}_]')) as punctuation,
count(*) filter (where s <> '' and n > 0 and len(list_filter(tok, lambda w: not regexp_full_match(w, '\p{{Nd}}+'))) = 0) as "numeric", count(*) filter (where regexp_matches(s, '{_CTRL}')) as control,
count(*) filter (where n > 0 and n < 3) as short, count(*) filter (where n > 200) as long, cast(coalesce(sum(n), 0) as bigint) as tokens, {_stats('n', 'len')}, {_stats('chars', 'char')} from f),
dd as (select cast(coalesce(sum(k - 1), 0) as bigint) dup_extra, count(*) filter (where k > 1) dup_types from (select count(*) k from f where s <> '' group by s)),
vv as (select count(distinct w) vocab from (select unnest(tok) w from f)),
h as (select *, greatest(0, cast(round_even(100 - ({_pen('empty', 5)} + {_pen('dup_extra', 2)} + {_pen('short', 1)}), 0) as bigint)) as health from one, dd, vv)
"""


_BOTH = f"u as (select 0 as part, row_id as doc_id from bombo union all select 1, doc_id from documents), r as (select part, doc_id, {_POS(42, 'doc_id').replace('over (', 'over (partition by part ')} p, count(*) over (partition by part) n from u)"


def oracle_sql() -> dict[str, str]:
    full = "full_pairs as (select * from pairs where src <> '' and tgt <> '')"
    report = " union all ".join(f"""select '{c}' as metric, cast("{c}" as double) as "value", "{c}" / greatest(total, 1) * 100 as pct, case when "{c}" / greatest(total, 1) * 100 > 1 then 'bad' when "{c}" > 0 then 'warn' else 'ok' end as flag from h""" for c in (*analyze.FLAGS, "pair_extra", "src_extra", "tgt_extra"))
    return {
        "parallel_metrics": _METRICS + "select * from h",
        "parallel_features": _F + 'select line_no, sl, tl, ratio, src_empty, tgt_empty, both_empty, src_punctuation, tgt_punctuation, control, "numeric", html_mismatch, ratio_issue, short, long from x',
        "parallel_flagged": _F + ", z as (select *, row_number() over (partition by s, t order by line_no) rk from x), o as (select line_no, array_to_string(list_filter([case when rk > 1 then 'duplicate' end, case when long then 'long' end, case when ratio_issue then 'ratio' end, case when short then 'short' end, case when s = '' then 'src_empty' end, case when t = '' then 'tgt_empty' end], lambda v: v is not null), '|') issues from z) select * from o where issues <> ''",
        "parallel_top_src": f"with {PAIRS}, {full}, " + _top("full_pairs", "src"),
        "parallel_top_tgt": f"with {PAIRS}, {full}, " + _top("full_pairs", "tgt"),
        "parallel_histogram": features_sql(0.2, 5.0, 3, 200) + ", " + _hist("x", "sl").replace("e as", "ee as").replace(", e)", ", ee)"),
        "parallel_recommendations": _METRICS + _REC,
        "parallel_report": _METRICS + report,
        "parallel_samples": _F + "select line_no, left(src, 60) as src, left(tgt, 60) as tgt from x where ratio_issue order by line_no limit 5",
        "mono_metrics": _MONO + "select * from h",
        "mono_top_tokens": f"with {LINES}, " + _top("lines", "text"),
        "mono_histogram": f"with {LINES}, f as (select len({toks(trim('text'))}) n from lines), " + _hist("f", "n").replace("as n from q", "as n from q"),
        "mono_recommendations": _MONO + "select * from (select 'MED' severity, 'duplicate' issue, dup_extra n from h union all select 'MED', 'short', short from h union all select 'LOW', 'long', long from h) where n > 0",
        "clean_rows": _C1 + "select line_no, cs as src, ct as tgt from d where dropped_by is null",
        "clean_steps": _C1 + _STEPS,
        "clean_html_rows": _C2 + "select line_no, cs as src, ct as tgt from d where dropped_by is null",
        "clean_html_steps": _C2 + _STEPS,
        "clean_modified_cells": _C2 + """select * from (select line_no, 'src' as "column", src as "before", cs as "after" from d where dropped_by is null union all select line_no, 'tgt', tgt, ct from d where dropped_by is null) where "before" <> "after" """,
        "clean_dropped": _C1 + "select line_no, dropped_by from d where dropped_by is not null",
        "prep_counts": f"with {PAIRS} select side, count(*) as lines, cast(sum(words) as bigint) as words from (select 'src' side, {nwords('src')} words, {trim('src')} x from pairs union all select 'tgt', {nwords('tgt')}, {trim('tgt')} from pairs) where x <> '' group by side",
        "prep_clean_lines": f"with {LINES} select * from (select line_no, {squeeze('text')} as text from lines) where text <> ''",
        "prep_shuffled": f"select row_id as line_no, {_POS(42, 'row_id')} as position from test",
        "prep_downsample": f"select line_no from (select row_id as line_no, {_POS(42, 'row_id')} as p from test) where p <= (select count(*) from documents)",
        "prep_upsample": f"with n as (select doc_id, {_POS(42, 'doc_id')} p from documents), d as (select r as draw, cast(('0x' || substr(md5(concat_ws(':', '42', cast(r as varchar))), 1, 8)) as bigint) % (select count(*) from documents) + 1 as p from range(1, (select count(*) from test) + 1) t(r)) select draw, doc_id from d join n using (p)",
        "prep_balanced": f"with {_BOTH} select part, doc_id from r where p <= (select min(n) from r)",
        "prep_down_first": f"with {_BOTH} select part, doc_id from r where part = 1 or p <= (select max(n) from r where part = 1)",
        "prep_up_second": f"with {_BOTH}, d as (select r as draw, cast(('0x' || substr(md5(concat_ws(':', '42', cast(r as varchar))), 1, 8)) as bigint) % (select count(*) from documents) + 1 as p from range(1, (select count(*) from bombo) + 1) t(r)) select 0 as part, row_id as doc_id from bombo union all select 1, doc_id from d join (select * from r where part = 1) using (p)",
        "prep_ratio": f"with {PAIRS}, c as (select side, count(*) as lines, sum(words) as words from (select 'src' side, {nwords('src')} words, {trim('src')} x from pairs union all select 'tgt', {nwords('tgt')}, {trim('tgt')} from pairs) where x <> '' group by side) select a.lines / b.lines as line_ratio, a.words / b.words as word_ratio from c a, c b where a.side = 'src' and b.side = 'tgt'",
        "pipeline_converted": f"with {PAIRS}, k as (select {_POS(11, 'line_no')} as n, src, tgt from pairs where {trim('src')} <> '' and {trim('tgt')} <> '') select n as line_no, src, tgt from k where n <= 5000",
        "prep_split": f"select row_id as line_no, case when {_POS(42, 'row_id')} <= ceil(count(*) over () * (1 - 0.05)) then 'train' else 'dev' end as split from test",
        "prep_concat": f"with {PAIRS}, {LINES} select 0 as part, line_no, md5(src) as h from pairs union all select 1, line_no, md5(text) from lines",
        "prep_pipeline": f"with {PAIRS}, a as (select 0 as part, line_no, {squeeze('src')} x from pairs union all select 1, line_no, {squeeze('tgt')} from pairs), b as (select part, line_no, {_POS(7, 'line_no').replace('over (', 'over (partition by part ')} p, count(*) over (partition by part) n from a where x <> ''), c as (select * from b where p <= (select min(n) from b)) select part, line_no, {_POS(7, 'part', 'line_no')} as position from c",
    }

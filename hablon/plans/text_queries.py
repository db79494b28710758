"""Queries of text functions, extraction, dictionaries and grammar rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.functions import grammar, lexicon, text
from hablon.operators import extract, keyed
from hablon.plans.corpus_queries import lines, pairs
from hablon.plans.sqltext import LINES, PAIRS, WS, fold, ntok, nwords, squeeze, strip_html, tags, toks, trim
from hablon.session import table


def text_measures(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null")
    joined = lambda c: F.md5(F.array_join(c, "\u0001"))
    return d.select(
        "doc_id", joined(text.tokens("text")).alias("token_hash"), text.token_count("text").cast("long").alias("tokens"), text.char_count("text").cast("long").alias("chars"),
        text.word_count("text").cast("long").alias("words"), F.md5(text.squeeze("text")).alias("squeezed"), F.md5(text.pytrim("text")).alias("trimmed"),
    )


def text_markup(spark, sf):
    p = table(spark, sf, "scraped_pages").select("page_id", F.explode("paragraphs").alias("p")).where("p.html is not null")
    return p.select("page_id", F.col("p.index").alias("index"), text.strip_html("p.html").alias("plain"), F.array_join(F.sort_array(text.html_tags("p.html")), "").alias("tags"))


def text_cleaners(spark, sf):
    t = lines(spark, sf).where("text <> ''")
    return t.select("line_no", extract.numbered_removed(F.col("text")).alias("a"), extract.verse_text(F.col("text")).alias("b"), extract.footnotes_removed(F.col("text")).alias("c"))


def text_folded(spark, sf):
    return table(spark, sf, "bombo").select("row_id", text.strip_diacritics("src").alias("folded"))


def text_sentences(spark, sf):
    return extract.sentence_rows(table(spark, sf, "documents").where("text is not null"), "text", "doc_id").select("doc_id", "sentence")


def text_dialogue(spark, sf):
    return extract.dialogue(lines(spark, sf))


def text_marked_language(spark, sf):
    return table(spark, sf, "bombo").where("src is not null").select("row_id", extract.marked_language(F.col("src")).alias("marked"))


def text_slugs(spark, sf):
    return table(spark, sf, "crawl_log").select(extract.slug(F.coalesce("title", "url")).alias("slug")).distinct()


def text_entities(spark, sf):
    """Texts with marks written as character references, decoded again."""
    d = table(spark, sf, "documents").where("text is not null")
    return d.select("doc_id", F.md5(text.entities(escaped(F.col("text")))).alias("plain"), text.entities(F.concat(F.lit("&#225;&#xE9;&ntilde;&nbsp;&none;&&amp;lt; "), F.col("source"))).alias("mixed"))


def escaped(x):
    """Marks of markup as character references of all kinds."""
    for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;"), ("’", "&#x2019;"), ("\u00a0", "&nbsp;")):
        x = F.replace(x, F.lit(mark), F.lit(reference))
    return x


def text_replaced(spark, sf):
    p = pairs(spark, sf)
    return p.select("line_no", F.regexp_replace("src", "(?i)the ", "DEN ").alias("a"), lexicon.replace_literal("tgt", "ang", "an$g").alias("b"), lexicon.splice("src", F.lit(4), F.lit(9), F.lit("_")).alias("c"), F.size(lexicon.find_spans("src", "the", True)).cast("long").alias("n"))


def extract_article_corpus(spark, sf):
    d = table(spark, sf, "documents").where("text is not null")
    return extract.article_corpus(d, "text", "doc_id", "source").select("doc_id", "source", "sentence")


def extract_category_totals(spark, sf):
    return extract.category_totals(table(spark, sf, "crawl_log"), "category", "url")


def extract_paragraphs(spark, sf):
    p = table(spark, sf, "scraped_pages")
    page = F.array_join(F.transform("paragraphs", lambda x: F.coalesce(x["html"], F.lit(""))), "\n")
    return extract.paragraphs(p.select("page_id", page.alias("html")), "html", "page_id").groupBy("page_id").agg(F.count("*").alias("n"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "text"))), lambda x: x["text"]), "|")).alias("h"))


def extract_new_urls(spark, sf):
    log = table(spark, sf, "crawl_log")
    return keyed.unseen(log.where("url is not null"), log.where("kept > 3"), "url").groupBy("url").agg(F.max("kept").cast("long").alias("kept"))


def words_table(spark, sf):
    """The dictionary with a row order: a key of its whole content stands in for the missing line number."""
    d = table(spark, sf, "dict_words")
    return d.withColumn("o", F.concat_ws("|", "base_word", "target_word"))


def lexicon_dictionary(spark, sf):
    return lexicon.dictionary(words_table(spark, sf), "base_word", "target_word", "o")


def lexicon_dialect_map(spark, sf):
    return lexicon.dialect_map(words_table(spark, sf), "base_word", "target_word", "o")


def _maps(spark, sf):
    return lexicon.as_map(lexicon_dialect_map(spark, sf)), lexicon.as_map(lexicon_dictionary(spark, sf))


def lexicon_spell_issues(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null")
    found = b.select("row_id", F.explode(lexicon.spell_issues("src", _maps(spark, sf)[0], F.array(F.lit("bata")))).alias("x"))
    return found.select("row_id", "x.word", F.col("x.start").cast("long").alias("start"), "x.suggestion")


def lexicon_spell_words(spark, sf):
    return lexicon_spell_issues(spark, sf).groupBy("word", "suggestion").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


def lexicon_phrases(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null")
    base = F.concat(F.lit("Magandang umaga! Kumusta ka, hindi ko alam. "), "src")
    return b.select("row_id", lexicon.replace_phrases(base).alias("out"))


def lexicon_corrected(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null")
    return b.select("row_id", lexicon.correct("src", _maps(spark, sf)[0]).alias("out"))


def lexicon_correction(spark, sf):
    """Texts that change, with the numbers of tokens that are new and that are gone."""
    b = table(spark, sf, "bombo")
    done = b.select("row_id", lexicon.correction("src", _maps(spark, sf)[0]).alias("c")).where("c is not null")
    n = lambda c: F.size(F.filter(c, lambda t: t["changed"])).cast("long")
    return done.select("row_id", "c.corrected", F.size("c.diff").cast("long").alias("tokens"), n("c.diff").alias("new"), F.size("c.orig_diff").cast("long").alias("old_tokens"), n("c.orig_diff").alias("gone"))


def lexicon_replaced_by_join(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null").select("row_id", "src")
    return lexicon.replace_by_join(b, "row_id", "src", lexicon_dialect_map(spark, sf))


def lexicon_converted(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null")
    d = _maps(spark, sf)[1]
    return b.select("row_id", lexicon.convert("src", d, F.create_map(F.lit("kumain"), F.lit("magkaon"))).alias("out"))


def lexicon_ba(spark, sf):
    b = table(spark, sf, "bombo").where("src is not null")
    return b.select("row_id", lexicon.question_particle(lexicon.drop_inversion(F.concat(F.lit("Ang bata ay nagkadto ba? "), "src")), True).alias("out"))


def grammar_matches(spark, sf):
    found = grammar.check(table(spark, sf, "bombo"), "row_id", "src")
    return found.select("id", F.col("match_no").cast("long").alias("match_no"), "rule", "severity", F.col("sentence_no").cast("long").alias("sentence_no"), F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"), "matched", F.array_join("suggestions", "|").alias("suggestions"))


def grammar_rules_from_data(spark, sf):
    rules = grammar.rules_from(grammar.rule_table(spark))
    return grammar.check(table(spark, sf, "bombo"), "row_id", "src", rules).groupBy("rule", "severity").agg(F.count("*").alias("n"))


def grammar_rule(spark, sf):
    return grammar.rule_by_id(grammar.rule_table(spark), "DOUBLE_NGA").select("id", "severity", F.size("pattern").cast("long").alias("tokens"), F.array_join("suggestions", "|").alias("suggestions"))


def grammar_rule_counts(spark, sf):
    return grammar.check(table(spark, sf, "bombo"), "row_id", "src").groupBy("rule", "severity").agg(F.count("*").alias("n"))


def grammar_single_words(spark, sf):
    return grammar.check(table(spark, sf, "bombo"), "row_id", "src", only=("AT_INSTEAD_OF_KAG", "TAGALOG_NG", "TAGALOG_NANG", "TAGALOG_HINDI")).groupBy("id", "rule").agg(F.count("*").alias("n"))


def grammar_stats(spark, sf):
    s = grammar.stats(table(spark, sf, "bombo").where("src is not null"), "row_id", "src")
    return s.select("id", *[F.col(c).cast("long").alias(c) for c in ("total", "distinct_words", "particles", "verbs")])


QUERIES = (
    text_measures, text_markup, text_cleaners, text_folded, text_sentences, text_dialogue, text_marked_language, text_slugs, text_replaced, text_entities, extract_article_corpus,
    extract_category_totals, extract_paragraphs, extract_new_urls, lexicon_dictionary, lexicon_dialect_map, lexicon_spell_words, lexicon_phrases, lexicon_corrected, lexicon_correction,
    lexicon_replaced_by_join, lexicon_converted, lexicon_ba, grammar_matches, grammar_rule_counts, grammar_single_words, grammar_stats, grammar_rules_from_data, grammar_rule,
)


def queries():
    return {f.__name__: f for f in QUERIES}


_MARK = "(" + ", ".join(f"'{m}'" for m in extract.MARKERS) + ")"
_NUM = rf"{trim(rf'''regexp_replace(regexp_replace(%s, '{WS}+', ' ', 'g'), '\[\p{{Nd}}+\]', '', 'g')''')}"
_SENT = rf"""parts as (select doc_id, source, unnest(string_split(regexp_replace(text, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))) raw from documents where text is not null),
sents as (select doc_id, source, sentence from (select doc_id, source, {_NUM % 'raw'} sentence from parts) where {nwords('sentence')} >= 5 and length(sentence) between 40 and 600)"""
_MARKED = lambda x: f"(len({toks(x)}) < 4 or len(list_filter(list_distinct({toks(x)}), lambda w: w in {_MARK})) >= 2)"
_DICT = f"""d as (select lower({trim('base_word')}) word, {trim('target_word')} target, concat_ws('|', base_word, target_word) o from dict_words),
dict as (select word, arg_max(target, o) target from d where word <> '' group by word)"""
_DIALECT = f"""d2 as (select {fold(trim('base_word'))} word, {trim('target_word')} target, concat_ws('|', base_word, target_word) o from dict_words),
l2 as (select word, arg_max(target, o) target from d2 where word <> '' group by word), v2 as (select distinct {fold('t')} word from (select unnest({toks('target')}) t from d2 where word <> '')),
dialect as (select * from l2 where word <> {fold('target')} and word not in (select word from v2))"""
_GT = r"""[A-Za-záéíóúÁÉÍÓÚñÑ][A-Za-záéíóúÁÉÍÓÚñÑ''-]*|[.,!?;:"]"""


def _phrases_sql(x: str) -> str:
    """Ordered replacement ignoring case; the capital of a match is spelled out, since the patterns begin with a letter."""
    for pattern, new in lexicon.PHRASES:
        p = pattern.replace(r"\s", WS)
        x = f"regexp_replace({x}, '{p[0].upper()}(?i:{p[1:]})', '{new[0].upper()}{new[1:]}', 'g')"
        x = f"regexp_replace({x}, '(?i:{p})', '{new}', 'g')"
    return x


_WORDS = r"[\p{L}\p{N}_''-]+|[^\p{L}\p{N}_''-]+"
_EDGE = r"(^|[^\p{L}\p{N}_])"


def _replaced_sql(x: str, table: str, key: str) -> str:
    new = f"{table}[{key}]"
    capital = "upper(left(t, 1)) = left(t, 1) and lower(left(t, 1)) <> left(t, 1)"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '{_WORDS}'), lambda t: case when {new} is null then t when {capital} then upper(left({new}, 1)) || substr({new}, 2) else {new} end), '')"


def _inversion_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(?i){_EDGE}((?:si|ang){WS}+(?:[\p{{L}}\p{{N}}_]|{WS})+?){WS}+ay{WS}+', '\1\2 ', 'g')"


def _ba_sql(x: str, flags: str) -> str:
    """Whole words; replaced twice, because neighbours share the mark between them."""
    one = lambda y: rf"regexp_replace({y}, '{flags}{_EDGE}ba($|[^\p{{L}}\p{{N}}_])', '\1bala\2', 'g')"
    return one(one(x))


def _letters_sql(x: str, known: str) -> str:
    low = "lower(t)"
    new = low
    for v in lexicon.VOWELS:
        new = f"replace({new}, 'l{v}', 'r{v}')"
    word = r"regexp_full_match(t, '[\p{L}\p{N}_''-]+') and length(t) >= 4"
    capital = "upper(left(t, 1)) = left(t, 1) and lower(left(t, 1)) <> left(t, 1)"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '{_WORDS}'), lambda t: case when {word} and not list_contains({known}, {low}) then case when {capital} then upper(left({new}, 1)) || substr({new}, 2) else {new} end else t end), '')"


def _spec_sql(spec: grammar.Spec, j: str) -> str:
    tests = []
    if spec.text:
        tests.append(f"l[{j}] in ({', '.join(chr(39) + t + chr(39) for t in spec.text)})")
    if spec.regex:
        tests.append(f"regexp_matches(a[{j}], '(?i){spec.regex}')")
    if spec.pos:
        tests.append(f"p[{j}] = '{spec.pos}'")
    both = "(" + " and ".join(tests) + ")"
    return f"not {both}" if spec.negate else both


def _rules_sql() -> str:
    particles = ", ".join(f"'{x}'" for x in grammar.PARTICLES)
    pos = f"case when w in ({particles}) then 'PARTICLE' when regexp_matches(w, '^(mag|nag|gin|gina|ma|na)[a-z]') then 'VERB' when ends_with(w, 'on') and length(w) > 3 then 'VERB' when ends_with(w, 'an') and length(w) > 3 then 'VERB_LOC' else 'NOUN' end"
    rules = " union all ".join(
        f"select row_id, '{r.id}' as rule, '{r.severity}' as severity, i from u where i + {len(r.pattern) - 1} <= len(a) and " + " and ".join(_spec_sql(s, f"i + {j}") for j, s in enumerate(r.pattern)) for r in grammar.RULES
    )
    return rf"""with s as (select row_id, unnest(string_split(regexp_replace({trim('src')}, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))) sent from bombo where src is not null),
k as (select row_id, regexp_extract_all(sent, '{_GT}') a from s), k2 as (select row_id, a, list_transform(a, lambda w: lower(w)) l from k), k3 as (select row_id, a, l, list_transform(l, lambda w: {pos}) p from k2),
u as (select row_id, a, l, p, unnest(range(1, len(a) + 1)) i from k3), hits as ({rules})"""


def _matches_sql() -> str:
    """Matches with their places: sentences are marked in the text together with the white space before them."""
    particles = ", ".join(f"'{x}'" for x in grammar.PARTICLES)
    pos = f"case when w in ({particles}) then 'PARTICLE' when regexp_matches(w, '^(mag|nag|gin|gina|ma|na)[a-z]') then 'VERB' when ends_with(w, 'on') and length(w) > 3 then 'VERB' when ends_with(w, 'an') and length(w) > 3 then 'VERB_LOC' else 'NOUN' end"
    rules = " union all ".join(
        f"select row_id, k, sent, base, {n} as rn, '{r.id}' as rule, '{r.severity}' as severity, '{'|'.join(r.suggestions).replace(chr(39), chr(39) * 2)}' as suggestions, st[i] as s, en[i + {len(r.pattern) - 1}] as e from u where i + {len(r.pattern) - 1} <= len(a) and " + " and ".join(_spec_sql(x, f"i + {j}") for j, x in enumerate(r.pattern))
        for n, r in enumerate(grammar.RULES)
    )
    return rf"""with b as (select row_id, string_split(regexp_replace({trim('src')}, '([.!?])({WS}+)', '\1' || chr(1) || '\2' || chr(2), 'g'), chr(1)) ps from bombo where src is not null),
c as (select row_id, unnest(ps) raw, generate_subscripts(ps, 1) - 1 k from b),
d as (select row_id, k, case when k > 0 then string_split(raw, chr(2))[1] else '' end ws, case when k > 0 then string_split(raw, chr(2))[2] else raw end sent from c),
f as (select row_id, k, sent, coalesce(sum(length(ws) + length(sent)) over (partition by row_id order by k rows between unbounded preceding and 1 preceding), 0) + length(ws) base from d),
g as (select *, regexp_extract_all(sent, '{_GT}|(?s:.)') z from f),
h as (select *, list_transform(range(1, len(z) + 1), lambda i: base + coalesce(list_sum(list_transform(z[1:i - 1], lambda t: length(t))), 0)) zs from g),
i as (select *, list_filter(range(1, len(z) + 1), lambda i: regexp_full_match(z[i], '{_GT}')) keep from h),
j as (select row_id, k, sent, base, list_transform(keep, lambda i: z[i]) a, list_transform(keep, lambda i: zs[i]) st, list_transform(keep, lambda i: zs[i] + length(z[i])) en from i),
l as (select *, list_transform(a, lambda w: lower(w)) l from j), p as (select *, list_transform(l, lambda w: {pos}) p from l),
u as (select *, unnest(range(1, len(a) + 1)) i from p), hits as ({rules})
select row_id as id, row_number() over (partition by row_id order by s, rn) as match_no, rule, severity, k as sentence_no, cast(s as bigint) as char_start, cast(e as bigint) as char_end, substr(sent, cast(s - base as bigint) + 1, cast(e - s as bigint)) as matched, suggestions from hits"""


_split = lambda x: rf"regexp_extract_all({x}, '[^\p{{Z}}\t\n\x0b\f\r\x{{85}}]+')"
_bare = lambda t: fold(rf"regexp_replace(lower({t}), '[^\p{{L}}\p{{N}}_]+', '', 'g')")
_bag = lambda x: f"list_transform({toks(x)}, lambda t: {fold('t')})"
_CORRECTED = f"""{_DIALECT}, m as (select map(list(word order by word), list(target order by word)) mm from dialect),
x as (select row_id, src, case when {trim('src')} = '' then src else {squeeze(_ba_sql(_inversion_sql(_replaced_sql(_phrases_sql('src'), 'mm', fold('t'))), '(?i)'))} end as out from bombo, m where src is not null)"""


def oracle_sql() -> dict[str, str]:
    joined = lambda c: f"md5(array_to_string({c}, chr(1)))"
    return {
        "text_measures": f"select doc_id, {joined(toks('text'))} as token_hash, {ntok('text')} as tokens, length({trim('text')}) as chars, {nwords('text')} as words, md5({squeeze('text')}) as squeezed, md5({trim('text')}) as trimmed from documents where text is not null",
        "text_markup": f"select page_id, p.index as index, {strip_html('p.html')} as plain, array_to_string({tags('p.html')}, '') as tags from (select page_id, unnest(paragraphs) p from scraped_pages) where p.html is not null",
        "text_cleaners": rf"with {LINES} select line_no, {_NUM % 'text'} as a, {squeeze(rf'''regexp_replace(regexp_replace(text, '^{WS}*\p{{Nd}}+{WS}*', ''), '\[[\p{{L}}\p{{N}}_]+\]', '', 'g')''')} as b, {trim(rf'''regexp_replace(regexp_replace(text, '#{WS}*\p{{Nd}}+:\p{{Nd}}+[^#]*', '', 'g'), ' {{2,}}', ' ', 'g')''')} as c from lines where text <> ''",
        "text_folded": f"select row_id, {fold('src')} as folded from bombo",
        "text_sentences": f"with {_SENT} select doc_id, sentence from sents",
        "text_dialogue": rf"with {LINES}, a as (select line_no, {trim(rf'''regexp_replace(text, '^\[\p{{Nd}}+\]{WS}*', '')''')} t from lines), b as (select line_no, {trim(r'''regexp_replace(t, '\(.*?\)', '', 'g')''')} t from a), c as (select line_no, {trim(r'''regexp_replace(t, ' {2,}', ' ', 'g')''')} t from b), e as (select line_no, {trim(rf'''regexp_replace(t, '^[A-Z][A-Z\s]+:{WS}*', '')''')} as text from c) select * from e where text <> ''",
        "text_marked_language": f"select row_id, {_MARKED('src')} as marked from bombo where src is not null",
        "text_slugs": r"select distinct regexp_replace(coalesce(title, url), '[^\p{L}\p{N}_\-.]', '_', 'g') as slug from crawl_log",
        "text_replaced": rf"with {PAIRS} select line_no, regexp_replace(src, '(?i)the ', 'DEN ', 'g') as a, array_to_string(list_transform(regexp_extract_all(tgt, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'), lambda w: case when w = 'ang' then 'an$g' else w end), '') as b, left(src, 4) || '_' || substr(src, 10) as c, len(regexp_extract_all(src, '(?i)the')) as n from pairs",
        "extract_article_corpus": f"with {_SENT}, k as (select * from sents where {_MARKED('sentence')}), m as (select *, min(doc_id) over (partition by sentence) f from k) select doc_id, source, sentence from m where doc_id = f",
        "extract_category_totals": "select category, count(distinct url) as articles, count(*) as sentences from crawl_log group by rollup(category)",
        "extract_paragraphs": f"with p as (select page_id, unnest(paragraphs) x from scraped_pages), q as (select page_id, x.index i, array_to_string(list_transform(string_split_regex(x.html, '<[^>]+>'), lambda t: {trim('t')}), '') t from p where x.html is not null) select page_id, count(*) as n, md5(string_agg(t, '|' order by i)) as h from q where t <> '' group by page_id",
        "extract_new_urls": "select url, cast(max(kept) as bigint) as kept from crawl_log where url is not null and url not in (select url from crawl_log where kept > 3 and url is not null) group by url",
        "lexicon_dictionary": f"with {_DICT} select word, target from dict",
        "lexicon_dialect_map": f"with {_DIALECT} select word, target from dialect",
        "lexicon_spell_words": rf"""with {_DIALECT}, t as (select row_id, regexp_extract_all(src, '[\p{{L}}\p{{N}}_''-]+|[^\p{{L}}\p{{N}}_''-]+') a from bombo where src is not null),
u as (select row_id, unnest(a) w, generate_subscripts(a, 1) i, a from t), x as (select row_id, w, coalesce(list_sum(list_transform(a[1:i - 1], lambda z: length(z))), 0) start from u where length(w) >= 2 and regexp_full_match(w, '[\p{{L}}\p{{N}}_''-]+') and not (upper(left(w, 1)) = left(w, 1) and lower(left(w, 1)) <> left(w, 1)))
select x.w as word, target as suggestion, count(*) as n, cast(sum(start) as bigint) as starts from x join dialect on word = {fold('x.w')} where word <> 'bata' group by x.w, target""",
        "lexicon_phrases": "select row_id, " + _phrases_sql("'Magandang umaga! Kumusta ka, hindi ko alam. ' || src") + " as out from bombo where src is not null",
        "lexicon_ba": "select row_id, " + _ba_sql(_inversion_sql("'Ang bata ay nagkadto ba? ' || src"), "(?i)") + " as out from bombo where src is not null",
        "lexicon_corrected": f"with {_CORRECTED} select row_id, out from x",
        "lexicon_correction": rf"""with {_CORRECTED}, y as (select row_id, out as corrected, {_split('src')} a, {_split('out')} b, {_bag('src')} p, {_bag('out')} q from x where out <> src)
select row_id, corrected, len(b) as tokens, len(list_filter(b, lambda t: not list_contains(p, {_bare('t')}))) as new, len(a) as old_tokens, len(list_filter(a, lambda t: not list_contains(q, {_bare('t')}))) as gone from y""",
        "lexicon_replaced_by_join": f"with {_DIALECT}, m as (select map(list(word order by word), list(target order by word)) mm from dialect) select row_id, {_replaced_sql('src', 'mm', fold('t'))} as src from bombo, m where src is not null",
        "lexicon_converted": rf"""with {_DICT}, m as (select map(list(word order by word), list(target order by word)) mm, list(word) || list(target) || ['kumain', 'magkaon', {', '.join("'" + w + "'" for w in lexicon.PROTECTED)}] known from dict),
v as (select row_id, src, mm, known, {_replaced_sql(_phrases_sql(squeeze('src')), "map(['kumain'], ['magkaon'])", 'lower(t)')} x from bombo, m where src is not null),
w as (select row_id, src, known, {_ba_sql(_inversion_sql(_replaced_sql('x', 'mm', 'lower(t)')), '')} x from v)
select row_id, case when {trim('src')} = '' then '' else {_letters_sql('x', 'known')} end as out from w""",
        "text_entities": "select doc_id, md5(text) as plain, chr(225) || chr(233) || chr(241) || chr(160) || '&none;&&lt; ' || source as mixed from documents where text is not null",
        "grammar_rules_from_data": _rules_sql() + " select rule, severity, count(*) as n from hits group by all",
        "grammar_rule": "select 'DOUBLE_NGA' as id, 'error' as severity, 2 as tokens, 'Remove one ''nga''.' as suggestions",
        "grammar_matches": _matches_sql(),
        "grammar_rule_counts": _rules_sql() + " select rule, severity, count(*) as n from hits group by all",
        "grammar_stats": rf"""with t as (select row_id as id, list_transform(regexp_extract_all(src, '{_GT}'), lambda w: lower(w)) a from bombo where src is not null),
p as (select *, list_filter(a, lambda w: w in ({', '.join("'" + x + "'" for x in grammar.PARTICLES)})) q from t)
select id, len(a) as total, len(list_distinct(a)) as distinct_words, len(q) as particles, len(list_filter(a, lambda w: w not in ({', '.join("'" + x + "'" for x in grammar.PARTICLES)}) and (regexp_matches(w, '^(mag|nag|gin|gina|ma|na)[a-z]') or (length(w) > 3 and (ends_with(w, 'on') or ends_with(w, 'an')))))) as verbs from p""",
        "grammar_single_words": rf"""with t as (select row_id as id, unnest(list_transform(regexp_extract_all(src, '{_GT}'), lambda w: lower(w))) w from bombo where src is not null)
select id, case w when 'at' then 'AT_INSTEAD_OF_KAG' when 'ng' then 'TAGALOG_NG' when 'nang' then 'TAGALOG_NANG' else 'TAGALOG_HINDI' end as rule, count(*) as n from t where w in ('at', 'ng', 'nang', 'hindi') group by all""",
    }

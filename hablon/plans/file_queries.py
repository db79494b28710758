"""Queries of readers, writers, page parsers, dictionaries, models and streams. What is read is first written to the shared
folder, so that every row goes through the files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.functions.text import squeeze as squeezed
from hablon.operators import dictionary, extract, keyed, models, pipelines, prep
from hablon.plans.corpus_queries import _POS, lines, pairs
from hablon.plans.edit_queries import collections
from hablon.plans.lineage import scratch
from hablon.plans.sqltext import LINES, PAIRS, WS, fold, nwords, squeeze, toks, trim
from hablon.plans.text_queries import _MARKED, _NUM, escaped, words_table
from hablon.session import table
from hablon.sources import readers, writers
from hablon.streaming import incremental


def file_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark)
    writers.delimited(pairs(spark, sf), path)
    return readers.table(spark, path, "\t")


def file_table_crlf(spark, sf):
    """The header line as an ordinary row."""
    path = scratch(spark)
    writers.delimited(pairs(spark, sf), path, line_end="\r\n", single=True)
    raw = readers.table(spark, path, "\t", header=False)
    return raw.toDF("line_no", "src", "tgt")


def file_pairs(spark, sf):
    path = scratch(spark)
    writers.delimited(pairs(spark, sf).withColumnRenamed("src", "one").withColumnRenamed("tgt", "two"), path, sep="|", single=True)
    return readers.pairs(spark, path, "two", "one", sep="|")


def file_short_rows(spark, sf):
    """Rows of one, two or three cells; rows without the second one have two empty texts."""
    path = scratch(spark)
    bare = lambda c: F.regexp_replace(c, '["\\t\\r\\n]', " ")
    one = F.when(F.col("line_no") % 3 == 0, bare("src")).when(F.col("line_no") % 3 == 1, F.concat(bare("src"), F.lit("\t"), bare("tgt"))).otherwise(F.concat(bare("src"), F.lit("\t"), bare("tgt"), F.lit("\tmore")))
    body = pairs(spark, sf).select("line_no", one.alias("text")).where("text <> ''")
    head = spark.range(1).select(F.lit(-1).cast("long").alias("line_no"), F.lit("src\ttgt").alias("text"))
    writers.lines(head.unionByName(body), path, single=True)
    return readers.pairs(spark, path, "src", "tgt", "\t")


def _plain_lines(spark, sf):
    return lines(spark, sf).withColumn("text", F.replace("text", F.lit("\r"), F.lit(" ")))


def file_lines(spark, sf):
    path = scratch(spark)
    writers.lines(_plain_lines(spark, sf), path)
    return readers.text_lines(spark, path).select("line_no", "text")


def file_filled_lines(spark, sf):
    path = scratch(spark)
    writers.lines(_plain_lines(spark, sf), path)
    return readers.filled_lines(spark, path).select("line_no", "text")


def file_json_lines(spark, sf):
    path = scratch(spark)
    p = pairs(spark, sf).select("src", F.array("tgt", F.concat(F.lit("> "), "tgt")).alias("trgs"))
    writers.json_lines(p, path)
    return readers.json_records(readers.text_lines(spark, path))[0].select("src", "tgt")


def file_json_array(spark, sf):
    text = writers.json_array(table(spark, sf, "mix_targets"), "source")
    made = spark.createDataFrame([(text,)], "j string").select(F.explode(F.from_json("j", "array<struct<source:string,target_share:double,max_repeats:int>>")).alias("r"))
    return made.select("r.source", "r.target_share", F.col("r.max_repeats").cast("long").alias("max_repeats"))


def file_source_only(spark, sf):
    path = scratch(spark)
    writers.source_only(_plain_lines(spark, sf).withColumnRenamed("text", "src"), path)
    return readers.text_lines(spark, path).select("line_no", "text")


def file_labelled(spark, sf):
    path = scratch(spark)
    d = keyed.numbered(table(spark, sf, "documents").where("text is not null").select("doc_id", squeezed("text").alias("text")), "doc_id")
    writers.labelled(d.select(F.col("line_no").alias("index"), "text"), "https://a.example/", "2025-01-01", path)
    return readers.text_lines(spark, path).select("line_no", "text")


def file_splits(spark, sf):
    """Both splits written as aligned files and read again side by side."""
    path = scratch(spark)
    p = pairs(spark, sf).select("line_no", squeezed("src").alias("hil"), squeezed("tgt").alias("en"))
    writers.aligned_splits(prep.split(p, 0.05, 42, "line_no").withColumnRenamed("line_no", "position"), path)
    sides = lambda name: keyed.zip_truncate(*(readers.text_lines(spark, f"{path}/{name}.{c}").select("line_no", "text") for c in ("hil", "en")))
    return reduce(DataFrame.unionByName, [sides(name).withColumn("split", F.lit(name)) for name in ("train", "dev")])


def file_rewrite(spark, sf):
    """A table written, read and rewritten in place of itself."""
    path = scratch(spark)
    writers.rewrite(pairs(spark, sf), path, "v1")
    first = readers.table(spark, readers_path := writers.current(spark, path), "\t")
    writers.rewrite(first.withColumn("src", F.upper("src")), path, "v2")
    assert writers.current(spark, path) != readers_path
    return readers.table(spark, writers.current(spark, path), "\t")


def file_clipboard(spark, sf):
    d = words_table(spark, sf)
    text = writers.clipboard(d.select("o", F.regexp_replace("base_word", r"\s", " ").alias("a"), F.regexp_replace("target_word", r"\s", " ").alias("b")), ["a", "b"], "o")
    return spark.createDataFrame([(text,)], "t string").select(F.explode(F.split("t", "\n")).alias("line")).select(F.split("line", "\t")[0].alias("base"), F.split("line", "\t")[1].alias("target"))


_XML = r"[^\p{L}\p{N}\p{P}\p{Sm}\x{20}\x{a0}]"


def _markup(c: str):
    x = F.regexp_replace(c, _XML, " ")
    for mark, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"), ("’", "&#8217;")):
        x = F.replace(x, F.lit(mark), F.lit(reference))
    return x


def file_tmx(spark, sf):
    path = scratch(spark)
    unit = F.concat(F.lit('<tu><tuv xml:lang="EN-us"><seg>'), _markup("src"), F.lit('</seg></tuv><tuv lang="hil"><seg> '), _markup("tgt"), F.lit("</seg></tuv></tu>"))
    ends = spark.createDataFrame([(-1, "<tmx><body>"), (1 << 60, "</body></tmx>")], "line_no long, text string")
    writers.lines(pairs(spark, sf).select("line_no", unit.alias("text")).unionByName(ends), path, single=True)
    return readers.tmx(spark, path, "en", "hil")


def file_moses(spark, sf):
    """Sentences of both sides as tokenised files whose first words are nested, zipped again."""
    paths = []
    for c in ("src", "tgt"):
        words = F.transform(F.regexp_extract_all(_markup(c), F.lit(r"[^\x{20}\x{a0}]+"), 0), lambda w: F.concat(F.lit('<w pos="a/b">'), w, F.lit("</w>")))
        body = F.concat(F.lit("<s id='1'><chunk>"), F.coalesce(F.get(words, 0), F.lit("")), F.lit("</chunk>\n"), F.array_join(F.slice(words, 2, 1_000_000), "\n"), F.lit("</s>"))
        paths.append(scratch(spark))
        writers.lines(pairs(spark, sf).select("line_no", body.alias("text")), paths[-1])
    return readers.moses_pairs(spark, *paths)


def file_discovery(spark, sf):
    path = scratch(spark)
    table(spark, sf, "test").select("row_id", "split").coalesce(1).write.partitionBy("split").parquet(path)
    found = dictionary.files_by_folder(readers.discover(spark, path, "*.parquet"))
    return found.select(F.element_at(F.split("dir", "/"), -1).alias("folder"), F.size("names").cast("long").alias("files"))


def file_checkpoint(spark, sf):
    """Addresses of a log that a checkpoint file does not hold."""
    path = scratch(spark)
    log = table(spark, sf, "crawl_log").where("url is not null")
    writers.lines(log.where("kept > 3").select("url", F.concat(F.lit(" "), "url", F.lit("  ")).alias("text")), path, order="url")
    return keyed.unseen(log.select(F.col("url").alias("key"), "title"), readers.visited(spark, path), "key")


def article_pages(spark, sf):
    """Documents as stored pages: every second one inside an article element, the others among page furniture."""
    d = table(spark, sf, "documents").where("text is not null")
    body = F.concat(F.lit("<p>"), F.array_join(F.split(F.replace(escaped(F.col("text")), F.lit(". "), F.lit(".<br> ")), "\n"), "</p>\n<p>"), F.lit("</p>"))
    junk = "Ini nga mga pulong bahin lamang sang pahina kag indi sang artikulo mismo."
    inside = F.concat(F.lit(f"<nav><p>{junk}</p></nav><article class='a'><div>"), body, F.lit(f"</div></article><article><p>{junk}</p></article>"))
    outside = F.concat(F.lit(f"<div class='x td-header-wrap'><div><p>{junk}</p></div></div><div>"), body, F.lit(f"</div><footer><p>{junk}</p></footer>"))
    html = F.concat(F.lit("<html><h1> Ang "), F.coalesce("source", F.lit("")), F.lit(" &amp; [12] iban</h1>"), F.when(F.col("doc_id") % 2 == 0, inside).otherwise(outside), F.lit("</html>"))
    return d.select("doc_id", "source", html.alias("html"))


def page_sentences(spark, sf):
    return extract.article_sentences(article_pages(spark, sf), "html", "doc_id").select("doc_id", "sentence")


def page_titles(spark, sf):
    return extract.titles(article_pages(spark, sf), "html", "doc_id")


def page_log(spark, sf):
    return extract.crawl_log(article_pages(spark, sf), "html", "doc_id", "source").select("doc_id", "source", "title", F.col("kept").cast("long").alias("kept"))


def page_links(spark, sf):
    log = table(spark, sf, "crawl_log").where("url is not null and category is not null")
    one = F.format_string("<div><h3 class='t'><a rel='b' href=\"%s\">x</a></h3><h2><a href='%s/no'>y</a></h2><h3><a href='%s'>z</a></h3></div>", "url", "url", F.regexp_replace("url", "^(https?://[^/]+).*", "$1/tag/a"))
    pages = log.groupBy("category").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("url", one.alias("h")))), lambda x: x["h"]), "\n").alias("html")).withColumn("page", F.lit(1))
    return extract.category_links(pages, "html", "category", "page", "://", 500).select("category", "url", F.col("n").cast("long").alias("n"))


def _chapters(spark, sf, side: str, verse: str):
    p = table(spark, sf, "paired_lines").select("file_id", "line_no", F.replace(F.replace(F.replace(F.coalesce(side, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")).alias("t"))
    cell = F.format_string(verse, "file_id", "line_no", "line_no", "t")
    return p.groupBy("file_id").agg(F.concat(F.lit("<div>"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", cell.alias("h")))), lambda x: x["h"]), " "), F.lit("</div>")).alias("html"))


_KEYED = '<span class="verse" data-usfm="GEN.%d.%d"><span class="label">%d</span><span class="content">%s</span></span>'


def page_verses(spark, sf):
    return pipelines.verse_corpus(*(_chapters(spark, sf, c, _KEYED) for c in ("src", "tgt")), "html")


def page_labelled_verses(spark, sf):
    """The layout without keys: numbered labels beside the texts."""
    pages = _chapters(spark, sf, "src", '<div class="verse v%d-%d"><span class="x label">%d</span><b class="content"><i>%s</i></b></div>')
    return extract.verses(pages, "html", "file_id", chapter="file_id").select("file_id", "chapter", "verse", "text")


def dictionary_rules(spark, sf):
    rows = words_table(spark, sf).select(F.col("base_word").alias("pattern"), F.col("target_word").alias("replacement"), "o")
    return spark.createDataFrame([(i, *r) for i, r in enumerate(dictionary.phrase_rules(rows, "o"))], "n long, pattern string, replacement string")


def dictionary_words(spark, sf):
    words = table(spark, sf, "dict_words").select(F.col("target_word").alias("word")).where("word is not null")
    return dictionary.remove_words(dictionary.add_words(words, [" Bag-o ", "ÁLOG", ""]), ["Balay"])


def dictionary_entries(spark, sf):
    entries = words_table(spark, sf).select("base_word", "target_word", "o")
    one = entries.select(F.lower(F.trim("base_word")).alias("word"), F.col("target_word").alias("target")).groupBy("word").agg(F.max("target").alias("target"))
    return dictionary.remove_entry(dictionary.add_entry(dictionary.add_entry(one, " Bahay", "ulot"), "bag-ong", "bag-o"), "TUBIG")


def dictionary_rebuilt(spark, sf):
    extra = spark.createDataFrame([("Bahay", "ulot"), ("ikaduha", "ikaduha")], "word string, target string")
    return dictionary.rebuilt_map(words_table(spark, sf), extra.withColumnsRenamed({"word": "base_word", "target": "target_word"}), "base_word", "target_word")


def dictionary_search(spark, sf):
    d = table(spark, sf, "dict_words").select(F.col("base_word").alias("word"), F.col("target_word").alias("target"))
    return dictionary.search_entries(d, "La")


def dictionary_settings(spark, sf):
    s = table(spark, sf, "mix_targets").select(F.col("source").alias("key"), F.col("max_repeats").cast("string").alias("value"), F.lit(None).cast("timestamp").alias("updated_at"))
    return dictionary.set_setting(dictionary.set_setting(s, "custom_dict", '["Ako", "ako", "Ñ"]'), "custom_dict", '["Ikaw", "ako"]').select("key", "value")


def dictionary_custom(spark, sf):
    """Words of a file in normal form, and those of the settings as they are."""
    words = table(spark, sf, "dict_words").select(F.col("base_word").alias("word"))
    stored = dictionary_settings(spark, sf)
    return readers.custom_words(stored.where("key <> 'custom_dict'"), words).withColumn("part", F.lit("file")).unionByName(readers.custom_words(stored, words).withColumn("part", F.lit("settings")))


def dictionary_longest(spark, sf):
    d = table(spark, sf, "documents").where("text is not null")
    return dictionary.longest(d, F.length("text").cast("long"), 20, "doc_id").select("doc_id", "size")


def dictionary_books(spark, sf):
    names = [r.source for r in table(spark, sf, "mix_targets").select("source").orderBy("source").collect()]
    return dictionary.known_books(table(spark, sf, "documents"), names, names, "source").groupBy("source").agg(F.count("*").alias("n"))


def collection_manage(spark, sf):
    """Collections created, and one renamed."""
    c = dictionary.empty_collections(spark)
    for name in ("one", "two"):
        c = dictionary.create_collection(c, name, ["src", "tgt"])
    c = c.withColumn("id", F.col("name"))
    return dictionary.update_collection(c, "two", "three", ["a"]).select("id", "name", F.array_join("headers", ",").alias("headers"), F.col("row_count").cast("long").alias("row_count"))


def _counted(spark, sf):
    rows = collections(spark, sf).select(F.concat_ws("-", "source", "position").alias("id"), F.col("source").alias("collection_id"), "position")
    return rows, rows.groupBy(F.col("collection_id").alias("id")).agg(F.count("*").alias("row_count"))


def collection_delete_rows(spark, sf):
    rows, owners = _counted(spark, sf)
    return dictionary.delete_rows_by_id(rows, owners, rows.where("position % 3 = 1 or position > 100").select("id"))[1]


def source_retry_after(spark, sf):
    log = table(spark, sf, "crawl_log").where("url is not null and ts is not null and loaded_at is not null and kept is not null")
    value = F.when(F.col("kept") % 3 == 0, F.concat(F.lit(" "), F.col("kept").cast("string"))).when(F.col("kept") % 3 == 1, F.concat(F.date_format("loaded_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).otherwise("soon")
    return log.select("url", "ts", readers.retry_after(value, F.date_trunc("second", "ts")).alias("wait"))


def source_contained(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    path = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("a/../"), "source", F.lit("/./b"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("../"), "source")).when(F.col("doc_id") % 4 == 2, F.concat(F.lit("/data/x/../corpus//"), "source")).otherwise("/data/corpus2/a")
    return d.select("doc_id", readers.contained_path("/data/corpus", path).alias("path"))


def source_columns(spark, sf):
    """Which columns of the tables hold which language."""
    from hablon.operators.edit import language_columns

    found = [(name, *readers.resolve_columns(cols := table(spark, sf, name).columns), language_columns([*cols, "tgt_hil", "English"])["en"]) for name in ("test", "bombo", "paired_lines")]
    return spark.createDataFrame(found, "name string, src string, tgt string, en string")


def model_translate(spark, sf):
    """A model that answers too few lines for some batches, whose lines are then sent one by one."""

    def factory():
        return lambda texts: ["> " + t for t in texts][: None if len(texts) % 2 else -1] if len(texts) > 1 else ["> " + t for t in texts]

    b = table(spark, sf, "bombo").select("row_id", "src")
    return models.translate(b, factory, "src", "out").select("row_id", "out")


def model_annotate(spark, sf):
    b = table(spark, sf, "bombo").select("row_id", "src")
    return models.annotate(b, lambda: lambda t: str(len(t)), "src", "size").select("row_id", "size")


def model_grammar(spark, sf):
    """A checker that dislikes two words, one of which is in the custom dictionary."""

    def factory():
        import re

        return lambda t: [(m.start(), m.end(), "no", ["a", "b", "c", "d"]) for m in re.finditer(r"\b(?:the|ang)\b", t)]

    p = pairs(spark, sf)
    found = models.grammar_issues(p.select("line_no", "src"), factory, "src", ["ang"])
    return found.select("line_no", F.size("issues").cast("long").alias("n"), F.coalesce(F.aggregate("issues", F.lit(0), lambda a, i: a + F.size(i["replacements"])), F.lit(0)).cast("long").alias("replacements"))


def model_pages(spark, sf):
    """Binary files recognised page by page, and the pages of each put together."""
    path = scratch(spark)
    d = table(spark, sf, "mix_targets").select("source", F.concat_ws("\f", "source", F.upper("source")).alias("value"))
    d.repartition(4, "source").write.partitionBy("source").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    pages = models.recognise_pages(files, lambda: lambda content: iter(content.decode().strip().split("\f")))
    return models.page_texts(pages).select("text")


def model_remaining(spark, sf):
    p = pairs(spark, sf)
    numbered = keyed.numbered(p.select("src", F.col("line_no").alias("row_id")), "row_id")
    return models.remaining(numbered, table(spark, sf, "documents")).select("line_no", "row_id")


def _stream(spark, sf, path: str):
    d = table(spark, sf, "documents").where("text is not null")
    made = d.select(F.col("doc_id").cast("string").alias("url"), F.col("source").alias("category"), "text", F.coalesce("fetched_at", F.lit("2000-01-01").cast("timestamp")).alias("ts"))
    made.coalesce(4).write.json(path)
    return incremental.article_stream(spark, path)


def stream_first_articles(spark, sf):
    src, out, state = scratch(spark), scratch(spark), scratch(spark)
    articles = _stream(spark, sf, src)
    for _ in range(2):  # the second run finds nothing new
        incremental.append(incremental.first_article_sentences(articles), out, state).awaitTermination()
    return spark.read.parquet(out).select("url", "category", "sentence")


def stream_new_articles(spark, sf):
    src, out, state = scratch(spark), scratch(spark), scratch(spark)
    incremental.append(incremental.new_articles(_stream(spark, sf, src), "10000 days"), out, state).awaitTermination(540)
    return spark.read.parquet(out).select("url", "category")


QUERIES = (
    file_table, file_table_crlf, file_pairs, file_short_rows, file_lines, file_filled_lines, file_json_lines, file_json_array, file_source_only, file_labelled, file_splits,
    file_rewrite, file_clipboard, file_tmx, file_moses, file_discovery, file_checkpoint, page_sentences, page_titles, page_log, page_links, page_verses, page_labelled_verses,
    dictionary_rules, dictionary_words, dictionary_entries, dictionary_rebuilt, dictionary_search, dictionary_settings, dictionary_custom, dictionary_longest, dictionary_books,
    collection_manage, collection_delete_rows, source_retry_after, source_contained, source_columns, model_translate, model_annotate, model_grammar, model_pages, model_remaining,
    stream_first_articles, stream_new_articles,
)


def queries():
    return {f.__name__: f for f in QUERIES}


_NUMBERED = "row_number() over (order by line_no)"
_PLAIN = "replace(text, chr(13), ' ')"
_KEEP = lambda c: rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}\p{{P}}\p{{Sm}}\x{{20}}\x{{a0}}]', ' ', 'g')"
_WORDS_OF = lambda c: rf"array_to_string(list_filter(list_transform(regexp_extract_all({_KEEP(c)}, '[^\x{{20}}\x{{a0}}]+'), lambda w: {trim('w')}), lambda w: w <> ''), ' ')"
_PAGES = rf"""pl as (select doc_id, source, unnest(string_split(text, chr(10))) line from documents where text is not null),
pn as (select doc_id, source, {_NUM % 'line'} line from pl), ps as (select doc_id, source, unnest(string_split(regexp_replace(line, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))) raw from pn),
pt as (select doc_id, source, {_NUM % 'raw'} sentence from ps), pages as (select * from pt where {nwords('sentence')} >= 5 and length(sentence) between 40 and 600)"""
_TITLE = "'Ang ' || coalesce(source, '') || ' &  iban'"
_VERSE = lambda c: squeeze(rf"regexp_replace(regexp_replace(line_no || ' ' || {trim(f'''coalesce({c}, '')''')}, '^{WS}*\p{{Nd}}+{WS}*', ''), '\[[\p{{L}}\p{{N}}_]+\]', '', 'g')")
_BARE = lambda c: f"regexp_replace({c}, '[\"\\t\\r\\n]', ' ', 'g')"


def oracle_sql() -> dict[str, str]:
    sentences = rf"""sp as (select doc_id, source, fetched_at, unnest(string_split(regexp_replace(text, '([.!?]){WS}+', '\1' || chr(1), 'g'), chr(1))) raw from documents where text is not null),
ss as (select *, {_NUM % 'raw'} sentence from sp), sk as (select * from ss where {nwords('sentence')} >= 5 and length(sentence) between 40 and 600 and {_MARKED('sentence')})"""
    return {
        "file_table": f"with {PAIRS} select {_NUMBERED} as line_no, src, tgt from pairs",
        "file_table_crlf": f"with {PAIRS} select 1 as line_no, 'src' as src, 'tgt' as tgt union all select {_NUMBERED} + 1, src, tgt from pairs",
        "file_pairs": f"with {PAIRS} select {_NUMBERED} as line_no, {trim('tgt')} as src, {trim('src')} as tgt from pairs",
        "file_short_rows": f"with {PAIRS}, t as (select line_no, line_no % 3 n, {_BARE('src')} a, {_BARE('tgt')} b from pairs) select {_NUMBERED} as line_no, case when n = 0 then '' else {trim('a')} end as src, case when n = 0 then '' else {trim('b')} end as tgt from t where n > 0 or a <> ''",
        "file_lines": f"with {LINES} select {_NUMBERED} as line_no, {_PLAIN} as text from lines",
        "file_filled_lines": f"with {LINES}, n as (select {_NUMBERED} as line_no, {_PLAIN} as text from lines) select * from n where {trim('text')} <> ''",
        "file_json_lines": f"with {PAIRS}, t as (select {trim('src')} a, {trim('tgt')} b, {trim(chr(39) + '> ' + chr(39) + ' || tgt')} c from pairs), u as (select a as src, unnest([b, c]) as tgt from t) select * from u where src <> '' and tgt <> ''",
        "file_json_array": "select source, target_share, cast(max_repeats as bigint) as max_repeats from mix_targets",
        "file_source_only": f"with {LINES} select {_NUMBERED} as line_no, {_PLAIN} || chr(9) as text from lines",
        "file_labelled": f"with n as (select row_number() over (order by doc_id) i, {squeeze('text')} t from documents where text is not null), h as (select unnest([1, 2, 3, 4]) line_no, unnest(['Source: https://a.example/', 'Scraped: 2025-01-01', 'Total paragraphs: ' || (select count(*) from n), '']) as text) select * from h union all select i + 4, '[' || i || '] ' || t from n",
        "file_splits": f"with s as (select case when {_POS(42, 'row_id')} <= ceil(count(*) over () * (1 - 0.05)) then 'train' else 'dev' end as split, row_id, {squeeze('coalesce(src, chr(32))')} as src, {squeeze('coalesce(tgt, chr(32))')} as tgt from test) select split, row_number() over (partition by split order by row_id) as line_no, src, tgt from s",
        "file_rewrite": f"with {PAIRS} select {_NUMBERED} as line_no, upper(src) as src, tgt from pairs",
        "file_clipboard": r"select regexp_replace(coalesce(base_word, ''), '\s', ' ', 'g') as base, regexp_replace(coalesce(target_word, ''), '\s', ' ', 'g') as target from dict_words",
        "file_tmx": f"with {PAIRS}, t as (select {trim(_KEEP('src'))} as src, {trim(_KEEP('tgt'))} as tgt from pairs) select * from t where src <> '' and tgt <> ''",
        "file_moses": f"with {PAIRS}, a as (select row_number() over (order by line_no) as line_no, t as src from (select line_no, {_WORDS_OF('src')} t from pairs) where t <> ''), b as (select row_number() over (order by line_no) as line_no, t as tgt from (select line_no, {_WORDS_OF('tgt')} t from pairs) where t <> '') select line_no, src, tgt from a join b using (line_no)",
        "file_discovery": "select distinct 'split=' || split as folder, 1 as files from test",
        "file_checkpoint": "select url as key, title from crawl_log where url is not null and url not in (select url from crawl_log where kept > 3 and url is not null)",
        "page_sentences": f"with {_PAGES} select doc_id, sentence from pages",
        "page_titles": f"select doc_id, {_TITLE} as title from documents where text is not null",
        "page_log": f"with {_PAGES}, k as (select doc_id, count(*) n from pages where {_MARKED('sentence')} group by doc_id) select doc_id, source, {_TITLE} as title, coalesce(n, 0) as kept from documents left join k using (doc_id) where text is not null",
        "page_links": r"with u as (select distinct category, url from crawl_log where url is not null and category is not null and contains(url, '://') and not regexp_matches(regexp_extract(url, '^[a-z]+://[^/]+([^?#]*)', 1), '^/(category|tag|author|page|search)')), n as (select *, row_number() over (partition by category order by url) as n from u) select category, url, n from n where n <= 500",
        "page_verses": f"with v as (select file_id, line_no, {_VERSE('src')} src, {_VERSE('tgt')} tgt from paired_lines) select 'GEN' as book, cast(file_id as int) as chapter, line_no as verse, src, tgt from v where src <> '' and tgt <> ''",
        "page_labelled_verses": f"with v as (select file_id, line_no, {squeeze(rf'''regexp_replace(regexp_replace({trim(chr(99) + 'oalesce(src, chr(32))')}, '^{WS}*\p{{Nd}}+{WS}*', ''), '\[[\p{{L}}\p{{N}}_]+\]', '', 'g')''')} t from paired_lines) select file_id, cast(file_id as int) as chapter, line_no as verse, t as text from v where t <> ''",
        "dictionary_rules": f"select row_number() over (order by concat_ws('|', base_word, target_word)) - 1 as n, {trim('base_word')} as pattern, {trim('target_word')} as replacement from dict_words where {trim('base_word')} <> '' and {trim('target_word')} <> ''",
        "dictionary_words": f"select distinct {fold(trim('w'))} as word from (select target_word w from dict_words union all select unnest(['bag-o', 'alog'])) where {trim('w')} <> '' and {fold(trim('w'))} <> 'balay'",
        "dictionary_entries": "with o as (select lower(trim(base_word, ' ')) word, max(target_word) target from dict_words group by 1) select * from o where word is not null and word not in ('bahay', 'bag-ong', 'tubig') union all select 'bahay', 'ulot' union all select 'bag-ong', 'bag-o'",
        "dictionary_rebuilt": f"""with d2 as (select {fold(trim('base_word'))} word, {trim('target_word')} target, 0 part, concat_ws('|', base_word, target_word) o from dict_words union all select 'bahay', 'ulot', 1, 'Bahay' union all select 'ikaduha', 'ikaduha', 1, 'ikaduha'),
l2 as (select word, arg_max(target, (part, o)) target from d2 where word <> '' group by word), v2 as (select distinct {fold('t')} word from (select unnest({toks('target')}) t from d2 where word <> ''))
select * from l2 where word <> {fold('target')} and word not in (select word from v2)""",
        "dictionary_search": "select base_word as word, target_word as target from dict_words where contains(lower(base_word), 'la') or contains(lower(target_word), 'la')",
        "dictionary_settings": """select source as "key", cast(max_repeats as varchar) as "value" from mix_targets union all select 'custom_dict', '["Ikaw", "ako"]'""",
        "dictionary_custom": f"select distinct {fold(trim('base_word'))} as word, 'file' as part from dict_words where {trim('base_word')} <> '' union all select unnest(['Ikaw', 'ako']), 'settings'",
        "dictionary_longest": "select doc_id, length(text) as size from documents where text is not null order by length(text) desc, doc_id limit 20",
        "dictionary_books": "select source, count(*) as n from documents where source in (select source from mix_targets) group by source",
        "collection_manage": "select 'one' as id, 'one' as name, 'src,tgt' as headers, 0 as row_count union all select 'two', 'three', 'a', 0",
        "collection_delete_rows": "with d as (select source, row_number() over (partition by source order by row_id) - 1 as position from test) select source as id, count(*) filter (where not (position % 3 = 1 or position > 100)) as row_count from d group by source",
        "source_retry_after": "select url, ts, case when kept % 3 = 0 then cast(kept as double) when kept % 3 = 1 then greatest(1.0, cast(epoch(date_trunc('second', loaded_at)) - epoch(date_trunc('second', ts)) as double)) else 10.0 end as wait from crawl_log where url is not null and ts is not null and loaded_at is not null and kept is not null",
        "source_contained": "select doc_id, case doc_id % 4 when 0 then '/data/corpus/' || source || '/b' when 2 then '/data/corpus/' || source end as path from documents",
        "source_columns": "select unnest(['test', 'bombo', 'paired_lines']) as name, unnest(['source', 'src', 'src']) as src, 'tgt' as tgt, 'English' as en",
        "model_translate": f"select row_id, case when {trim('coalesce(src, chr(32))')} = '' then coalesce(src, '') else '> ' || src end as out from bombo",
        "model_annotate": "select row_id, cast(length(src) as varchar) as size from bombo",
        "model_grammar": rf"with {PAIRS}, t as (select line_no, len(list_filter(regexp_extract_all(src, '[\p{{L}}\p{{N}}_]+'), lambda w: w = 'the')) n from pairs) select line_no, n, n * 3 as replacements from t",
        "model_pages": "select '--- PAGE 1 ---' || chr(10) || source || chr(10) || chr(10) || '--- PAGE 2 ---' || chr(10) || upper(source) as text from mix_targets",
        "model_remaining": "select * from (select row_number() over (order by row_id) as line_no, row_id from test) where line_no > (select count(*) from documents)",
        "stream_first_articles": f"with {sentences}, f as (select *, first_value(cast(doc_id as varchar)) over (partition by sentence order by coalesce(fetched_at, timestamp '2000-01-01'), cast(doc_id as varchar)) u from sk) select cast(doc_id as varchar) as url, source as category, sentence from f where cast(doc_id as varchar) = u",
        "stream_new_articles": "select cast(doc_id as varchar) as url, source as category from documents where text is not null",
    }

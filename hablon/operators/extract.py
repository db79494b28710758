"""Extraction of lines, sentences, paragraphs, links and verses from raw text and stored pages."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hablon.functions.dom import Node, parse
from hablon.functions.text import entities, pytrim, sentences, squeeze, tokens, word_count
from hablon.plans.workers import prepared

LEAST_WORDS, LEAST_CHARS, MOST_CHARS = 5, 40, 600
# fixed values: marker words of the language test
MARKERS = ("ang", "nga", "sang", "kag", "sa", "si", "ni", "mga", "isa", "kon", "kay", "siya", "niya", "ining", "gid", "man", "lang", "na", "pa", "bangud", "apang", "kundi")
NOT_ARTICLES = r"^/(category|tag|author|page|search)"  # fixed value: paths that hold no article


def numbered_removed(x: Column) -> Column:
    """White space collapsed first, then bracketed numbers removed, which may leave two blanks."""
    return pytrim(F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), r"\[\p{Nd}+\]", ""))


def verse_text(x: Column) -> Column:
    """Leading verse number and bracketed references removed, white space collapsed."""
    return squeeze(F.regexp_replace(F.regexp_replace(x, r"(?U)^\s*\d+\s*", ""), r"\[[\p{L}\p{N}_]+\]", ""))


def footnotes_removed(x: Column) -> Column:
    """Every note ``# 1:20 ...`` up to the next ``#`` removed, runs of blanks collapsed."""
    return pytrim(F.regexp_replace(F.regexp_replace(x, r"#(?U:\s*\d+:\d+)[^#]*", ""), " {2,}", " "))


def utterance(x: Column) -> Column:
    """A line of dialogue without its number, remarks in parentheses and speaker; empty if nothing is left."""
    y = pytrim(F.regexp_replace(x, r"^\[\p{Nd}+\](?U:\s*)", ""))
    y = pytrim(F.regexp_replace(y, r"\(.*?\)", ""))
    y = pytrim(F.regexp_replace(y, " {2,}", " "))
    return pytrim(F.regexp_replace(y, r"^[A-Z][A-Z\s]+:(?U:\s*)", ""))


def dialogue(lines: DataFrame, text: str = "text") -> DataFrame:
    """Lines with their utterance in place of the text; lines without one dropped."""
    rest = [c for c in lines.columns if c != text]
    return lines.select(*rest, F.explode(F.array(utterance(F.col(text)))).alias(text)).where(F.col(text) != "").select(*lines.columns)


def sentence_rows(df: DataFrame, text: str, *keep: str, least_words: int = LEAST_WORDS, least_chars: int = LEAST_CHARS, most_chars: int = MOST_CHARS) -> DataFrame:
    """One row per sentence of acceptable length: ``keep`` columns, ``pos``, ``sentence``."""
    # cleaned inside the generator, whose output the filters above it read; a projection would be evaluated by each of them
    s = df.select(*keep, F.posexplode(F.transform(sentences(text), numbered_removed)).alias("pos", "sentence"))
    n = F.length("sentence")
    return s.where((n >= least_chars) & (n <= most_chars)).where(word_count("sentence") >= least_words)


def marked_language(x: Column) -> Column:
    """At least two distinct marker words, or fewer than four words, which are too few to tell."""
    t = tokens(x)
    return (F.size(t) < 4) | (F.size(F.array_intersect(F.array_distinct(t), F.array(*map(F.lit, MARKERS)))) >= 2)


def first_article_only(df: DataFrame, sentence: str, article: str) -> DataFrame:
    """Sentences kept in the first article that has them; repeats inside that article stay."""
    first = df.groupBy(sentence).agg(F.min(article).alias("__first"))
    return df.join(first, sentence).where(F.col(article) == F.col("__first")).drop("__first")


def article_corpus(articles: DataFrame, text: str, article: str, category: str) -> DataFrame:
    """Sentences of all articles: cut, gated by length and language, each kept in its first article."""
    s = sentence_rows(articles, text, article, category)
    return first_article_only(s.where(marked_language(F.col("sentence"))), "sentence", article)


def category_totals(kept: DataFrame, category: str, article: str) -> DataFrame:
    """Articles and sentences per category, with a grand total whose category is NULL."""
    return kept.rollup(category).agg(F.count_distinct(article).alias("articles"), F.count("*").alias("sentences"))


def paragraphs(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """``keep``, ``index`` (1-based over all paragraphs) and text of the paragraphs that are not empty. Scripts and
    comments are no paragraphs. Each stretch of text between tags is stripped and the stretches are joined without a
    blank, as stored pages have them."""
    body = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    cells = F.regexp_extract_all(body, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"), 1)
    p = pages.select(*keep, F.posexplode(cells).alias("i", "h"))
    return p.select(*keep, (F.col("i") + 1).alias("index"), F.array_join(F.transform(F.split("h", r"<[^>]+>"), lambda t: pytrim(entities(t))), "").alias("text")).where("text <> ''")


# fixed value: selectors of page furniture, tags and classes
CHROME_TAGS, CHROME_CLASSES = ("nav", "header", "footer"), ("td-header-wrap", "td-footer-container")


def _chrome(node: Node) -> bool:
    return node.tag in CHROME_TAGS or any(c in CHROME_CLASSES for c in node.classes())


def _article(html: str | None) -> tuple[str, list[str]]:
    root = parse(html)
    nodes = list(root.walk())
    heading = next((n for n in nodes if n.tag == "h1"), None)
    article = next((n for n in nodes if n.tag == "article"), None)
    inside = article.walk() if article is not None else root.walk(_chrome)
    return heading.text() if heading is not None else "", [n.text(" ") for n in inside if n.tag == "p"]


def _per_page(pages: DataFrame, html: str, keep: tuple[str, ...], fields: str, rows_of: Callable[[str | None], list[tuple]]) -> DataFrame:
    """``keep`` and the rows that ``rows_of`` makes of each page, parsed in Arrow batches."""
    schema = [f.strip().split() for f in fields.split(",")]
    kinds = {"string": pa.string(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *row) for i, h in enumerate(batch.column(html).to_pylist()) for row in rows_of(h)]
            at = pa.array([r[0] for r in found], pa.int64())
            made = [pa.array([r[k + 1] for r in found], kinds[t]) for k, (_, t) in enumerate(schema)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in keep), *made], [*keep, *(n for n, _ in schema)])

    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return prepared(pages).select(*keep, html).mapInArrow(run, f"{kept + ', ' if kept else ''}{', '.join(f'`{n}` {t}' for n, t in schema)}")


def article_blocks(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """``keep``, ``part``, ``text`` of stored article pages: part 0 is the first main heading, the others are the
    paragraphs of the first article element, or, in a page without one, those outside navigation, header and footer.

    Text around inline elements is kept apart by a blank, white space is collapsed, bracketed numbers go. A page without a
    heading has an empty part 0. NULL and empty pages have that part only.
    """
    def rows(page: str | None) -> list[tuple]:
        heading, body = _article(page)
        return [(i, t) for i, t in enumerate([heading, *body])]

    return _per_page(pages, html, keep, "part int, text string", rows).withColumn("text", numbered_removed(F.col("text")))


def article_sentences(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """``keep``, ``part``, ``pos``, ``sentence``: sentences of acceptable length of stored article pages, those of the
    heading first."""
    return sentence_rows(article_blocks(pages, html, *keep), "text", *keep, "part")


def titles(pages: DataFrame, html: str, *keep: str) -> DataFrame:
    """``keep``, ``title``: the first main heading of each page, empty if there is none."""
    return article_blocks(pages, html, *keep).where("part = 0").select(*keep, F.col("text").alias("title"))


def crawl_log(pages: DataFrame, html: str, url: str, category: str) -> DataFrame:
    """``url, category, title, kept``: what a crawl logs of each page: its heading and how many sentences it has kept."""
    kept = article_sentences(pages, html, url).where(marked_language(F.col("sentence"))).groupBy(url).agg(F.count("*").alias("kept"))
    return pages.select(url, category).join(titles(pages, html, url), url).join(kept, url, "left").select(url, category, "title", F.coalesce("kept", F.lit(0)).cast("int").alias("kept"))


def category_links(pages: DataFrame, html: str, category: str, page_no: str, base: str, most: int) -> DataFrame:
    """``category, url``: links under third-level headings on the site that may be articles, each once per category in
    the order of appearance, at most ``most`` of them."""
    heads = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<h3[^>]*>(.*?)</h3>"), 1)
    links = pages.select(category, page_no, F.posexplode(F.flatten(F.transform(heads, lambda h: F.regexp_extract_all(h, F.lit(r"""(?is)<a\b[^>]*?href=["']([^"']+)["']"""), 1)))).alias("pos", "url"))
    ok = F.contains("url", F.lit(base)) & ~F.coalesce(F.expr("try_parse_url(url, 'PATH')"), F.lit("")).rlike(NOT_ARTICLES)
    first = links.where(ok).groupBy(category, "url").agg(F.min(F.struct(page_no, "pos")).alias("at"))
    return first.withColumn("n", F.row_number().over(Window.partitionBy(category).orderBy("at"))).where(F.col("n") <= most).select(category, "url", "n")


_LABEL = re.compile("label|number")
_INTEGER = re.compile(r"\s*[+-]?\d+\s*\Z")


def _keyed_verses(root: Node) -> list[tuple[str, str, int, str]]:
    out = []
    for span in root.walk():
        parts = span.attrs.get("data-usfm", "").split(".")
        if span.tag != "span" or len(parts) != 3 or not _INTEGER.match(parts[2]):
            continue
        inner = [w for n in span.walk() if n.tag in ("span", "p") and (w := n.words())]
        out.append((parts[0], parts[1], int(parts[2]), " ".join(inner) or span.words()))
    return out


def _labelled_verses(root: Node) -> list[tuple[int, str]]:
    out = []
    for node in root.walk():
        above = node.parent
        while above is not None and "verse" not in above.attrs.get("class", ""):
            above = above.parent
        if "content" not in node.attrs.get("class", "") or above is None or not node.words():
            continue
        label = next((n.words() for n in node.parent.walk() if any(_LABEL.search(c) for c in n.classes())), "")
        if _INTEGER.match(label) and int(label):
            out.append((int(label), node.words()))
    return out


def verses(pages: DataFrame, html: str, *keep: str, book: str | None = None, chapter: str | None = None) -> DataFrame:
    """``keep``, book, chapter, verse and text of stored chapter pages.

    Verses are spans with a three-part key that ends in a number; their text is that of the spans and paragraphs
    they hold, nested ones again, or else their own. A page without any gives the elements of a ``content`` class inside a
    ``verse`` class that stand beside a numbered label; book and chapter come from the columns ``book`` and
    ``chapter`` then, and are empty without these. Leading numbers and references are removed; of a repeated key the last text counts, of
    blank ones none. NULL and empty pages have no verses.
    """

    def rows(page: str | None) -> list[tuple]:
        root = parse(page)
        keyed = [(i, b, c, n, t) for i, (b, c, n, t) in enumerate(_keyed_verses(root)) if re.sub(r"^\s*\d+\s*|\[\w+\]|\s", "", t)]
        return keyed or [(i, None, None, n, t) for i, (n, t) in enumerate(_labelled_verses(root))]

    extra = tuple(c for c in (book, chapter) if c is not None and c not in keep)
    v = _per_page(pages, html, (*keep, *extra), "__at int, __b string, __c string, verse int, __raw string", rows)
    known = lambda c, name: F.coalesce(c, F.col(name).cast("string") if name else F.lit(None), F.lit(""))
    v = v.select(*keep, "__at", known(F.col("__b"), book).alias("book"), known(F.col("__c"), chapter).try_cast("int").alias("chapter"), "verse", verse_text(F.col("__raw")).alias("text"))
    return v.where("text <> ''").groupBy(*keep, "book", "chapter", "verse").agg(F.max_by("text", "__at").alias("text"))


def slug(x: Column) -> Column:
    """A file name: anything but word characters, dashes and dots becomes an underscore."""
    return F.regexp_replace(x, r"[^\p{L}\p{N}_\-.]", "_")

"""Dictionary- and rule-driven rewriting of Tagalog into Hiligaynon, as expressions over token arrays."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.functions.text import pytrim, squeeze, strip_diacritics, tokens

WORDS = r"[\p{L}\p{N}_'-]+"
PARTS = WORDS + r"|[^\p{L}\p{N}_'-]+"

# fixed values: phrase patterns and their replacements, in the order of application
PHRASES = (
    (r"magandang\s+umaga", "maayo nga aga"),
    (r"magandang\s+hapon", "maayo nga hapon"),
    (r"magandang\s+gabi", "maayo nga gab-i"),
    (r"kumusta\s+ka", "kamusta ka"),
    (r"matutulog\s+na\s+ako", "magturog na ako"),
    (r"kumain\s+ka\s+na\s+ba", "nakaon ka na bala"),
    (r"kakain\s+ka\s+na\s+ba", "magakaon ka na bala"),
    (r"saan\s+ka\s+pupunta", "diin ka makadto"),
    (r"anong\s+pangalan\s+mo", "ano ngalan mo"),
    (r"mahal\s+kita", "palangga ko ikaw"),
    (r"salamat\s+po", "salamat gid"),
    (r"hindi\s+ko\s+alam", "indi ko kahibalo"),
    (r"hindi\s+ko\s+gusto", "indi ko gusto"),
    (r"huwag\s+mo", "indi mo"),
    (r"tara\s+na", "dali na"),
    (r"ingat\s+ka", "halong ka"),
)
# fixed values: words the letter rules leave alone
PROTECTED = (
    "bala", "balay", "kahibalo", "malaba", "dalagan", "magdalagan", "nagdalagan", "magadalagan", "palangga", "maglakat", "naglakat",
    "malakat", "magalakat", "lakat", "paligo", "magpaligo", "dali", "makaon", "nagkaon", "magakaon", "kan-on", "baklon", "hatagan",
    "malipayon", "malain", "maluya", "mahilom", "matinlo",
)
VOWELS = "aeiou"


def dictionary(rows: DataFrame, base: str, target: str, order: str) -> DataFrame:
    """``word, target``: trimmed, lower-cased words; of repeated ones the last by ``order``. Blank or NULL words are
    left out."""
    d = rows.select(F.lower(pytrim(base)).alias("word"), pytrim(target).alias("target"), F.col(order).alias("__o")).where("word <> ''")
    return d.groupBy("word").agg(F.max_by("target", "__o").alias("target"))


def dialect_map(words: DataFrame, base: str, target: str, order: str) -> DataFrame:
    """The dictionary without entries that change nothing and without words that belong to the target vocabulary; words
    are compared without accents."""
    d = words.select(strip_diacritics(pytrim(base)).alias("word"), pytrim(target).alias("target"), F.col(order).alias("__o")).where("word <> ''")
    last = d.groupBy("word").agg(F.max_by("target", "__o").alias("target"))
    vocabulary = d.select(F.explode(tokens("target")).alias("t")).select(strip_diacritics("t").alias("word")).distinct()
    return last.where(F.col("word") != strip_diacritics("target")).join(vocabulary, "word", "left_anti")


def as_map(d: DataFrame, limit: int = 5_000) -> Column:
    """A small dictionary as a map literal; refuses one of more than ``limit`` words, which is to be joined instead."""
    rows = d.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("too large for a map literal; use replace_by_join")
    if not rows:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for r in sorted(rows) for x in (r["word"], r["target"])])


def _capital(word: Column, like: Column) -> Column:
    first = F.substring(like, 1, 1)
    return F.when((F.upper(first) == first) & (F.lower(first) != first), F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 20))).otherwise(word)


def replace_words(x: Column | str, mapping: Column, accents: bool = True) -> Column:
    """Each known word replaced, an initial capital kept, everything between words unchanged."""
    x = F.col(x) if isinstance(x, str) else x

    def one(t: Column) -> Column:
        new = F.element_at(mapping, strip_diacritics(t) if accents else F.lower(t))
        return F.when(new.isNull(), t).otherwise(_capital(new, t))

    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(PARTS), 0), one), "")


def replace_by_join(df: DataFrame, id_col: str, text_col: str, dictionary_rows: DataFrame, accents: bool = True) -> DataFrame:
    """``df`` with known words of a text replaced, for dictionaries too large for a map literal: ``word, target`` rows are
    joined with the words of all texts. Ids must be unique; texts without words stay as they are."""
    parts = df.select(F.col(id_col).alias("__id"), F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(PARTS), 0)).alias("__pos", "__t"))
    found = parts.withColumn("word", strip_diacritics("__t") if accents else F.lower("__t")).join(dictionary_rows.select("word", "target"), "word", "left")
    new = F.when(F.col("target").isNull(), F.col("__t")).otherwise(_capital(F.col("target"), F.col("__t")))
    whole = found.groupBy("__id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pos", new.alias("n")))), lambda x: x["n"]), "").alias("__new"))
    return df.join(whole, F.col(id_col) == F.col("__id"), "left").withColumn(text_col, F.coalesce("__new", F.col(text_col))).select(*df.columns)


def replace_phrases(x: Column | str, phrases: tuple[tuple[str, str], ...] = PHRASES) -> Column:
    """Ordered replacement ignoring case; a match that begins with a capital gets one."""
    x = F.col(x) if isinstance(x, str) else x
    if not phrases:
        return x
    y = x
    for pattern, new in phrases:
        new = new.replace("\\", "\\\\").replace("$", "\\$")
        y = F.regexp_replace(y, r"(?=\p{Lu})(?iu:" + pattern + ")", new[:1].upper() + new[1:])
        y = F.regexp_replace(y, "(?iu:" + pattern + ")", new)
    # without a match of any pattern none can arise, so one search spares all the replacements
    return F.when(x.rlike("(?iu:" + "|".join(f"(?:{p})" for p, _ in phrases) + ")"), y).otherwise(x)


def drop_inversion(x: Column) -> Column:
    """The particle of an inverted sentence removed."""
    return F.regexp_replace(x, r"(?iU)\b((?:si|ang)\s+[\w\s]+?)\s+ay\s+", "$1 ")


def question_particle(x: Column, ignore_case: bool) -> Column:
    return F.regexp_replace(x, (r"(?iU)" if ignore_case else r"(?U)") + r"\bba\b", "bala")


def shift_letters(x: Column, known: Column) -> Column:
    """l becomes r before a vowel in words of four letters or more that are not known."""

    def one(t: Column) -> Column:
        low = F.lower(t)
        new = low
        for v in VOWELS:
            new = F.replace(new, F.lit("l" + v), F.lit("r" + v))
        word = t.rlike(r"\A[\p{L}\p{N}_'-]{4,}\z")
        out = _capital(new, t)
        # the list of known words is searched last, and only for words that would change
        return F.when(word & (out != t) & ~F.array_contains(known, low), out).otherwise(t)

    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit(PARTS), 0), one), "")


def convert(x: Column | str, words: Column, verbs: Column) -> Column:
    """The full rewriting: white space, phrases, verbs, words, sentence rules, letters. Blank text becomes empty."""
    x = F.col(x) if isinstance(x, str) else x
    y = replace_phrases(squeeze(x))
    y = replace_words(replace_words(y, verbs, accents=False), words, accents=False)
    y = question_particle(drop_inversion(y), ignore_case=False)
    known = F.concat(F.map_keys(words), F.map_values(words), F.map_keys(verbs), F.map_values(verbs), F.array(*map(F.lit, PROTECTED)))
    return F.when(pytrim(x) == "", F.lit("")).otherwise(shift_letters(y, known))


def correct(x: Column | str, mapping: Column) -> Column:
    """The editor's rewriting: phrases, dialect words, sentence rules, white space; blank text stays as it is."""
    x = F.col(x) if isinstance(x, str) else x
    y = squeeze(question_particle(drop_inversion(replace_words(replace_phrases(x), mapping)), ignore_case=True))
    return F.when(pytrim(x) == "", x).otherwise(y)


def changed_tokens(original: Column, corrected: Column) -> Column:
    """White-space separated tokens of ``corrected`` with whether the words of ``original`` miss them, compared without case,
    accents and marks; tokens of marks only always count as changed."""
    fold = lambda t: strip_diacritics(F.lower(t))
    known = F.transform(F.regexp_extract_all(F.lower(original), F.lit(r"[\p{L}\p{N}_]+"), 0), fold)
    bare = lambda t: fold(F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}_]+", ""))
    return F.transform(F.regexp_extract_all(corrected, F.lit(r"(?U)\S+"), 0), lambda t: F.struct(t.alias("token"), (~F.array_contains(known, bare(t))).alias("changed")))


def correction(x: Column | str, mapping: Column) -> Column:
    """``original, corrected, diff, orig_diff`` of a text that ``correct`` changes: the tokens of each version with whether the
    other one misses them. NULL for a text that stays as it is, and for NULL."""
    x = F.col(x) if isinstance(x, str) else x
    y = correct(x, mapping)
    return F.when(y != x, F.struct(x.alias("original"), y.alias("corrected"), changed_tokens(x, y).alias("diff"), changed_tokens(y, x).alias("orig_diff")))


def spell_issues(x: Column | str, mapping: Column, custom: Column) -> Column:
    """``word, start, end, suggestion`` of lower-case words of the dictionary that are not in ``custom``."""
    x = F.col(x) if isinstance(x, str) else x
    empty = F.array().cast("array<struct<word:string,start:int,end:int,suggestion:string>>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc: Column, t: Column) -> Column:
        key = strip_diacritics(t)
        first = F.substring(t, 1, 1)
        end = acc["at"] + F.length(t)
        upper = (F.upper(first) == first) & (F.lower(first) != first)
        hit = t.rlike(r"\A[\p{L}\p{N}_'-]{2,}\z") & ~t.rlike(r"\A\p{Nd}+\z") & ~upper & ~F.array_contains(custom, key) & F.element_at(mapping, key).isNotNull()
        item = F.struct(t.alias("word"), acc["at"].alias("start"), end.alias("end"), F.element_at(mapping, key).alias("suggestion"))
        return F.struct(end.alias("at"), F.when(hit, F.concat(acc["found"], F.array(item))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(F.regexp_extract_all(x, F.lit(PARTS), 0), zero, step, lambda acc: acc["found"])


def replace_literal(x: Column | str, word: str, new: str) -> Column:
    """A whole word replaced wherever it occurs."""
    x = F.col(x) if isinstance(x, str) else x
    return F.regexp_replace(x, r"(?U)\b" + re.escape(word) + r"\b", new.replace("\\", "\\\\").replace("$", "\\$"))


def splice(x: Column | str, start: Column, end: Column, new: Column) -> Column:
    """Characters from ``start`` to ``end`` (0-based, exclusive) replaced."""
    x = F.col(x) if isinstance(x, str) else x
    return F.overlay(x, new, start + 1, end - start)


def find_spans(x: Column | str, pattern: str, ignore_case: bool = False, literal: bool = False) -> Column:
    """``start, end`` of all matches that are not empty, in one walk over what lies between them."""
    x = F.col(x) if isinstance(x, str) else x
    p = ("(?iu)" if ignore_case else "") + (re.escape(pattern) if literal else pattern)
    hits = F.filter(F.regexp_extract_all(x, F.lit(p), 0), lambda h: h != "")
    steps = F.zip_with(hits, F.split(x, p, -1), lambda h, g: F.struct(F.length(g).alias("gap"), F.length(h).alias("size"), h.isNotNull().alias("hit")))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.coalesce(s["gap"], F.lit(0))
        end = start + F.coalesce(s["size"], F.lit(0))
        return F.struct(end.alias("at"), F.when(s["hit"], F.concat(acc["found"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda acc: acc["found"])

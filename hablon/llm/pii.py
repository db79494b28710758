"""Personal information in free text: patterned identifiers, and names by how strongly terms disclose persons.

Corpus co-occurrence with personal articles and honorifics tells how much information a term, or its ending, carries
about persons (pointwise mutual information). Terms beyond the disclosure threshold anchor the names that are removed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hablon.plans.lineage import cut
from hablon.plans.workers import prepared

DISCLOSURE = 2.5  # information (nats) beyond which a first name is taken to disclose a person
ENDING_DISCLOSURE = 0.7  # the same for endings of family names
LEAST_SEEN = 3  # seeds that a term needs at least
LEAST_TITLES = 8  # the same for the words before an honorific initial
MODEL_ROWS = 300_000  # terms up to which the whole model goes to every task; of larger ones each text gets what it holds
ENDING = 4
PUBLIC_NATS, LEAST_PUBLIC = 1.0, 100  # an identifier that carries less information, and is in so many texts, is public

# fixed values: honorifics and personal articles of the languages of the corpus
HONORIFICS = ("Mr", "Mrs", "Ms", "Dr", "Dra", "Atty", "Engr", "Kap", "Kgd", "Gng", "Bb", "Hon", "Prof", "Sra", "Rev", "Fr", "Sgt")
KINSHIP = ("Nong", "Nang", "Manong", "Manang", "Aling", "Mang", "Lolo", "Lola", "Tito", "Tita", "Kuya", "Ate", "Don", "Doña", "Señor", "Señora", "Noy", "Nay", "Tay")
ARTICLES = ("si", "kay", "ni", "nanday", "sanday", "kanday", "sina", "kina", "nina", "Si", "Kay", "Ni", "Sina")
PARTICLES = ("de los", "de las", "de la", "delos", "dela", "del", "de")
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Drive", "Lane", "Boulevard", "Blvd", "Extension", "Ext")
AREAS = ("Brgy", "Barangay", "Bgy", "Sitio", "Subdivision", "Subd", "Village", "Poblacion", "Phase", "Zone", "Purok")

_CAP = r"[A-ZÀ-ÖØ-Þ][\w’']*(?:-[A-ZÀ-ÖØ-Þ][\w’']*)*"
_GAP = r"[^\S\n]*\n?[^\S\n]*(?<=\s)"
_PART = "(?:" + "|".join(p.replace(" ", r"\s+") for p in PARTICLES) + ")"
_TITLE = r"(?:(?:" + "|".join(HONORIFICS) + r")\.|(?:" + "|".join(HONORIFICS).upper() + r")\.|(?:" + "|".join(KINSHIP + tuple(k.upper() for k in KINSHIP)) + r"))"
_NICK = r"(?:" + _GAP + r"[“\"'‘(]" + _CAP + r"[”\"'’)])"
_SUFFIX = r"(?:,?" + _GAP + r"(?:(?:Jr|Sr|JR|SR)\.?|III|II|IV)(?!\w))"

# patterns that are searched begin with a character class, and look behind it, which the matcher skips fast
TOKEN = re.compile(r"[A-ZÀ-ÖØ-Þ](?<![\w’'-].)[\w’']*(?:-[A-ZÀ-ÖØ-Þ][\w’']*)*")
SEED = re.compile("(" + _CAP + r")(?!\.)" + _NICK + r"?(?:" + _GAP + r"[A-Z]\.)?(?:" + _GAP + _PART + r")?(?:" + _GAP + r"(" + _CAP + r"))?")
INITIAL = re.compile(r"([A-ZÀ-ÖØ-Þ])\.(?:" + _GAP + r"(?i:" + _PART + r"))?" + _GAP + r"(" + _CAP + r")" + _SUFFIX + "?")
TAIL = re.compile(_NICK + r"?(?:" + _GAP + r"[A-ZÀ-ÖØ-Þ]\.)?(?:" + _GAP + r"(?i:" + _PART + r"))?" + _GAP + r"(" + _CAP + r")" + _SUFFIX + "?")
TITLED = re.compile(r"\.?" + _GAP + r"((?:(?i:" + _PART + r")" + _GAP + r")?(" + _CAP + r")" + _SUFFIX + "?)")
BEFORE = re.compile(r"(?:(?i:" + _PART + r")" + _GAP + r")?(?<![\w’'-])(" + _CAP + r")," + _GAP + r"\Z")
AFTER = re.compile(_NICK + r"?(?:" + _GAP + r"[A-ZÀ-ÖØ-Þ]\.)?" + _SUFFIX + "?")
WORDS_BEFORE = re.compile(r"(\S+)\s+(\S+)\s+\Z")
_DOTTED = {h for t in HONORIFICS for h in (t, t.upper())}
_TITLES = _DOTTED | {k for t in KINSHIP for k in (t, t.upper())}
_MARKS = tuple(lead + a + gap for a in sorted({x for w in ARTICLES for x in (w, w.upper())}) for lead in (" ", "\n", "“", '"') for gap in (" ", "\n"))

_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
_DOT = r"(?:\.|\s*[\[(]\s*(?i:dot|punto)\s*[\])]\s*|\s+(?i:dot)\s+)"
EMAIL = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]*\w)?(?:\s?@\s?|\s*[\[(]\s*(?i:at)\s*[\])]\s*)" + _LABEL + r"(?:" + _DOT + _LABEL + r")+"
    r"|(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]*\w)?\s+(?i:at)\s+" + _LABEL + r"(?:(?:\s+(?i:dot)\s+|\s*[\[(]\s*(?i:dot)\s*[\])]\s*)" + _LABEL + r")+"
)
_S = r"[\s.\-–‑]?"
# formats of numbers by region; callers may pass their own
WORLD_PHONE = re.compile(r"\+(?<![\w+.].)[1-9]\d{0,2}(?:[\s.\-–](?:\(\d{1,5}\)|\d{1,9})){1,5}(?![\w]|[.\-–]\d)")
GB_PHONE = re.compile(r"0(?<![\w+.\-–].)(?:20\s\d{4}\s\d{4}|1\d{2,3}\s\d{3}\s\d{3,4}|7\d{3}\s\d{6})(?![\w]|[.\-–]\d)")
US_ID = re.compile(r"\d(?<![\w.\-–+].)\d{2}-\d{2}-\d{4}(?![\w]|[.\-–]\d)")
PHONE = re.compile(
    r"[+(0](?<![\w+.\-–].)(?:(?<=\+)63" + _S + r"\(?9\d{2}\)?" + _S + r"\d{3}" + _S + r"\d{4}|(?<=0)063" + _S + r"\(?9\d{2}\)?" + _S + r"\d{3}" + _S + r"\d{4}"
    r"|(?<=0)9(?:\d{2}" + _S + r"\d{3}" + _S + r"\d{4}|\s\d{3}\s\d{3}\s\d{3})|(?<=\()09\d{2}\)" + _S + r"\d{3}" + _S + r"\d{4}"
    r"|(?<=\()0?[2-8]\d\)" + _S + r"\d{3}" + _S + r"\d{4}|(?<=0)[2-8]\d[\s.\-–]\d{3}[\s.\-–]?\d{4})(?![\w]|[.\-–]\d)"
)
ID_NUMBER = re.compile(
    r"\d(?<![\w.\-–+].)(?:\d{3}([\s\-–])\d{4}\1\d{4}\1\d{4}|\d{2}([\s\-–])\d{3}\2\d{3}(?:\2\d{3})?|\d-\d{7}-\d|\d-\d{9}-\d|\d{11})(?![\w]|[.\-–]\d)"
    r"|[A-Z](?<![\w.\-–+].)(?:\d{2}-\d{2}-\d{6}|\d{7}[A-Z])(?![\w]|[.\-–]\d)"
)
_PLACE = r"[A-ZÀ-ÖØ-Þ][\w’'-]*"
_any = lambda words: "(?:" + "|".join(x for w in words for x in (w, w.upper())) + r")\b\.?"
_STREET, _AREA = _any(STREETS), _any(AREAS)
_COMMA = r"[^\S\n]*,[^\S\n]*\n?[^\S\n]*"
_MORE = r"(?:" + _COMMA + r"(?:" + _AREA + r"\s+(?:\d+|" + _PLACE + r")|(?i:syudad|lungsod|siyudad|dakbanwa|ciudad|city|municipality)\s+(?i:sang|ng|sa|de|of)\s+" + _PLACE + r"|" + _PLACE + r"(?:\s+(?i:city|town))?|\d{4}(?![\d-])))"
_ROAD = r"\d+(?:-?[A-Z])?\s+(?:(?:" + _PLACE + r"\s+){1,2}" + _STREET + r"|(?i:dalan|calle|daan|kalye)\s+" + _PLACE + r")"
_HOUSE = r"(?:(?i:house|bldg|building|balay|bahay|room|rm|floor|unit|lot|blk|block|purok|zone)\b\.?\s*(?:(?i:no)\.?\s*)?#?\s*\d+(?:-?[A-Z]\b)?|\#\s*\d+)"
ADDRESS = re.compile(
    r"(?<![\w#-])(?:" + _HOUSE + r"(?:[\s,]+" + _HOUSE + r")*(?:[\s,]+(?:" + _ROAD + r"|(?:(?!(?i:brgy|barangay|sitio)\b)" + _PLACE + r"\s+){1,2}" + _STREET + r"))?|" + _ROAD + r")" + _MORE + r"+"
)
SPELLED_AT = re.compile(r"[\s\[(](?:[aA][tT])[\s\])]")


@dataclass(frozen=True)
class Formats:
    """Patterns of numbers by kind."""

    phone: tuple[re.Pattern, ...] = (PHONE, WORLD_PHONE, GB_PHONE)
    id_number: tuple[re.Pattern, ...] = (ID_NUMBER, US_ID)


@dataclass
class Model:
    """Information about persons of given names and word endings; initials that are honorifics after certain words."""

    given: dict[str, float]
    endings: dict[str, float]
    titles: set[str]
    public: set[str] = field(default_factory=set)


def observe(texts: Iterator[str | None]) -> Counter:
    """Counts of terms by role over some texts: ``t`` any capitalised word, ``g`` a first name beside a seed, ``e`` and
    ``f`` endings of any word and of family names, ``i`` initials with the two words before.

    ``p`` counts the texts that hold a patterned identifier, ``d`` all texts.
    A seed is a personal article or an honorific. Words in capitals only are left out, where case tells nothing.
    """
    words, out = Counter(), Counter()
    for text in texts:
        if not text:
            continue
        out["d", ""] += 1
        for identifier in {text[a:b] for a, b, _ in patterned(text)}:
            out["p", identifier] += 1
        title_end = -9
        for m in TOKEN.finditer(text):
            w, s = m.group(), m.start()
            if len(w) == 1:
                if text[s + 1 : s + 2] == "." and INITIAL.match(text, s):
                    b = WORDS_BEFORE.search(text, max(0, s - 60), s)
                    if b:
                        out["i", f"{b.group(1).lower()} {b.group(2).lower()}|{w}"] += 1
                continue
            if w in _TITLES:
                title_end = m.end() + (text[m.end() : m.end() + 1] == ".")
                continue
            words[w] += 1
            if (s == title_end + 1 or text[max(0, s - 9) : s].endswith(_MARKS)) and not w.isupper():
                seed = SEED.match(text, s)
                last = seed.group(2) if seed else None
                if last and not last.isupper():
                    out["g", w.lower()] += 1
                    out["f", last.lower()[-ENDING:]] += 1
                elif seed and s == title_end + 1:
                    out["f", w.lower()[-ENDING:]] += 1
    for w, n in words.items():
        low = w.lower()
        out["t", low] += n
        if not w.isupper():
            out["e", low[-ENDING:]] += n
    return out


def statistics(df: DataFrame, text_col: str) -> DataFrame:
    """``role, term, n`` over all texts, counted per batch before the shuffle; with a row per role for its total."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            total.update(observe(batch[text_col]))
            if len(total) > 500_000:
                yield pd.DataFrame([(r, t, n) for (r, t), n in total.items()], columns=["role", "term", "n"])
                total = Counter()
        yield pd.DataFrame([(r, t, n) for (r, t), n in total.items()], columns=["role", "term", "n"])

    return prepared(df).select(text_col).mapInPandas(run, "role string, term string, n long").groupBy("role", "term").agg(F.sum("n").alias("n"))


def learned(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``role, term, value``: the model of a corpus as a table, with the roles ``g``, ``f`` and ``i`` of ``observe``. What a
    term needs is the same for a corpus of any size."""
    counts = cut(statistics(df, text_col))
    totals = {r.role: r.n for r in counts.groupBy("role").agg(F.sum("n").alias("n")).collect()}

    def informed(role: str, base: str, threshold: float) -> DataFrame:
        seeds = counts.where((F.col("role") == role) & (F.col("n") >= LEAST_SEEN)).select("role", "term", "n")
        every = counts.where(F.col("role") == base).select("term", F.col("n").alias("all"))
        value = F.log(F.col("n") / totals.get(role, 1) / (F.greatest("all", "n") / totals.get(base, 1)))
        return seeds.join(every, "term").select("role", "term", value.alias("value")).where(F.col("value") >= threshold)

    i = counts.where(F.col("role") == "i").select(F.substring_index("term", "|", 1).alias("before"), F.substring_index("term", "|", -1).alias("letter"), "n")
    whole = i.groupBy("before").agg(F.sum("n").alias("every"), F.max(F.struct("n", "letter")).alias("top")).where((F.col("every") >= LEAST_TITLES) & (F.col("top.n") > 0.8 * F.col("every")))
    titles = whole.select(F.lit("i").alias("role"), F.concat_ws(" ", "before", "top.letter").alias("term"), F.lit(1.0).alias("value"))
    # what an identifier tells about a person is how few texts hold it; at most e^PUBLIC_NATS per identifier of a text are public
    told = F.log(F.lit(float(totals.get("d", 1))) / F.col("n"))
    public = counts.where((F.col("role") == "p") & (F.col("n") >= LEAST_PUBLIC)).select("role", "term", told.alias("value")).where(F.col("value") < PUBLIC_NATS)
    return informed("g", "t", DISCLOSURE).unionByName(informed("f", "e", ENDING_DISCLOSURE)).unionByName(titles).unionByName(public)


def disclosure(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``term, n, nats``: how strongly each patterned identifier of a corpus discloses whom a text is about: the
    self-information of meeting it in a text."""
    counts = statistics(df, text_col)
    texts = counts.where("role = 'd'").agg(F.coalesce(F.sum("n"), F.lit(1)).alias("texts"))
    return counts.where("role = 'p'").join(F.broadcast(texts)).select("term", "n", F.log(F.col("texts") / F.col("n")).alias("nats"))


def _model(rows: Iterable) -> Model:
    model = Model({}, {}, set())
    for r in rows:
        if r["role"] == "i":
            model.titles.add(r["term"])
        elif r["role"] == "p":
            model.public.add(r["term"])
        else:
            (model.given if r["role"] == "g" else model.endings)[r["term"]] = r["value"]
    return model


def learn(df: DataFrame, text_col: str = "text") -> Model:
    """The whole model of a corpus, on the driver."""
    return _model(learned(df, text_col).collect())


def _asked(text: str) -> set[tuple[str, str]]:
    """The roles and terms of a model that ``names`` may look up in a text."""
    out = {("p", text[a:b]) for a, b, _ in patterned(text)}
    for m in TOKEN.finditer(text):
        word, start = m.group(), m.start()
        out |= {("g", word.lower()), ("f", word.lower()[-ENDING:])}
        b = WORDS_BEFORE.search(text, max(0, start - 60), start) if len(word) == 1 else None
        if b:
            out.add(("i", f"{b.group(1).lower()} {b.group(2).lower()} {word}"))
    return out


def _ending(model: Model, word: str) -> float:
    return model.endings.get(word.lower()[-ENDING:], -1.0)


def _honorific(model: Model, text: str, start: int, letter: str) -> bool:
    """Whether one letter stands where the corpus never has another: there it is no initial but an honorific."""
    b = WORDS_BEFORE.search(text, max(0, start - 60), start)
    return bool(b) and f"{b.group(1).lower()} {b.group(2).lower()} {letter}" in model.titles


def names(text: str, model: Model) -> list[tuple[int, int]]:
    """Spans of names: a disclosing first name with its family name, initials or a title with a family name."""
    out: list[tuple[int, int]] = []
    given, done = model.given, 0
    for m in TOKEN.finditer(text):
        word, start = m.group(), m.start()
        if start < done:
            continue
        if len(word) == 1:
            t = INITIAL.match(text, start)
            if t and _ending(model, t.group(2)) > 0:
                out.append((t.start(2) if _honorific(model, text, start, word) else start, t.end()))
                done = t.end()
            continue
        if word in _TITLES:
            t = TITLED.match(text, m.end())
            if t and (word not in _DOTTED or text[m.end()] == ".") and t.group(2).lower() not in given and _ending(model, t.group(2)) > 0:
                out.append(t.span(1))
                done = t.end()
            continue
        if word.lower() not in given:
            continue
        end = None
        t = TAIL.match(text, m.end())
        if t and t.group(1).lower() in given and _ending(model, t.group(1)) <= 0:  # a second first name
            second = TAIL.match(text, t.end(1))
            t = second if second and _ending(model, second.group(1)) > 0 else t
        if t and _ending(model, t.group(1)) > 0:
            end = t.end()
        else:
            b = BEFORE.search(text, max(0, start - 60), start)
            if b and _ending(model, b.group(1)) > 0:
                start, end = b.start(), AFTER.match(text, m.end()).end()
        if end is not None:
            out.append((start, end))
            done = end
    return out


def _regions(anchors: Iterable[tuple[int, int]], text: str) -> Iterator[tuple[int, int]]:
    """Surroundings of anchors that begin and end at blanks; overlapping ones are one."""
    low = high = -1
    for a, b in anchors:
        a = max(text.rfind(" ", 0, max(0, a - 90)), text.rfind("\n", 0, max(0, a - 90)), 0)
        b = next((i for i in (text.find(" ", b + 160),) if i >= 0), len(text))
        if a > high:
            if high >= 0:
                yield low, high
            low = a
        high = max(high, b)
    if high >= 0:
        yield low, high


def _around(pattern: re.Pattern, anchors: Iterable[tuple[int, int]], text: str, kind: str) -> Iterator[tuple[int, int, str]]:
    """Matches of ``pattern`` in the surroundings of its anchors. A match that comes near the end of its surroundings is looked
    for again in ever larger ones, so that none is cut."""
    done = 0
    for low, high in _regions(anchors, text):
        low = max(low, done)
        while low < high:
            found = list(pattern.finditer(text, low, high))
            if found and found[-1].end() > high - 80 and high < len(text):
                high = min(len(text), high + 2 * (high - low))
                continue
            yield from ((*m.span(), kind) for m in found)
            break
        done = max(done, high)


def _number_anchors(text: str) -> Iterator[tuple[int, int]]:
    """Places of numbers that may begin an address: after a mark or a word of a house, or before a name or a road."""
    for m in NUMBER.finditer(text):
        yield m.span()


NUMBER = re.compile(r"\d(?<![\w.,:/+-].)\d{0,5}(?:-?[A-Z])?(?=\s+[A-ZÀ-ÖØ-Þdck]|\s*,)")


def _take(taken: list[tuple[int, int, str]], span: tuple[int, int, str]) -> None:
    """Puts a span among sorted ones unless it overlaps one of them."""
    at = bisect_left(taken, span)
    if (at == 0 or taken[at - 1][1] <= span[0]) and (at == len(taken) or taken[at][0] >= span[1]):
        taken.insert(at, span)


LEAST_DIGITS = 7  # of a number


def patterned(text: str, formats: Formats = Formats()) -> list[tuple[int, int, str]]:
    """Mail addresses, phone numbers, identity numbers and street addresses. A bare house, block or lot number without a
    place is no address."""
    out = []
    for kind, patterns in (("phone", formats.phone), ("id_number", formats.id_number)):
        taken: list[tuple[int, int, str]] = []
        for p in patterns:  # of overlapping matches that of the first format counts
            for m in p.finditer(text):
                if sum(c.isdigit() for c in m.group()) >= LEAST_DIGITS:
                    _take(taken, (*m.span(), kind))
        out += taken
    low = text.lower()
    at = [(i, i + 1) for i in _places(text, "@")]
    if "dot" in low or "punto" in low:
        at = sorted([*at, *(m.span() for m in SPELLED_AT.finditer(text))])
    elif "[" in low or "(" in low:
        at = sorted([*at, *(m.span() for m in SPELLED_AT.finditer(text) if text[m.start()] in "[(")])
    out += _around(EMAIL, at, text, "email")
    if "," in text:
        out += _around(ADDRESS, _number_anchors(text), text, "address")
    return out


def _places(text: str, mark: str) -> Iterator[int]:
    i = text.find(mark)
    while i >= 0:
        yield i
        i = text.find(mark, i + 1)


PRIORITY = {"email": 0, "address": 1, "phone": 2, "id_number": 3, "name": 4}


def find(text: str | None, model: Model, formats: Formats = Formats()) -> list[tuple[int, int, str]]:
    """Non-overlapping spans in order, without identifiers that the corpus shows to be public; of overlapping ones the kind first in ``PRIORITY``, then the longer one stays."""
    if not text:
        return []
    spans = [s for s in patterned(text, formats) if text[s[0] : s[1]] not in model.public] + [(a, b, "name") for a, b in names(text, model)]
    spans.sort(key=lambda s: (PRIORITY[s[2]], s[0] - s[1], s[0]))
    taken: list[tuple[int, int, str]] = []
    for s in spans:
        _take(taken, s)
    return taken


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    """The text with each span replaced by ``[KIND]``."""
    if not spans:
        return text
    out, at = [], 0
    for start, end, kind in spans:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def _with_spans(df: DataFrame, id_col: str, text_col: str, result: Callable, schema: str) -> DataFrame:
    """``result`` of the ids, texts and spans of each batch. A model of more than ``MODEL_ROWS`` terms is joined to the terms
    of each text, so that no task holds the whole of it."""
    terms = cut(learned(df, text_col))
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("rid"), F.col(text_col).alias("body"))
    if terms.count() <= MODEL_ROWS:
        model = df.sparkSession.sparkContext.broadcast(_model(terms.collect()))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield result(batch["rid"], batch["body"], [find(text, model.value) for text in batch["body"]])

        return rows.mapInPandas(run, schema)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(k, *t) for k, text in zip(batch["key"], batch["body"]) if text for t in _asked(text)], columns=["key", "role", "term"])

    def run_told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [find(text, _model(told if told is not None else ())) for text, told in zip(batch["body"], batch["told"])]
            yield result(batch["rid"], batch["body"], spans)

    keyed = rows.withColumn("key", F.md5("body"))
    asked = keyed.select("key", "body").mapInPandas(ask, "key string, role string, term string").distinct()
    told = asked.join(terms, ["role", "term"]).groupBy("key").agg(F.collect_list(F.struct("role", "term", "value")).alias("told"))
    return keyed.join(told, "key", "left").select("rid", "body", "told").mapInPandas(run_told, schema)


def personal_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start_char, end_char, kind``; offsets are code points, ends exclusive. NULL and empty texts have
    none, rows without an id are left out."""

    def result(ids: pd.Series, texts: pd.Series, spans: list) -> pd.DataFrame:
        return pd.DataFrame([(i, *s) for i, found in zip(ids, spans) for s in found], columns=["doc_id", "start_char", "end_char", "kind"])

    return _with_spans(df, id_col, text_col, result, "doc_id long, start_char long, end_char long, kind string")


def sanitise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_replaced``: each text with placeholders of their types, otherwise unchanged. Rows without an id are
    left out."""

    def result(ids: pd.Series, texts: pd.Series, spans: list) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": ids, "text": [redact(t, s) for t, s in zip(texts, spans)], "n_replaced": [len(s) for s in spans]})

    return _with_spans(df, id_col, text_col, result, "doc_id long, text string, n_replaced long")

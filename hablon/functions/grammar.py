"""Token-pattern grammar rules: tokens with offsets, parts of speech, contiguous matching."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hablon.functions.text import pytrim, sentences

# fixed value: what a token is
TOKEN = "[A-Za-záéíóúÁÉÍÓÚñÑ][A-Za-záéíóúÁÉÍÓÚñÑ'-]*|[.,!?;:\"]"
PARTS = f"(?s){TOKEN}|."
# fixed values: particles
PARTICLES = ("ang", "sang", "mga", "sa", "ni", "kay", "kag", "nga", "kon", "kundi", "pero", "apang", "ukon", "tungod", "agud", "bisan", "pag", "kun")


@dataclass(frozen=True)
class Spec:
    """What one token must be; all given conditions hold, or not with ``negate``."""

    text: tuple[str, ...] = ()
    regex: str = ""
    pos: str = ""
    negate: bool = False

    def test(self, token: Column) -> Column:
        hit = F.lit(True)
        if self.text:
            hit = hit & token["lower"].isin(*self.text)
        if self.regex:
            hit = hit & token["text"].rlike("(?i)" + self.regex)
        if self.pos:
            hit = hit & (token["pos"] == self.pos)
        return ~hit if self.negate else hit


@dataclass(frozen=True)
class Rule:
    id: str
    severity: str
    pattern: tuple[Spec, ...]
    suggestions: tuple[str, ...]
    message: str
    name: str = ""
    description: str = ""
    example_wrong: str = ""
    example_right: str = ""


# fixed values: rule ids, severities, patterns and suggestions
RULES = (
    Rule("DOUBLE_ANG", "error", (Spec(("ang",)), Spec(pos="PARTICLE", negate=True), Spec(("ang",))), ("Replace the second 'ang' with 'sang' if it marks an object, or 'ni' for a personal name.",), "A clause marks one topic with ang.", "Two topics", "Two phrases of one clause are marked as its topic.", "Nagbasa ang bata ang libro.", "Nagbasa ang bata sang libro."),
    Rule("AT_INSTEAD_OF_KAG", "warning", (Spec(("at",)),), ("kag",), "The conjunction is kag.", "Tagalog conjunction", "The word for 'and' is that of Tagalog.", "Asin at kalamay.", "Asin kag kalamay."),
    Rule("ACTOR_FOCUS_DOUBLE_ANG", "error", (Spec(regex="^(mag|nag)[a-z]+"), Spec(("ang",)), Spec(pos="NOUN"), Spec(("ang",))), ("Change the second 'ang' to 'sang'.",), "After an actor-focus verb the object takes sang.", "Object marked as topic", "The verb has its actor in focus, and the object is marked like it.", "Nagluto ang tindera ang isda.", "Nagluto ang tindera sang isda."),
    Rule("OBJ_FOCUS_SANG_TOPIC", "error", (Spec(regex="[a-z]+on$"), Spec(("sang",))), ("Change 'sang' to 'ang' for the focused object.",), "After an object-focus verb the object takes ang.", "Topic marked as object", "The verb has its object in focus, which is not marked as topic.", "Lutuon sang isda.", "Lutuon ang isda."),
    Rule("SA_FOR_PERSON", "warning", (Spec(("sa",)), Spec(regex="^[A-Z][a-z]+")), ("kay",), "Persons take kay.", "Place marker before a person", "A name of a person follows the marker of places.", "Ihatag ini sa Pedro.", "Ihatag ini kay Pedro."),
    Rule("MISSING_NGA_LINKER", "warning", (Spec(regex="^ma[a-z]+"), Spec(pos="NOUN")), ("Insert 'nga' between the adjective and the noun.",), "A linker may be missing.", "No linker", "A describing word stands directly before its noun.", "Madulom gab-i.", "Madulom nga gab-i."),
    Rule("TAGALOG_NG", "error", (Spec(("ng",)),), ("sang", "nga"), "ng is Tagalog.", "Tagalog ng", "The marker ng is that of Tagalog.", "Tubig ng suba.", "Tubig sang suba."),
    Rule("TAGALOG_NANG", "error", (Spec(("nang",)),), ("sang", "nga"), "nang is Tagalog.", "Tagalog nang", "The marker nang is that of Tagalog.", "Nagdalagan nang madasig.", "Nagdalagan sing madasig."),
    Rule("KAMI_KAG_KITA_CONFUSION", "info", (Spec(("kami",)), Spec(("kag",)), Spec(("ikaw", "ka"))), ("kita",), "With the listener it is kita.", "We with and without the listener", "The listener is named beside the form that leaves them out.", "Kami kag ikaw.", "Kita."),
    Rule("TENSE_MISMATCH_NAG_FUTURE", "error", (Spec(regex="^nag[a-z]+"), Spec(("ugaling", "sunod", "buwas"))), ("Change 'nag-' prefix to 'mag-'.",), "A past verb before a future time word.", "Past verb, future time", "A finished action is placed in the future.", "Nagkadto buwas.", "Magkadto buwas."),
    Rule("DOUBLE_NGA", "error", (Spec(("nga",)), Spec(("nga",))), ("Remove one 'nga'.",), "The linker is repeated.", "Two linkers", "The linker stands twice.", "Dako nga nga balay.", "Dako nga balay."),
    Rule("TAGALOG_HINDI", "error", (Spec(("hindi",)),), ("indi", "wala"), "The negation is indi or wala.", "Tagalog negation", "The negation is that of Tagalog.", "Hindi ako.", "Indi ako."),
)


# fixed value: the affixes of verbs
VERB_PREFIX = "^(mag|nag|gin|gina|ma|na)[a-z]"


def part_of_speech(word: Column) -> Column:
    """A tag by affixes; punctuation counts as a noun. The adjective tag of ma- words is never reached."""
    return (
        F.when(word.isin(*PARTICLES), "PARTICLE")
        .when(word.rlike(VERB_PREFIX), "VERB")
        .when(word.endswith("on") & (F.length(word) > 3), "VERB")
        .when(word.endswith("an") & (F.length(word) > 3), "VERB_LOC")
        .otherwise("NOUN")
    )


def tokenize(text: Column, base: Column | None = None) -> Column:
    """Array of ``text, lower, start, end, pos``; offsets count from ``base``. NULL gives NULL."""
    none = F.array().cast("array<struct<text:string,lower:string,start:int,end:int,pos:string>>")
    zero = F.struct((base if base is not None else F.lit(0)).cast("int").alias("at"), none.alias("found"))

    def step(acc: Column, p: Column) -> Column:
        end = acc["at"] + F.length(p)
        item = F.struct(p.alias("text"), F.lower(p).alias("lower"), acc["at"].alias("start"), end.alias("end"), part_of_speech(F.lower(p)).alias("pos"))
        return F.struct(end.alias("at"), F.when(p.rlike("\\A(?:" + TOKEN + ")\\z"), F.concat(acc["found"], F.array(item))).otherwise(acc["found"]).alias("found"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(PARTS), 0), zero, step, lambda acc: acc["found"])


def split_sentences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, sentence_no, sentence, base``: sentences of the stripped text with their true offsets."""
    stripped = pytrim(F.coalesce(F.col(text_col), F.lit("")))
    parts = df.select(F.col(id_col).alias("id"), stripped.alias("body")).where("body <> ''")
    parts = parts.select("id", "body", F.posexplode(sentences("body")).alias("sentence_no", "sentence"))
    done = F.coalesce(F.sum(F.length("sentence")).over(Window.partitionBy("id").orderBy("sentence_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # white space between sentences: what the text has before a sentence beyond the sentences themselves
    gaps = F.regexp_extract_all("body", F.lit(r"(?<=[.!?])(?U:\s+)"), 0)
    skipped = F.aggregate(F.slice(gaps, 1, F.col("sentence_no")), F.lit(0), lambda a, g: a + F.length(g))
    return parts.select("id", "sentence_no", "sentence", (done + skipped).cast("int").alias("base"))


def _matches(r: Rule, number: int) -> Column:
    """The matches of one rule in the column ``toks``."""
    k = len(r.pattern)

    def hit(i: Column) -> Column:
        ok = F.lit(True)
        for j, spec in enumerate(r.pattern):
            ok = ok & spec.test(F.get("toks", i + j))
        return ok

    def item(i: Column) -> Column:
        return F.struct(
            F.get("toks", i)["start"].alias("char_start"), F.lit(number).alias("rule_no"), F.get("toks", i + k - 1)["end"].alias("char_end"), F.lit(r.id).alias("rule"), F.lit(r.severity).alias("severity"),
            F.lit(r.message).alias("message"), F.array(*map(F.lit, r.suggestions)).cast("array<string>").alias("suggestions"),
        )

    starts = F.when(F.size("toks") >= k, F.filter(F.sequence(F.lit(0), F.size("toks") - k), hit)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, item)


def check(df: DataFrame, id_col: str, text_col: str, rules: tuple[Rule, ...] = RULES, only: tuple[str, ...] = ()) -> DataFrame:
    """One row per match: ``id, match_no, rule, severity, message, suggestions, sentence_no, char_start, char_end, matched``.

    Patterns match contiguous tokens within a sentence. Offsets are those in the stripped text. ``match_no`` counts the
    matches of a text from 1 in the order of their places, at one place in the order of the rules. Blank texts have no
    matches; ``only`` restricts the rules, and without any there are no matches.
    """
    toks = split_sentences(df, id_col, text_col).select("id", "sentence_no", "sentence", "base", tokenize(F.col("sentence"), F.col("base")).alias("toks"))
    found = [_matches(r, n) for n, r in enumerate(rules) if r.pattern and (not only or r.id in only)]
    none = F.array().cast("array<struct<char_start:int,rule_no:int,char_end:int,rule:string,severity:string,message:string,suggestions:array<string>>>")
    out = toks.select("id", "sentence_no", "sentence", "base", F.inline(F.concat(none, *found)))
    number = F.row_number().over(Window.partitionBy("id").orderBy("char_start", "rule_no"))
    return out.select("id", number.alias("match_no"), "rule", "severity", "message", "suggestions", "sentence_no", "char_start", "char_end", F.expr("substring(sentence, char_start - base + 1, char_end - char_start)").alias("matched"))


def stats(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, total, distinct_words, particles, verbs`` per text; punctuation counts as a token."""
    words = F.transform(F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN), 0), F.lower)
    t = df.select(F.col(id_col).alias("id"), words.alias("w")).withColumn("pos", F.transform("w", part_of_speech))
    count = lambda p: F.size(F.filter("pos", p))
    return t.select("id", F.size("w").alias("total"), F.size(F.array_distinct("w")).alias("distinct_words"), count(lambda x: x == "PARTICLE").alias("particles"), count(lambda x: F.startswith(x, F.lit("VERB"))).alias("verbs"))


RULE_FIELDS = "id string, name string, description string, severity string, pattern array<struct<text:array<string>,regex:string,pos:string,negate:boolean>>, message string, suggestions array<string>, example_wrong string, example_right string"
MOST_RULES = 1000


def rule_table(spark, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rules as data, one row each."""
    rows = [(r.id, r.name, r.description, r.severity, [(list(s.text), s.regex, s.pos, s.negate) for s in r.pattern], r.message, list(r.suggestions), r.example_wrong, r.example_right) for r in rules]
    return spark.createDataFrame(rows, RULE_FIELDS)


def rules_from(table: DataFrame) -> tuple[Rule, ...]:
    """Rules of a table with the columns of ``rule_table``, in the order of their ids; those but ``id`` and ``pattern`` may be
    missing or NULL. Rows without an id or pattern are left out. Every rule becomes part of the plan, so a table of more than
    ``MOST_RULES`` rules is refused."""
    rows = table.where("id is not null and size(pattern) > 0").orderBy("id").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    spec = lambda s: Spec(tuple(t.lower() for t in s["text"] or ()), s["regex"] or "", s["pos"] or "", bool(s["negate"]))
    text = lambda r, c: r[c] or "" if c in table.columns else ""
    return tuple(
        Rule(r["id"], text(r, "severity") or "warning", tuple(map(spec, r["pattern"])), tuple(r["suggestions"] or ()) if "suggestions" in table.columns else (), text(r, "message"), *(text(r, c) for c in ("name", "description", "example_wrong", "example_right")))
        for r in rows
    )


def rule_by_id(table: DataFrame, rule_id: str) -> DataFrame:
    """The rule of that id; no row for an unknown one."""
    return table.where(F.col("id") == rule_id)

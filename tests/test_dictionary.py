import pytest
from pyspark.sql import functions as F

from hablon.operators import dictionary, pipelines


def test_words_and_entries(spark):
    words = spark.createDataFrame([("ako",), ("ikaw",)], "word string")
    more = dictionary.add_words(words, [" Ñandú", "ako", " "])
    assert [r.word for r in more.collect()] == ["ako", "ikaw", "nandu"]
    assert [r.word for r in dictionary.remove_words(more, ["IKAW"]).collect()] == ["ako", "nandu"]
    e = spark.createDataFrame([("bahay", "balay")], "word string, target string")
    e = dictionary.add_entry(dictionary.add_entry(e, "Isda", "sda"), "bahay ", "ulot")
    assert [tuple(r) for r in e.collect()] == [("bahay", "ulot"), ("isda", "sda")]
    assert dictionary.search_entries(e, "ULO").count() == 1 and dictionary.remove_entry(e, "ISDA").count() == 1
    rules = spark.createDataFrame([(2, "b", "y"), (1, " a ", "x"), (3, "", "z")], "line_no int, pattern string, replacement string")
    assert dictionary.phrase_rules(rules) == (("a", "x"), ("b", "y"))


def test_settings_and_collections(spark):
    s = spark.createDataFrame([("k", "1", None)], "key string, value string, updated_at timestamp")
    s = dictionary.set_setting(dictionary.set_setting(s, "k", "2"), "j", "3")
    assert sorted((r.key, r.value) for r in s.collect()) == [("j", "3"), ("k", "2")]
    d = dictionary.create_collection(dictionary.empty_collections(spark), "n", ["a", "b"])
    assert [(r.name, r.headers, r.row_count) for r in d.collect()] == [("n", ["a", "b"], 0)]
    fixed = d.withColumn("id", F.lit("x"))
    assert [(r.name, r.headers) for r in dictionary.update_collection(fixed, "x", "m", ["c"]).collect()] == [("m", ["c"])]


def test_spans_books_and_reports(spark):
    span = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame([([(0, 3), (8, 9)], [(2, 5), (5, 7)])], f"a {span}, b {span}")
    assert [tuple(x) for x in df.select(dictionary.merged_spans(F.col("a"), F.col("b")).alias("x")).collect()[0].x] == [(0, 3), (5, 7), (8, 9)]
    books = spark.createDataFrame([("GEN",), ("EXO",)], "book string")
    assert dictionary.known_books(books, ["GEN"], ["GEN", "EXO"]).count() == 1
    with pytest.raises(ValueError):
        dictionary.known_books(books, ["XXX"], ["GEN"])
    files = spark.createDataFrame([("d", "b"), ("d", "a")], "dir string, name string")
    assert dictionary.files_by_folder(files).collect()[0].names == ["a", "b"]
    assert dictionary.longest(files, F.length("name"), 1).count() == 1
    report = spark.createDataFrame([("empty", 2.0, 20.0, "bad")], "metric string, value double, pct double, flag string")
    assert dictionary.print_report(report).startswith("✗ empty")


def test_pipelines(spark):
    pairs = spark.createDataFrame([(i, f"s{i}", "" if i == 3 else f"t{i}") for i in range(10)], "line_no long, src string, tgt string")
    assert pipelines.converted_pairs(pairs, shuffle_seed=1, most=4).count() == 4 and pipelines.converted_pairs(pairs).count() == 9
    assert pipelines.converted_pairs(pairs, keep_empty=True).count() == 10
    lines = spark.createDataFrame([(i, f" a  {i} ") for i in range(6)], "line_no long, text string")
    out = pipelines.prepared(lines, lines.limit(2), "balanced", 3)
    assert out.count() == 4 and sorted(r.position for r in out.collect()) == [1, 2, 3, 4]
    page = lambda t: spark.createDataFrame([(f'<span data-usfm="GEN.1.1">1 {t}</span>',)], "h string")
    v = pipelines.verse_corpus(page("In"), page("Sa"), "h")
    assert [tuple(r) for r in v.collect()] == [("GEN", 1, 1, "In", "Sa")]
    assert pipelines.verse_corpus(page("New"), page("Bag-o"), "h", v).collect() == v.collect()

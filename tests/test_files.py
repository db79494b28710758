import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hablon.sources import readers, writers
from hablon.streaming import incremental


def put(path: Path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def content(folder) -> str:
    return "".join(p.read_bytes().decode() for p in sorted(Path(folder).glob("part-*")))


def test_text_lines(spark, tmp_path):
    path = put(tmp_path / "a.txt", "﻿una\n\n tatlo \nfour\n")
    assert [(r.line_no, r.text) for r in readers.text_lines(spark, path).orderBy("line_no").collect()] == [(1, "una"), (2, ""), (3, " tatlo "), (4, "four")]
    assert [r.line_no for r in readers.filled_lines(spark, path).orderBy("line_no").collect()] == [1, 3, 4]


def test_many_blocks_are_numbered_in_order(spark, tmp_path):
    path = put(tmp_path / "big.txt", "".join(f"line {i}\n" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        rows = readers.text_lines(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert all(r.text == f"line {r.line_no - 1}" for r in rows) and len(rows) == 5000


def test_pairs_with_sniffing_and_columns(spark, tmp_path):
    p = put(tmp_path / "p.csv", 'id;target;source\n1;"a;b"; c \n2;d;e\n')
    assert [tuple(r) for r in readers.pairs(spark, p).orderBy("line_no").collect()] == [(1, "c", "a;b"), (2, "e", "d")]
    assert readers.pairs(spark, p, src="2", tgt="target").where("line_no = 1").collect()[0].src == "c"
    assert readers.resolve_columns(["x", "Output", "EN"]) == ("EN", "Output")
    short = put(tmp_path / "s.tsv", 'src\ttgt\nonly\na\t\n\t"b"\tc\n')
    assert [tuple(r)[1:] for r in readers.pairs(spark, short, sep="\t").orderBy("line_no").collect()] == [("", ""), ("a", ""), ("", "b")]
    n = put(tmp_path / "n.tsv", "1\t2\n3\t4\n")
    assert readers.pairs(spark, n).count() == 2


def test_table_pads_cuts_and_round_trips(spark, tmp_path):
    p = put(tmp_path / "t.tsv", 'a\tb\n1\n2\t"x\ty"\tz\n3\t"q ""r"""\n')
    t = readers.table(spark, p)
    assert [(r.a, r.b) for r in t.orderBy("line_no").collect()] == [("1", ""), ("2", "x\ty"), ("3", 'q "r"')]
    writers.delimited(t, str(tmp_path / "out"), line_end="\r\n")
    assert content(tmp_path / "out") == 'a\tb\r\n1\t\r\n2\t"x\ty"\r\n3\t"q ""r"""\r\n'
    assert readers.load(spark, p).columns == ["line_no", "a", "b"]


def test_xml(spark, tmp_path):
    p = put(tmp_path / "m.tmx", '<tmx><body><tu><tuv xml:lang="EN-us"><seg> one </seg></tuv><tuv xml:lang="hil"><seg>isa</seg></tuv></tu><tu><tuv lang="enm"><seg>no</seg></tuv><tuv lang="hil"><seg>x</seg></tuv></tu></body></tmx>')
    assert [tuple(r) for r in readers.tmx(spark, p, "en", "hil").collect()] == [("one", "isa"), ("no", "x")]
    m = put(tmp_path / "s.xml", "<d><s id='1'><chunk><w>Ang</w></chunk><w>R&amp;D</w><w/></s><s id='2'></s><s/><s><w>3</w></s></d>")
    assert [tuple(r) for r in readers.moses_xml(spark, m).orderBy("line_no").collect()] == [(1, "Ang R&D"), (2, "3")]


def test_json_records(spark):
    rows = ['{"src": " Hiligaynon ", "trgs": ["Hiligaynon"]}', '{"src": "I", "trgs": "Ako"}', "{bad", "", '{"src": "x", "trgs": null}', "3", '{"src": "y", "trgs": ["a", "", "b"]}']
    df = spark.createDataFrame(list(enumerate(rows)), "line_no long, text string")
    good, bad = readers.json_records(df)
    assert [(r.src, r.tgt) for r in good.orderBy("line_no", "pos").collect()] == [("Hiligaynon", "Hiligaynon"), ("I", "Ako"), ("y", "a"), ("y", "b")]
    assert sorted(r.line_no for r in bad.collect()) == [2, 4, 5]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "line_no long, text string")
    writers.lines(df, str(tmp_path / "l"))
    assert content(tmp_path / "l") == "a\nb\n\n"
    assert json.loads(writers.json_array(df, "line_no"))[0] == {"line_no": 1, "text": "a"}
    writers.json_lines(df, str(tmp_path / "j"))
    writers.json_lines(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 6
    writers.source_only(df.withColumnRenamed("text", "src").where("src is not null"), str(tmp_path / "s"))
    assert content(tmp_path / "s") == "a\t\nb\t\n"
    writers.labelled(df.select(F.col("line_no").alias("index"), "text").where("text is not null"), "u", "now", str(tmp_path / "r"))
    assert content(tmp_path / "r").splitlines() == ["Source: u", "Scraped: now", "Total paragraphs: 2", "", "[1] a", "[2] b"]
    assert writers.clipboard(df, ["line_no", "text"], "line_no") == "1\ta\n2\tb\n3\t"
    with pytest.raises(ValueError):
        writers.clipboard(df, ["text"], "line_no", most=2)
    assert writers.rewrite(df, str(tmp_path / "t"), "v1") == writers.current(spark, str(tmp_path / "t"))
    assert writers.rewrite(df, str(tmp_path / "t"), "v2") == writers.current(spark, str(tmp_path / "t"))
    s = spark.createDataFrame([(1, "train", "h1", "e1"), (2, "dev", "h2", "e2")], "position long, split string, hil string, en string")
    writers.aligned_splits(s, str(tmp_path / "splits"))
    assert content(tmp_path / "splits/dev.en") == "e2\n"


def test_discovery_and_settings(spark, tmp_path):
    (tmp_path / "d/e").mkdir(parents=True)
    for p in ("d/b.tsv", "d/e/a.tsv", "d/c.txt"):
        put(tmp_path / p, "x\n")
    assert [r.name for r in readers.discover(spark, str(tmp_path / "d")).collect()] == ["b.tsv", "a.tsv"]
    words = spark.createDataFrame([("Ako ",), ("",)], "word string")
    stored = spark.createDataFrame([("custom_dict", '["Ikaw"]')], "key string, value string")
    assert [r.word for r in readers.custom_words(stored, words).collect()] == ["Ikaw"]
    assert [r.word for r in readers.custom_words(stored.limit(0), words).collect()] == ["ako"]


def articles(folder, name, rows):
    folder.mkdir(exist_ok=True)
    put(folder / name, "\n".join(json.dumps(dict(zip(("url", "category", "text", "ts"), r))) for r in rows))


LONG = "Nagkadto ang mga tawo sa merkado sang aga kag nagbakal sang isda."


def test_streams_go_on_from_their_checkpoint(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    articles(src, "1.json", [("u1", "c", LONG + " " + LONG, "2025-01-01T00:00:00"), ("u1", "c", LONG, "2025-01-01T00:00:00")])

    def run():
        incremental.append(incremental.first_article_sentences(incremental.article_stream(spark, str(src))), out, state).awaitTermination(120)
        return spark.read.parquet(out).count()

    assert run() == 3
    articles(src, "2.json", [("u2", "c", LONG, "2025-01-02T00:00:00"), ("u2", "c", LONG.replace("isda", "bugas"), "2025-01-02T00:00:00")])
    assert run() == 4


@pytest.mark.parametrize("buckets", [1, 4])
def test_owners_of_sentences_share_states(spark, tmp_path, buckets):
    """A call of Python per sentence took hours over large inputs; what is kept and forgotten is told per sentence."""
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    other = [LONG.replace("isda", f"isda {i}") for i in range(50)]
    got = []

    def run(name, *rows):
        articles(src, name, rows)
        stream = incremental.append(incremental.first_article_sentences(incremental.article_stream(spark, str(src)), buckets=buckets), out, state)
        stream.awaitTermination()
        new = [(r.url, r.sentence) for r in spark.read.parquet(out).collect()]
        for row in got:
            new.remove(row)
        got.extend(new)
        return sorted(new), stream.lastProgress["stateOperators"][0]["numRowsTotal"]

    first, states = run("1.json", ("u2", "c", LONG, "2025-01-02T00:00:00"), ("u1", "c", " ".join([LONG, *other]), "2025-01-01T00:00:00"), ("u1", "c", LONG, "2025-01-03T00:00:00"))
    assert first == sorted([("u1", LONG)] * 2 + [("u1", s) for s in other]) and states <= buckets
    assert run("2.json", ("u2", "c", LONG, "2025-01-01T00:00:00"), ("u1", "c", LONG, "2025-01-04T00:00:00"), ("u3", "c", other[0], "2025-01-04T00:00:00"))[0] == [("u1", LONG)]
    assert run("3.json", ("u4", "c", "gamay", "2025-01-20T00:00:00"), ("u5", "c", other[0], "2025-02-20T00:00:00"))[0] == []
    # by now the sentences of the first trigger that came again are remembered, the others are forgotten
    assert run("4.json", ("u6", "c", LONG.replace("isda", "bugas"), "2025-03-05T00:00:00"))[0] == [("u6", LONG.replace("isda", "bugas"))]
    assert run("5.json", ("u7", "c", other[0], "2025-03-06T00:00:00"), ("u7", "c", other[1], "2025-03-06T00:00:00"))[0] == [("u7", other[1])]


def test_stream_deduplication(spark, tmp_path):
    src = tmp_path / "in"
    articles(src, "1.json", [("u1", "c", LONG, "2025-01-01T00:00:00"), ("u1", "c", "x", "2025-01-01T00:01:00"), ("u2", "c", LONG, "2025-01-01T00:02:00")])
    stream = incremental.article_stream(spark, str(src))
    incremental.append(incremental.new_articles(stream), str(tmp_path / "a"), str(tmp_path / "sa")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 2
    incremental.append(incremental.new_sentences(stream), str(tmp_path / "b"), str(tmp_path / "sb")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1

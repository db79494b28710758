from hablon.operators import rowcheck

SCHEMA = "raw_id long, file_name string, record_no int, raw string, src string"
GOOD = '7,train,Hello there,"Ako, si ""Toto""",0.5,2024-02-29'


def run(spark, *raws, header="pair_no,split,src,tgt,score,added_on", name="a.csv"):
    rows = [(0, name, 1, header, "clash")] + [(i + 1, name, i + 2, r, "clash") for i, r in enumerate(raws)]
    good, bad = rowcheck.split_rows(spark.createDataFrame(rows, SCHEMA))
    return {r.raw_id: r for r in good.collect()}, {r.raw_id: r.reason for r in bad.collect()}


def test_reasons(spark):
    good, bad = run(
        spark, GOOD, '8,train,a "b" c,d,0,2024-01-01', "9,train,a,b,0", "010,train,a,b,0,2024-01-01", '11,train,"a\nb",b,,2024-01-01', "12,train,a\nb,b,,2024-01-01",
        "13,train, ,b,,2024-01-01", "14,train,a,b,1.01,2024-01-01", "15,train,a,b,1.0,2023-02-29", None, "", '16,train,"",b,,2024-01-01', '17,train,"a,b,,2024-01-01', "18,valid,a,b,,2024-01-01", "19,train,a\u0007,b,,2024-01-01",
    )
    assert set(good) == {1, 5} and good[1].tgt == 'Ako, si "Toto"' and good[1].pair_no == 7 and good[1].score == 0.5 and str(good[1].added_on) == "2024-02-29"
    assert good[5].src == "a\nb" and good[5].score is None
    assert bad == {2: "broken_quote", 3: "column_count", 4: "bad_value", 6: "broken_quote", 7: "bad_value", 8: "bad_value", 9: "bad_value", 10: "column_count", 11: "column_count", 12: "bad_value", 13: "broken_quote", 14: "bad_value", 15: "bad_value"}


def test_header_order_and_separator(spark):
    good, bad = run(spark, "0.1|a|b|5|2024-01-01|dev", header="score|src|tgt|pair_no|added_on|split", name="x.PSV")
    assert good[1].src == "a" and good[1].split == "dev" and not bad


def test_no_header_unknown_suffix_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a.csv", 2, GOOD, ""), (2, "a.txt", 2, GOOD, ""), (3, None, 2, None, "")], SCHEMA)
    good, bad = rowcheck.split_rows(df)
    assert good.count() == 0 and bad.count() == 3
    assert rowcheck.split_rows(df.limit(0))[1].count() == 0


def test_very_long_field(spark):
    long = 'x""' * 50_000
    good, bad = run(spark, f'7,train,"{long}",b,,2024-01-01')
    assert not bad and len(good[1].src) == 100_000

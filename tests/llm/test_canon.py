from hablon.llm import canon

SCHEMA = "row_id long, src string, tgt string, n_copies string"
ROWS = [
    (5, "Hello,  World", "Ako", "z"), (2, "hello world", "AKO!", "z"), (9, "ako", "HELLO-world", "z"), (1, "hello worlds", "ako", "z"),
    (7, None, "", "z"), (3, "...", None, "z"), (4, "ab", "c", "z"), (6, "a", "bc", "z"), (8, "ab", "c", "z"),
]


def test_copies(spark):
    got = sorted(tuple(r) for r in canon.copies(spark.createDataFrame(ROWS, SCHEMA)).collect())
    assert got == [(2, 5), (2, 9), (3, 7), (4, 8)]


def test_collapse_keeps_one_row_and_counts(spark):
    got = {r.row_id: r.n_copies for r in canon.collapse(spark.createDataFrame(ROWS, SCHEMA)).collect()}
    assert got == {2: 3, 1: 1, 3: 2, 4: 2, 6: 1}


def test_rows_repeated_with_their_ids(spark):
    df = spark.createDataFrame([ROWS[0], ROWS[0], (None, "Hello world", "ako", "z")], SCHEMA)
    assert [(r.row_id, r.n_copies) for r in canon.collapse(df).collect()] == [(5, 3)]
    assert canon.copies(df).count() == 0


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert canon.copies(empty).count() == 0 and canon.collapse(empty).count() == 0


def test_hot_group_and_long_text(spark):
    long = "Balay sa bukid. " * 30_000
    rows = [(i, long if i % 2 else long.upper(), None, "z") for i in range(200)] + [(999, "lain", "", "z")]
    got = canon.copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 199 and {r.row_id_a for r in got} == {0}

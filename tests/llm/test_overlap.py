import random
import re

import pytest
from pyspark.sql import functions as F

from hablon.llm import overlap

SCHEMA = "row_id long, split string, source string, src string, tgt string, extra int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(diag + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def canon(x):
    return re.sub(r"[\W_]", "", (x or "").lower())


def brute(rows):
    near = lambda p, q: distance(p, q) * 5 <= max(len(p), len(q))
    out = set()
    for a in rows:
        for b in rows:
            if a[1] == "train" and b[1] in ("dev", "test"):
                p, q, r, s = canon(a[3]), canon(a[4]), canon(b[3]), canon(b[4])
                if (near(p, r) and near(q, s)) or (near(p, s) and near(q, r)):
                    out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abdegiklmnoprstuwy") for _ in range(rng.randint(3, 9)))
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            _, _, _, s, t, _ = rng.choice(rows)
            if rng.random() < 0.6 and s:
                parts = s.split()
                parts[rng.randrange(len(parts))] = word()
                s = " ".join(parts)
            if rng.random() < 0.3:
                s, t = t, s
            if rng.random() < 0.3 and s:
                s = s.upper() + " !"
        else:
            s, t = (" ".join(word() for _ in range(18)) for _ in range(2))
            if rng.random() < 0.1:
                t = rng.choice(["", None])
        rows.append((i, rng.choice(["train", "train", "dev", "test"]), f"c{i % 3}", s, t, 1))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)
    assert got


def test_nulls_empties_ties_and_long_texts(spark):
    long = "ab cd ef gh " * 20_000
    rows = [
        (1, "train", "x", None, "", 0), (2, "dev", "x", "", None, 0), (3, "train", "y", long, "a", 0), (4, "test", "y", long.upper(), "a", 0),
        (5, None, "y", long, "a", 0), (6, "dev", "y", "yes", "no", 0), (7, "train", "y", "No!", "YES", 0), (8, "train", "y", "maybe so", "no", 0), (None, "dev", "y", "maybe so", "no", 0),
    ]
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 2), (3, 4), (6, 7)}


def test_empty_table(spark):
    assert overlap.overlaps(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hot_seed_with_many_different_records(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HOT", 3)
    rng = random.Random(5)
    shared = "sang mga tawo sa banwa nga ginhatag ang mga regalo kag tanan nga butang "
    rows = []
    for i in range(30):
        own = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(120))
        rows += [(2 * i, "train", "s", shared + own, own, 0), (2 * i + 1, "dev", "s", shared + own, own[:-1] + "Q", 0)]
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(2 * i, 2 * i + 1) for i in range(30)}


def test_pair_whose_only_common_seed_is_hot_and_last(spark, monkeypatch):
    monkeypatch.setattr(overlap, "HOT", 3)
    rng = random.Random(6)
    shared = "sangmgatawosabanwangaginhatagangmgaregalokagta"[:45]
    letters = lambda n: [rng.choice("bcdfhjklmnpqrstvwxyz") for _ in range(n)]
    edited = lambda x, step: "".join("e" if (len(x) - 1 - k) % step == 0 else c for k, c in enumerate(x))
    rows = []
    for i in range(12):
        a, b = letters(50), letters(130)
        rows += [(2 * i, "train", "s", "".join(a) + shared, "".join(b), 0), (2 * i + 1, "dev", "s", edited(a, 6) + shared, edited(b, 15), 0)]
    got = {tuple(r) for r in overlap.overlaps(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows) == {(2 * i, 2 * i + 1) for i in range(12)}


def test_evenly_spread_edits_and_the_exact_mode(spark):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("bcdfhjklmnpqrstvwxyz") for _ in range(n))
    rows = []
    for i in range(12):
        a, b = letters(120), letters(130)
        step = (20, 10, 7, 5)[i % 4]
        edited = lambda x: "".join("e" if k % step == step - 1 else c for k, c in enumerate(x))
        rows += [(2 * i, "train", "s", a, b, 0), (2 * i + 1, "dev", "s", edited(a), edited(b), 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(2 * i, 2 * i + 1) for i in range(12)}
    assert {tuple(r) for r in overlap.overlaps(df, scales=None).collect()} == want
    fine = {tuple(r) for r in overlap.overlaps(df, scales=((8, 2),)).collect()}
    assert {p for p in want if p[0] // 2 % 4 < 2} <= fine <= want  # up to one edit in ten letters


def test_copies_of_one_record_are_joined_in_parts(spark, monkeypatch):
    monkeypatch.setattr(overlap, "COPIES", 4)
    text = "nagkadto sila sa merkado sang aga kag nagbakal sang isda para sa panihapon sang bug os nga pamilya"
    rows = [(i, "dev" if i % 3 == 0 else "train", "s", text if i < 30 else text + "g", text[::-1], 0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in overlap.overlaps(df).collect()} == brute(rows)
    classes = sorted(tuple(r) for r in overlap.overlap_classes(df).collect())
    assert classes == [(0, 20, 10, 6, 4, 260), (30, 6, 4, 20, 10, 104)]


def test_collinear_chain_leaves_out_a_stray_seed():
    seed = lambda e, t, field=0: (field << 44) | (e << 24) | (t << 4)
    seeds = [seed(0, 90), seed(5, 5), seed(20, 20), seed(70, 72), seed(3, 3, 1), seed(9, overlap.WIDE)]
    assert overlap.collinear(seeds) == [(0, 5, 5, 51), (0, 70, 72, 36), (1, 3, 3, 36)]


def test_report_counts_pairs_and_coverage(spark):
    text = "nagkadto sila sa merkado sang aga kag nagbakal sang isda para sa panihapon sang bug os nga pamilya"
    rows = [(1, "train", "a", text, text[::-1], 0), (2, "train", "b", text, text[::-1], 0), (3, "dev", "b", text.upper(), text[::-1], 0), (4, "dev", "c", "lain", "iban", 0)]
    got = {(r.split, r.source): (r.records, r.overlapping, r.pairs, r.mean_coverage) for r in overlap.overlap_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("dev", "b"): (1, 1, 2, 1.0), ("dev", "c"): (1, 0, 0, 0.0)}


def test_winnowing_keeps_a_fingerprint_of_every_long_common_run():
    rng = random.Random(3)
    for _ in range(50):
        common = "".join(rng.choice("abcd") for _ in range(51))
        a = "".join(rng.choice("efgh") for _ in range(rng.randint(0, 60))) + common + "x" * rng.randint(0, 9)
        b = common + "".join(rng.choice("ijkl") for _ in range(rng.randint(0, 60)))
        w, _, h = overlap.winnow([a, b], 32, 20)
        assert set(h[w == 0]) & set(h[w == 1])


def test_distances_are_evaluated_once(spark):
    """A filter over a projected distance would have it evaluated in both."""
    df = spark.createDataFrame([(1, 2, "abcd" * 9, "b" * 20, "abcd" * 9, "b" * 20, 1, 1)], "t long, e long, ea string, eb string, p string, q string, n_train long, n_eval long")
    found = overlap._verified(df.withColumn("runs", F.expr(f"cast(array() as {overlap._RUNS})")).repartition(2))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 2  # one for each field
    assert [tuple(r) for r in found.collect()] == [(1, 2, 56, 1, 1)]

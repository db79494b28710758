import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from hablon.llm import mixing, packing
from hablon.llm.tokens import encode

DOCS = "doc_id long, text string, source string, n_tokens int"
KINDS = "container_kind string, capacity_tokens int"


def docs(spark, n=120, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(["balay", "suba", "kag", "isda", "merkado"]) for _ in range(rng.randint(0, 150))), rng.choice("aab"), 7) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, "a", 7), (n + 1, "", "b", 7), (None, "balay", "a", 7), (n + 2, "suba", None, None)], DOCS)


@pytest.mark.parametrize("seed", range(4))
def test_sum_of_squares_fits_and_is_tight(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 100, 400)
    number = packing.sum_of_squares(sizes, 100)
    levels = np.bincount(number, weights=sizes)
    assert levels.max() <= 100 and len(levels) <= 1.12 * sizes.sum() / 100


def test_every_token_is_packed_once(spark):
    d = docs(spark)
    out = packing.pack(d, spark.createDataFrame([("s", 64), ("l", 512), ("no", None), ("zero", 0)], KINDS)).collect()
    assert {r.container_kind for r in out} == {"s", "l"}
    sizes = {r.doc_id: len(encode(r.text)) for r in d.collect() if r.doc_id is not None}
    for kind, capacity in (("s", 64), ("l", 512)):
        fill, parts = Counter(), defaultdict(list)
        for r in out:
            if r.container_kind == kind:
                fill[r.container_id] += r.n_tokens
                parts[r.doc_id].append((r.start_token, r.n_tokens))
        assert max(fill.values()) <= capacity
        assert set(parts) == set(sizes)
        for doc, pieces in parts.items():
            pieces.sort()
            assert [p[0] for p in pieces] == list(range(0, max(1, sizes[doc]), capacity)) and sum(p[1] for p in pieces) == sizes[doc]
            assert sizes[doc] > capacity or len(pieces) == 1


def test_second_round_keeps_all_items(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ITEMS", 20)
    d = docs(spark)
    out = packing.pack(d, spark.createDataFrame([("s", 300)], KINDS)).collect()
    assert Counter(r.doc_id for r in out if r.piece_no == 0) == Counter(r.doc_id for r in d.collect() if r.doc_id is not None)
    fill = Counter()
    for r in out:
        fill[r.container_id] += r.n_tokens
    assert max(fill.values()) <= 300


def test_packing_empty_tables(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), spark.createDataFrame([("s", 64)], KINDS)).count() == 0
    assert packing.pack(docs(spark), spark.createDataFrame([], KINDS)).count() == 0


def test_long_texts_are_encoded_alike_in_pieces():
    text = ("Ang balay sa bukid, kag ang suba.  Isda! " * 6000) + "x" * 70_000
    assert len(text) > 3 * 65536
    from hablon.llm.tokens import encoder

    assert encode(text) == encoder().encode_ordinary(text)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_permutation(n):
    x = np.arange(n)
    p = mixing.permute(x, n, 1, 2, 3)
    assert sorted(p) == list(range(n))
    assert (mixing.permute(p, n, 1, 2, 3, inverse=True) == x).all()


def test_quotas_respect_repeats():
    q = mixing.quotas_of([10, 100, 0], [0.5, 0.3, 0.2], [2, 1, 3])
    assert q[0] <= 20 and q[1] <= 100 and q[2] == 0 and abs(q[0] / sum(q) - 0.625) < 0.05
    counts = mixing.shard_counts([17, 5, 100], 20, 3)
    assert counts.sum(0).tolist() == [17, 5, 100] and (counts.sum(1)[:-1] == 20).all()


def test_mixture_blocks_and_shares(spark):
    d = docs(spark, 300)
    targets = spark.createDataFrame([("a", 0.25, 1), ("b", 0.75, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(d, targets, block=32)
    rows = mixed.collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted({(r.shard, r.slot) for r in rows})
    streams = defaultdict(list)
    texts = {r.doc_id: (r.source, r.text) for r in d.collect() if r.doc_id is not None}
    uses = Counter((r.source, r.block_no) for r in rows)
    assert max(v for (s, _), v in uses.items() if s == "a") == 1 and max(uses.values()) <= 3
    first = {}
    for r in rows:
        assert first.setdefault((r.source, r.block_no), r.tokens) == r.tokens
        assert all(texts[i][0] == r.source for i in r.docs) and r.n_tokens == len(r.tokens) <= 32
    whole = sum(len(encode(t)) for s, t in texts.values() if s == "b")
    assert sum(len(t) for (s, _), t in first.items() if s == "b") == whole  # the limiting source is used up
    report = {r.source: r for r in mixing.share_report(mixed, targets).collect()}
    assert abs(report["b"].actual_share - 0.75) < 0.02 and report["none"].tokens == 0 and report["b"].most_repeats == 3
    assert not streams


def test_mixing_empty(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert mixing.mix(spark.createDataFrame([], DOCS), targets).count() == 0

"""Records shared between splits: winnowing fingerprints, collinear chains of seeds, extension by alignment."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.llm.canon import canonical_pair, pair_keys
from hablon.plans.lineage import cut, release
from hablon.plans.workers import prepared
from hablon.plans.semi import bitmap, maybe_in, maybe_not_in

SCALES = ((36, 10), (24, 12), (8, 4))  # (gram length, window)
SHORT, TINY = 110, 64  # letters of a field up to which it also gets the second and the third scale
SHORT_PAIR = 200  # letters of both fields up to which they also get the second scale
HOT = 256  # evaluation seeds of one hash per part of a join; hashes with more are joined in several parts
COPIES = 1024  # rows of one class per part of a join; classes with more are joined in several parts
EDITS = 5  # at most one edit per so many characters
SEED_BITS, CLASS_BITS = 26, 22  # sizes of the bitmaps (at most 2^20 and 2^16 broadcast rows) that thin out joins
WIDE = (1 << 20) - 1  # positions and lengths are packed up to here; this one stands for any larger or several places

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MUL
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


def _slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, in a logarithmic number of passes."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def winnow(texts: list[str], gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position, hash) of the rolling-hash minima of each window, in order.

    Every common run of ``gram + window - 1`` characters of two texts holds a common fingerprint. A text of fewer grams
    than ``window`` gives its least gram; one shorter than ``gram`` gives the hash of the whole text; an empty one none.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < gram))
    who, at, what = [short], [np.zeros(len(short), np.int64)], [np.zeros(len(short), np.uint64)]
    for n, i in enumerate(short):
        h = np.uint64(0)
        for c in codes[starts[i] : ends[i]]:
            h = h * _BASE + c + np.uint64(1)
        what[0][n] = h
    what[0] = _mix(what[0])
    if len(codes) >= gram:
        with np.errstate(over="ignore"):
            # hashes of grams by doubling: a gram of m + n characters is made of one of m and one of n
            rolled, have, power = codes + np.uint64(1), 1, _BASE
            parts: list[tuple[np.ndarray, int, np.uint64]] = [(rolled, 1, power)]
            while have * 2 <= gram:
                rolled = rolled[:-have] * power + rolled[have:]
                have, power = have * 2, power * power
                parts.append((rolled, have, power))
            full, size, _ = parts[-1]
            for piece, width, power in reversed(parts[:-1]):
                while size + width <= gram:
                    keep = len(codes) - (size + width) + 1
                    full = full[:keep] * power + piece[size : size + keep]
                    size += width
            hashes = _mix(full)
        n = len(codes)
        owner = np.repeat(np.arange(len(texts)), lengths)
        first = np.arange(n - gram + 1)
        inside = owner[first] == owner[first + gram - 1]
        ranked = np.where(inside, hashes & ~np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        chosen = np.zeros(len(first), bool)
        grams = np.maximum(lengths - gram + 1, 0)
        if len(first) >= window:
            least = _slide_min(ranked, window)
            whole = owner[: len(least)] == owner[np.minimum(np.arange(len(least)) + gram + window - 2, n - 1)]
            whole &= np.arange(len(least)) + gram + window - 2 < n
            # a gram is chosen if it is the minimum of some whole window that covers it
            best = np.where(whole, least, np.uint64(0))
            padded = np.concatenate([np.zeros(window - 1, np.uint64), best, np.zeros(window - 1, np.uint64)])
            for k in range(window):
                chosen |= padded[k : k + len(first)] == ranked
            chosen &= inside
        few = np.flatnonzero((grams > 0) & (grams < window))
        if len(few):
            lows = [ranked[starts[i] : starts[i] + grams[i]].argmin() + starts[i] for i in few]
            chosen[np.asarray(lows, np.int64)] = True
        places = np.flatnonzero(chosen)
        who.append(owner[places])
        at.append(places - starts[owner[places]])
        what.append(ranked[places])
    w, p, h = np.concatenate(who), np.concatenate(at), np.concatenate(what)
    order = np.lexsort((p, w))
    return w[order], p[order], h[order]


def _once(who: np.ndarray, at: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each hash once per text; one that a text holds in several places loses its place."""
    order = np.lexsort((what, who))
    w, p, h = who[order], np.minimum(at[order], WIDE), what[order]
    first = np.ones(len(w), bool)
    first[1:] = (w[1:] != w[:-1]) | (h[1:] != h[:-1])
    starts = np.flatnonzero(first)
    several = np.diff(np.append(starts, len(w))) > 1
    return w[starts], np.where(several, WIDE, p[starts]), h[starts]


def _fingerprints(scales: tuple[tuple[int, int], ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("cid").to_numpy(zero_copy_only=False)
            wide = [np.minimum(np.fromiter((len(t or "") for t in batch.column(c).to_pylist()), np.int64, batch.num_rows), WIDE) for c in ("a", "b")]
            lengths = (wide[0] << 20) | wide[1]
            brief = (wide[0] + wide[1] <= SHORT_PAIR) | (np.minimum(*wide) == 0)  # records with one field get the second scale too
            for field, name in enumerate(("a", "b")):
                texts = batch.column(name).to_pylist()
                finest = np.where(wide[field] <= TINY, 2, np.where(brief | (wide[field] <= SHORT), 1, 0))
                for scale, (gram, window) in enumerate(scales):
                    which = [i for i, t in enumerate(texts) if t and finest[i] >= scale]
                    if not which:
                        continue
                    w, p, h = _once(*winnow([texts[i] for i in which], gram, window))
                    rows = np.asarray(which)[w]
                    with np.errstate(over="ignore"):
                        h = _mix(h + np.uint64(scale + 1) * _MUL)
                    yield pa.record_batch(
                        {
                            "h": pa.array(h.view(np.int64)),
                            "cid": pa.array(ids[rows], pa.int64()),
                            "fp": pa.array((scale << 61) | (field << 60) | (p << 40) | lengths[rows]),
                        }
                    )

    return run


def fingerprints(classes: DataFrame, scales: tuple[tuple[int, int], ...] = SCALES) -> DataFrame:
    """``h, cid, fp``: the seeds of each class, each once per field; ``fp`` packs the scale, the field, the position (``WIDE``
    if the field has the seed in several places) and the lengths of both fields. The first scale holds for every
    field, the second and third for short ones."""
    return prepared(classes).select("cid", "a", "b").mapInArrow(_fingerprints(scales), "h long, cid long, fp long")


def text_classes(df: DataFrame, evaluation: Column, id_col: str, first: str, second: str) -> DataFrame:
    """One row per distinct canonical record: smallest id, texts, keys, counts of training and evaluation rows."""
    lo, hi = canonical_pair(first, second)
    rows = df.select(F.col(id_col).alias("rid"), evaluation.alias("ev"), lo.alias("a"), hi.alias("b"))
    k, x = pair_keys(F.col("a"), F.col("b"))
    return (
        rows.withColumns({"k": k, "x": x})
        .groupBy("k", "x")
        .agg(
            F.min("rid").alias("cid"),
            F.min("a").alias("a"),
            F.min("b").alias("b"),
            F.count_if(~F.col("ev")).alias("n_train"),
            F.count_if(F.col("ev")).alias("n_eval"),
        )
    )


def _seed_pairs(classes: DataFrame, scales: tuple[tuple[int, int], ...]) -> DataFrame:
    """``t, e, swapped, seeds``: pairs of classes that share a seed on a possible diagonal.

    The evaluation seeds of a hot hash are spread over parts, and its training seeds go to every part, so that no pair is
    left out and no task meets all of them.
    """
    train, held = classes.where("n_train > 0"), classes.where("n_eval > 0")
    right = fingerprints(held, scales)
    left = maybe_in(fingerprints(train, scales), "h", bitmap(right, "h", SEED_BITS), SEED_BITS)
    right = right.select("h", F.col("cid").alias("e"), F.col("fp").alias("efp"))
    hot = cut(right.groupBy("h").count().where(F.col("count") > HOT).select("h", F.ceil(F.col("count") / HOT).alias("parts")))
    on = ["h"]
    if not hot.isEmpty():
        on = ["h", "part"]
        parts = F.coalesce("parts", F.lit(1).cast("long"))
        left = left.join(hot, "h", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("parts")
        right = right.join(hot, "h", "left").withColumn("part", F.pmod(F.xxhash64("e", "efp"), parts)).drop("parts")
    joined = left.join(right, on).where("cid <> e")
    return (
        joined.where(_possible()).select(F.col("cid").alias("t"), "e", (_field("fp") != _field("efp")).alias("swapped"), _seed().alias("seed"))
        .groupBy("t", "e", "swapped")
        .agg(F.collect_set("seed").alias("seeds"))
    )


def _bits(packed: str, shift: int, mask: int = WIDE) -> Column:
    return F.shiftright(packed, shift).bitwiseAND(F.lit(mask))


def _field(packed: str) -> Column:
    return _bits(packed, 60, 1)


def _seed() -> Column:
    """Field, both positions and scale of a seed in one number that sorts by field and position in the evaluation record."""
    return F.shiftleft(_field("efp"), 44) + F.shiftleft(_bits("efp", 40), 24) + F.shiftleft(_bits("fp", 40), 4) + _bits("fp", 61, 3)


def _possible() -> Column:
    """What must hold for the texts of a seed if their fields are to be within the allowed edits: lengths that differ by
    no more than these edits, and a seed no further from its diagonal."""
    straight = _field("fp") == _field("efp")
    p, q = F.when(straight, _bits("fp", 20)).otherwise(_bits("fp", 0)), F.when(straight, _bits("fp", 0)).otherwise(_bits("fp", 20))
    ep, eq = _bits("efp", 20), _bits("efp", 0)
    close = lambda x, y: F.abs(x - y) * EDITS <= F.greatest(x, y)
    room = F.when(_field("efp") == 0, F.greatest(p, ep)).otherwise(F.greatest(q, eq))
    diagonal = (F.greatest(_bits("fp", 40), _bits("efp", 40)) >= WIDE) | (F.abs(_bits("fp", 40) - _bits("efp", 40)) * EDITS <= room)
    return (F.greatest(p, q, ep, eq) >= WIDE) | (close(p, ep) & close(q, eq) & diagonal)


def collinear(seeds: list[int], scales: tuple[tuple[int, int], ...] = SCALES) -> list[tuple[int, int, int, int]]:
    """(field, evaluation position, training position, length) of the runs of the longest collinear chain of packed seeds.

    Seeds of a field form a chain if their positions rise in both records; overlapping ones on a diagonal are one run, and a
    seed that cuts into a run from another diagonal is left out. Seeds without a single place are not chained.
    """
    out: list[tuple[int, int, int, int]] = []
    for field in (0, 1):
        items = []
        for s in seeds:
            e, t = (s >> 24) & WIDE, (s >> 4) & WIDE
            if s >> 44 == field and e < WIDE and t < WIDE:
                items.append((e, -t, scales[s & 3][0]))
        items.sort()
        tails: list[int] = []  # training positions at the ends of the best chains of each length
        ends: list[int] = []  # their seeds
        before = [-1] * len(items)
        for i, (_, t, _) in enumerate(items):
            n = bisect_left(tails, -t)
            before[i] = ends[n - 1] if n else -1
            tails[n : n + 1], ends[n : n + 1] = [-t], [i]
        chain, i = [], ends[-1] if ends else -1
        while i >= 0:
            chain.append(items[i])
            i = before[i]
        runs: list[list[int]] = []
        for e, t, n in reversed(chain):
            t = -t
            if runs and e - runs[-1][0] == t - runs[-1][1] and e <= runs[-1][0] + runs[-1][2]:
                runs[-1][2] = max(runs[-1][2], e + n - runs[-1][0])
            elif not runs or (e >= runs[-1][0] + runs[-1][2] and t >= runs[-1][1] + runs[-1][2]):
                runs.append([e, t, n])
        out += [(field, *r) for r in runs]
    return out


_RUNS = "array<struct<f:int,e:int,t:int,n:int>>"


def _chained(pairs: DataFrame, scales: tuple[tuple[int, int], ...]) -> DataFrame:
    """``t, e, swapped, runs``: seed pairs with the runs of their chain."""
    kind = pa.list_(pa.struct([("f", pa.int32()), ("e", pa.int32()), ("t", pa.int32()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [[dict(zip("fetn", r)) for r in collinear(s, scales)] for s in batch.column("seeds").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("t", "e", "swapped")), pa.array(runs, kind)], ["t", "e", "swapped", "runs"])

    return prepared(pairs).mapInArrow(run, f"t long, e long, swapped boolean, runs {_RUNS}")


def _extended(field: int, own: str, other: str) -> Column:
    """Edits between the runs of a chain in one field, aligned gap by gap within what is still allowed; NULL if there
    is no run or the gaps take more. Beyond the chain's runs nothing is compared, so the sum is never less than the distance of the fields."""
    e, t, allowed = F.col(own), F.col(other), F.floor(F.greatest(F.length(own), F.length(other)) / EDITS).cast("int")

    def gap(acc: Column, e_end: Column, t_end: Column) -> Column:
        left = F.substring(e, acc["e"] + 1, e_end - acc["e"])
        right = F.substring(t, acc["t"] + 1, t_end - acc["t"])
        d = F.call_function("levenshtein", left, right, F.greatest(F.lit(0), allowed - acc["edits"]))
        return F.when(acc["edits"].isNull() | (d < 0), F.lit(None).cast("int")).otherwise(acc["edits"] + d)

    def step(acc: Column, r: Column) -> Column:
        return F.struct((r["e"] + r["n"]).alias("e"), (r["t"] + r["n"]).alias("t"), gap(acc, r["e"], r["t"]).alias("edits"))

    zero = F.struct(F.lit(0).alias("e"), F.lit(0).alias("t"), F.lit(0).alias("edits"))
    runs = F.filter("runs", lambda r: r["f"] == field)
    return F.when(F.size(runs) > 0, F.aggregate(runs, zero, step, lambda acc: gap(acc, F.length(own), F.length(other))))


def _verified(pairs: DataFrame) -> DataFrame:
    """``t, e, covered, n_train, n_eval`` of the pairs within the allowed edits, ``covered`` being the characters of the evaluation record that
    the alignment keeps. ``pairs`` has the fields ``ea, eb``, their counterparts ``p, q``, and ``runs``. A pair is first
    extended from its chain; where the chain's gaps take too many edits, the whole fields are aligned in a band."""
    near = lambda p, q: f"abs(length({p}) - length({q})) * {EDITS} <= greatest(length({p}), length({q}))"
    whole = lambda p, q: F.expr(f"levenshtein({p}, {q}, cast(greatest(length({p}), length({q})) div {EDITS} as int))")
    found = pairs.where(near("p", "ea")).where(near("q", "eb"))
    # generated, because a filter over a projection would evaluate it again
    found = found.select("*", F.explode(F.array(F.coalesce(_extended(0, "ea", "p"), whole("p", "ea")))).alias("d0")).where("d0 >= 0")
    found = found.select("*", F.explode(F.array(F.coalesce(_extended(1, "eb", "q"), whole("q", "eb")))).alias("d1")).where("d1 >= 0")
    kept = F.greatest(F.lit(0), F.length("ea") - F.col("d0")) + F.greatest(F.lit(0), F.length("eb") - F.col("d1"))
    return found.groupBy("t", "e").agg(F.max(kept).alias("covered"), F.first("n_train").alias("n_train"), F.first("n_eval").alias("n_eval"))


def _sides(pairs: DataFrame, t: DataFrame, e: DataFrame) -> DataFrame:
    """Pairs with the fields of both classes, the training ones as counterparts of the evaluation ones."""
    swapped = F.col("swapped")
    return pairs.join(t, "t").join(e, "e").withColumns({"p": F.when(swapped, F.col("tb")).otherwise(F.col("ta")), "q": F.when(swapped, F.col("ta")).otherwise(F.col("tb"))})


def _texts(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    t = classes.where("n_train > 0").select(F.col("cid").alias("t"), F.col("a").alias("ta"), F.col("b").alias("tb"), "n_train")
    return t, classes.where("n_eval > 0").select(F.col("cid").alias("e"), F.col("a").alias("ea"), F.col("b").alias("eb"), "n_eval")


def _own(classes: DataFrame) -> DataFrame:
    return classes.where("n_train > 0 and n_eval > 0").select(F.col("cid").alias("t"), F.col("cid").alias("e"), (F.length("a") + F.length("b")).alias("covered"), "n_train", "n_eval")


def matches(classes: DataFrame, scales: tuple[tuple[int, int], ...] = SCALES) -> DataFrame:
    """``t, e, covered, n_train, n_eval``: pairs of classes whose fields turn into one another within the allowed edits, and for each
    the characters of the evaluation record that their alignment keeps. A class with both kinds of rows matches itself.
    """
    seen = cut(_chained(_seed_pairs(classes, scales), scales))
    release(classes.sparkSession)
    t, e = _texts(classes)
    t = maybe_in(t, "t", bitmap(seen, "t", CLASS_BITS), CLASS_BITS)
    e = maybe_in(e, "e", bitmap(seen, "e", CLASS_BITS), CLASS_BITS)
    return _verified(_sides(seen, t, e)).unionByName(_own(classes))


def exact_matches(classes: DataFrame) -> DataFrame:
    """The result of ``matches`` without seeds, for tables of which the product of evaluation and training records of like
    length is affordable: the evaluation records are a query set that meets, in blocks, every training record whose
    lengths allow a match. No pair within the allowed edits is missed."""
    t, e = _texts(classes)
    step = math.log(EDITS / (EDITS - 1))
    # two fields of n and at most n * 5 / 4 characters fall into the same or into neighbouring steps, and so do their sums
    level = lambda a, b: F.floor(F.log(F.length(a) + F.length(b) + F.lit(1)) / step).cast("int")
    t = t.withColumns({"level": level("ta", "tb"), "block": F.pmod(F.xxhash64("t"), F.lit(64))})
    e = e.withColumn("level", F.explode(F.array(*[level("eb", "ea") + d for d in (-1, 0, 1)]))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    both = e.join(t, ["level", "block"]).where("t <> e").withColumn("swapped", F.explode(F.array(F.lit(False), F.lit(True))))
    both = both.withColumns({"p": F.when(F.col("swapped"), F.col("tb")).otherwise(F.col("ta")), "q": F.when(F.col("swapped"), F.col("ta")).otherwise(F.col("tb")), "runs": F.array().cast(_RUNS)})
    return _verified(both).unionByName(_own(classes))


def _prepared(df: DataFrame, split_col: str, train: str, id_col: str, first: str, second: str, scales: tuple[tuple[int, int], ...] | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    marked = df.where(F.col(split_col).isNotNull() & F.col(id_col).isNotNull())
    lo, hi = canonical_pair(first, second)
    k, x = pair_keys(F.col("__a"), F.col("__b"))
    members = marked.select(F.col(id_col).alias("rid"), F.col(split_col).alias("split"), "source", lo.alias("__a"), hi.alias("__b")).select("rid", "split", "source", k.alias("k"), x.alias("x"))
    members = cut(members)
    classes = cut(text_classes(marked, F.col(split_col) != train, id_col, first, second))
    release(df.sparkSession)
    return classes, members, exact_matches(classes) if scales is None else matches(classes, scales)


def _parted(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Classes joined with their rows. Classes of more than ``COPIES`` rows are spread over parts; a bitmap of them, of
    bounded size, tells both sides which these are."""
    on, parts = ["k", "x"], 64
    big = classes.where(F.col("n_train") + F.col("n_eval") > COPIES)
    if big.isEmpty():
        return classes.join(rows, on)
    words = bitmap(big, "x", CLASS_BITS)
    split = lambda df, part: maybe_in(df, "x", words, CLASS_BITS).withColumn("part", part).unionByName(maybe_not_in(df, "x", words, CLASS_BITS).withColumn("part", F.lit(0)))
    left = split(classes, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return left.join(split(rows, F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int")), [*on, "part"])


def _expanded(found: DataFrame, rows: DataFrame) -> DataFrame:
    """``rt, re``: the training and evaluation rows of matched classes, joined in parts of at most ``COPIES`` rows a side."""
    share = lambda n: F.ceil(F.greatest(F.lit(1), n) / COPIES)
    out = found
    for kind, is_train, n in (("t", True, "n_train"), ("e", False, "n_eval")):
        side = rows.where(F.col("is_train") == F.lit(is_train)).select(F.col("cid").alias(kind), F.col("rid").alias(f"r{kind}"), F.pmod(F.xxhash64("rid"), share(F.col(n))).alias("part"))
        if out.where(F.col(n) > COPIES).isEmpty():
            out = out.join(side.drop("part"), kind)
        else:
            out = out.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), share(F.col(n)) - 1))).join(side, [kind, "part"]).drop("part")
    return out


def overlaps(
    df: DataFrame, split_col: str = "split", train: str = "train", id_col: str = "row_id", first: str = "src", second: str = "tgt", scales: tuple[tuple[int, int], ...] | None = SCALES
) -> DataFrame:
    """``row_id_a, row_id_b``: every training row with every evaluation row it shares its content with.

    Rows whose split or id is NULL take no part; a NULL field counts as empty; an empty field is like an empty field only.
    Exact copies are collapsed before the search and expanded at the end, in parts of at most ``COPIES`` rows a side. An
    empty table gives an empty result. Building the result runs jobs. ``scales`` are the gram lengths and windows
    of the fingerprints (the first for every field); None compares without fingerprints, see ``exact_matches``.
    """
    classes, members, found = _prepared(df.withColumn("source", F.lit(None).cast("string")), split_col, train, id_col, first, second, scales)
    found = cut(found.drop("covered"))
    release(df.sparkSession)
    ids = found.select(F.explode(F.array("t", "e")).alias("cid")).distinct()
    matched = maybe_in(classes.select("cid", "k", "x", "n_train", "n_eval"), "cid", bitmap(ids, "cid", CLASS_BITS), CLASS_BITS).join(ids, "cid", "left_semi")
    matched = cut(matched)
    own = maybe_in(members.select("rid", (F.col("split") == train).alias("is_train"), "k", "x"), "x", bitmap(matched, "x", CLASS_BITS), CLASS_BITS)
    rows = _parted(matched, own).select("cid", "n_train", "n_eval", "rid", "is_train")
    pairs = _expanded(found, rows)
    return pairs.select(F.least("rt", "re").alias("row_id_a"), F.greatest("rt", "re").alias("row_id_b"))


def overlap_classes(df: DataFrame, split_col: str = "split", train: str = "train", id_col: str = "row_id", first: str = "src", second: str = "tgt") -> DataFrame:
    """``class_id, n_train, n_eval, linked_train, linked_eval, links``: the classes of equal records that have an overlap, with
    the numbers of their own rows, of the rows of other classes they are linked with, and of the row pairs in which
    they are the evaluation side. No group of copies is multiplied out."""
    classes, _, found = _prepared(df.withColumn("source", F.lit(None).cast("string")), split_col, train, id_col, first, second, SCALES)
    sizes = classes.select("cid", "n_train", "n_eval")
    counted = cut(found.select("t", "e", F.col("n_train").alias("t_rows"), F.col("n_eval").alias("e_rows")))
    other = F.col("t") != F.col("e")
    both = counted.select(F.col("e").alias("cid"), F.when(other, F.col("t_rows")).otherwise(0).alias("lt"), F.lit(0).cast("long").alias("le"), (F.col("t_rows") * F.col("e_rows")).alias("links")).unionByName(
        counted.where(other).select(F.col("t").alias("cid"), F.lit(0).cast("long").alias("lt"), F.col("e_rows").alias("le"), F.lit(0).cast("long").alias("links"))
    )
    sums = both.groupBy("cid").agg(F.sum("lt").alias("linked_train"), F.sum("le").alias("linked_eval"), F.sum("links").alias("links"))
    return sums.join(sizes, "cid").select(F.col("cid").alias("class_id"), "n_train", "n_eval", "linked_train", "linked_eval", "links")


def overlap_report(df: DataFrame, split_col: str = "split", train: str = "train", id_col: str = "row_id", first: str = "src", second: str = "tgt", source_col: str = "source") -> DataFrame:
    """Per evaluation split and source: records, records with an overlap, pairs, mean share of a record that the alignment
    with its best partner keeps. Splits and sources without an overlap are reported with zeros.
    """
    classes, members, found = _prepared(df.withColumn("source", F.col(source_col)), split_col, train, id_col, first, second, SCALES)
    hit = (
        found.groupBy("e")
        .agg(F.sum("n_train").alias("partners"), F.max("covered").alias("covered"))
        .join(classes.select(F.col("cid").alias("e"), "k", "x", (F.length("a") + F.length("b")).alias("size")), "e")
        .select("k", "x", "partners", F.least(F.lit(1.0), F.col("covered") / F.greatest(F.col("size"), F.lit(1))).alias("coverage"))
    )
    # rows are counted per class first, so that a class of many copies is one row a split and source
    counts = members.where(F.col("split") != train).groupBy("k", "x", "split", "source").agg(F.count("*").alias("n"))
    return (
        counts.join(hit, ["k", "x"], "left")
        .groupBy("split", "source")
        .agg(
            F.sum("n").alias("records"),
            F.coalesce(F.sum(F.when(F.col("partners").isNotNull(), F.col("n"))), F.lit(0)).alias("overlapping"),
            F.coalesce(F.sum(F.col("partners") * F.col("n")), F.lit(0)).alias("pairs"),
            F.coalesce(F.sum(F.col("coverage") * F.col("n")) / F.sum(F.when(F.col("partners").isNotNull(), F.col("n"))), F.lit(0.0)).alias("mean_coverage"),
        )
    )

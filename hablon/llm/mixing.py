"""Mixing sources to target weights: token blocks, multinomial shard counts, permuted block indices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hablon.llm.tokens import RANKS, encode, token_counts
from hablon.plans.lineage import cut
from hablon.plans.workers import prepared

BLOCK = 256  # tokens of a block
GROUPS = 4096  # the table of counts that the driver draws has at most so many rows
LEAST_SLOTS, MOST_SLOTS = 256, 65_536  # slots of a shard, unless the mixture is smaller


def _round_hash(right: np.ndarray, key: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = right * np.uint64(0x9E3779B97F4A7C15) + key
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _keys(seed: int, source: int, repeat: int) -> list[np.uint64]:
    return [np.uint64(v) for v in np.random.SeedSequence([seed, source, repeat]).generate_state(4, np.uint64)]


def permute(index: np.ndarray, n: int, seed: int, source: int, repeat: int, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of range(n): four Feistel rounds, walked until the value lies in range."""
    if n <= 1:
        return index.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), _keys(seed, source, repeat)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        v = out[todo]
        left, right = v >> np.uint64(half), v & mask
        if inverse:
            for key in reversed(keys):
                left, right = right ^ (_round_hash(left, key) & mask), left
        else:
            for key in keys:
                left, right = right, left ^ (_round_hash(right, key) & mask)
        v = (left << np.uint64(half)) | right
        out[todo] = v
        todo = todo[v >= np.uint64(n)]
    return out.astype(np.int64)


def shard_counts(quotas: list[int] | np.ndarray, slots: int, seed: int | list[int]) -> np.ndarray:
    """Source counts of each output shard: multinomial draws over what remains of each quota, which is used up exactly."""
    rng = np.random.default_rng(seed)
    left = np.array(quotas, np.int64)
    rows = []
    while left.sum() > slots:
        draw = rng.multinomial(slots, left / left.sum())
        over = np.maximum(draw - left, 0)
        draw -= over
        for _ in range(int(over.sum())):
            draw[int(np.argmax(left - draw))] += 1
        rows.append(draw)
        left = left - draw
    if left.sum():
        rows.append(left)
    return np.array(rows, np.int64).reshape(-1, len(quotas))


def mixture_size(blocks: list[int], shares: list[float], repeats: list[int]) -> int:
    """Blocks of the largest mixture in which no source is used more often than allowed. Sources without blocks, shares
    or repeats do not limit it."""
    limits = [n * r / s for n, s, r in zip(blocks, shares, repeats) if n > 0 and s > 0 and r > 0]
    total = sum(s for n, s, r in zip(blocks, shares, repeats) if n > 0 and s > 0 and r > 0)
    return int(min(limits) * total + 1e-9) if limits else 0


def quotas_of(blocks: list[int], shares: list[float], repeats: list[int]) -> list[int]:
    """Blocks per source by largest remainder, within the allowed repeats."""
    usable = [s if n > 0 and s > 0 and r > 0 else 0.0 for n, s, r in zip(blocks, shares, repeats)]
    size, total = mixture_size(blocks, shares, repeats), sum(usable)
    if not size:
        return [0] * len(blocks)
    exact = [s / total * size for s in usable]
    out = [int(x) for x in exact]
    for i in sorted(range(len(out)), key=lambda i: out[i] - exact[i])[: size - sum(out)]:
        if out[i] + 1 <= blocks[i] * repeats[i]:
            out[i] += 1
    return out


def _offsets(sizes: DataFrame, rows: int) -> DataFrame:
    """``doc_id, source, n_tokens, start``: place of each text in the token stream of its source.

    Bucket sums come first, so that only one row per bucket, not the source, is in one window.
    """
    buckets = max(1, rows // 5000)
    b = sizes.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    sums = b.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"))
    before = sums.select("source", "bucket", (F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket")) - F.col("tokens")).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id")
    return (
        b.withColumn("upto", F.sum("n_tokens").over(inside))
        .join(before, ["source", "bucket"])
        .select("doc_id", "source", "n_tokens", (F.col("base") + F.col("upto") - F.col("n_tokens")).alias("start"))
    )


def mix(
    df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, seed: int = 7, ranks: str = RANKS
) -> DataFrame:
    """One row per slot of the mixture: ``shard, slot, source, repeat_no, block_no, n_tokens, docs, tokens``.

    The texts of each source, in a fixed order, form one stream of tokens that is cut into blocks (the last one of a
    source may be short). The mixture is the largest in which every source reaches its share within its repeats.
    ``docs`` lists the texts a block is made of. Sources without tokens, or with a NULL or non-positive share or repeat
    count, get no slot, and the others keep their proportions. NULL and empty texts have no tokens; rows without an id or source are left out. ``targets`` is a
    configuration of a few rows.
    """
    spark = df.sparkSession
    schema = "shard int, slot long, source string, repeat_no int, block_no long, n_tokens int, docs array<bigint>, tokens array<int>"
    plan = [(r.source, float(r.target_share), int(r.max_repeats)) for r in targets.collect() if r.source is not None and r.target_share and r.max_repeats]
    names = [p[0] for p in plan]
    texts = df.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text")).where(F.col("source").isin(names) & F.col("doc_id").isNotNull())
    sizes = cut(token_counts(texts, "text", ["doc_id", "source"], ranks))
    seen = {r.source: (r.tokens, r.n) for r in sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).collect()}
    blocks = [-(-seen.get(s, (0, 0))[0] // block) for s in names]
    quotas = quotas_of(blocks, [p[1] for p in plan], [p[2] for p in plan])
    total = sum(quotas)
    if not total:
        return spark.createDataFrame([], schema)
    # counts of groups are drawn here, those of the shards of a group where they are needed: both tables are bounded
    per_group = max(LEAST_SLOTS, -(-total // GROUPS))
    per_shard = min(per_group, MOST_SLOTS)
    inner = -(-per_group // per_shard)  # shards of a group
    groups = shard_counts(quotas, per_group, seed)
    group_base = np.cumsum(groups, axis=0) - groups

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, counts, base = -1, groups, group_base
        for batch in batches:
            for shard in batch["id"]:
                if shard // inner != group:
                    group = int(shard // inner)
                    counts = groups[group : group + 1] if inner == 1 else shard_counts(groups[group], per_shard, [seed, group])
                    base = group_base[group] + np.cumsum(counts, axis=0) - counts
                k = int(shard % inner)
                if k >= len(counts):
                    continue
                order = np.random.default_rng([seed, int(shard)]).permutation(int(counts[k].sum()))
                at = 0
                for s, name in enumerate(names):
                    n = int(counts[k, s])
                    if not n:
                        continue
                    j = base[k, s] + np.arange(n)
                    repeat, place = j // blocks[s], j % blocks[s]
                    picked = np.empty(n, np.int64)
                    for r in np.unique(repeat):
                        picked[repeat == r] = permute(place[repeat == r], blocks[s], seed, s, int(r))
                    yield pd.DataFrame({"shard": np.int32(shard), "slot": order[at : at + n], "source": name, "repeat_no": repeat.astype(np.int32), "block_no": picked})
                    at += n

    slots = prepared(spark.range(len(groups) * inner)).mapInPandas(draw, "shard int, slot long, source string, repeat_no int, block_no long")

    def used(source: str, numbers: np.ndarray) -> np.ndarray:
        s = names.index(source)
        if quotas[s] >= blocks[s]:
            return np.ones(len(numbers), bool)
        return permute(numbers, blocks[s], seed, s, 0, inverse=True) < quotas[s]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"source": [], "block_no": [], "at": [], "doc_id": [], "part": []}
            for doc, source, start, size, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "start", "n_tokens", "text"))):
                numbers = np.arange(start // block, (start + size - 1) // block + 1)
                numbers = numbers[used(source, numbers)]
                if not len(numbers):
                    continue
                ids = encode(text, ranks)
                for number in numbers.tolist():
                    low, high = max(start, number * block), min(start + size, (number + 1) * block)
                    for key, value in zip(rows, (source, number, low - number * block, doc, ids[low - start : high - start])):
                        rows[key].append(value)
            yield pa.record_batch([pa.array(rows["source"], pa.string()), pa.array(rows["block_no"], pa.int64()), pa.array(rows["at"], pa.int32()), pa.array(rows["doc_id"], pa.int64()), pa.array(rows["part"], pa.list_(pa.int32()))], names=list(rows))

    placed = _offsets(sizes.where("n_tokens > 0"), sum(n for _, n in seen.values()))
    parts = placed.join(texts.select("doc_id", "text"), "doc_id").mapInArrow(pieces, "source string, block_no long, at int, doc_id long, part array<int>")
    whole = (
        parts.groupBy("source", "block_no")
        .agg(F.sort_array(F.collect_list(F.struct("at", "doc_id", "part"))).alias("parts"))
        .select("source", "block_no", F.col("parts.doc_id").alias("docs"), F.flatten("parts.part").alias("tokens"))
    )
    # the size of a generated table is unknown to the planner, so a broadcast is ruled out
    return slots.hint("merge").join(whole, ["source", "block_no"]).select("shard", "slot", "source", "repeat_no", "block_no", F.size("tokens").alias("n_tokens"), "docs", "tokens")


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per target source: target and actual share of the tokens, tokens, slots, and how often its blocks were used at
    most. A source that got no slot has zeros."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("slots"), (F.max("repeat_no") + 1).alias("most_repeats"))
    total = got.agg(F.sum("tokens").alias("all_tokens"))
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(got, "source", "left")
        .join(F.broadcast(total))
        .select(
            "source", "target_share", "max_repeats",
            F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
            F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        )
    )

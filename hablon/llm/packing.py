"""Filling containers of fixed capacity by sum-of-squares placement."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hablon.llm.tokens import RANKS, token_counts
from hablon.plans.lineage import cut
from hablon.plans.workers import prepared

SHARD_ITEMS = 20_000  # items that one task packs
FULL = 0.99  # containers filled less are opened again in the second round


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item, placed largest first.

    ``open_at[h]`` counts open containers with level h. An item goes where the sum of the squared counts over all levels
    0 < h < capacity becomes smallest; ties go to the fullest container.
    """
    order = np.argsort(-sizes, kind="stable")
    open_at = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    out = np.empty(len(sizes), np.int64)
    made = 0
    for i in order:
        size = int(sizes[i])
        if size == 0:
            out[i] = 0
            made = max(made, 1)
            continue
        levels = np.flatnonzero(open_at[1 : capacity - size + 1]) + 1
        fresh = 2 * open_at[size] + 1 if size < capacity else 0
        level = 0
        if len(levels):
            after = levels + size
            change = np.where(after < capacity, 2 * open_at[np.minimum(after, capacity)] + 1, 0) - 2 * open_at[levels] + 1
            best = len(levels) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= fresh:
                level = int(levels[best])
        if level:
            number = stacks[level].pop()
            open_at[level] -= 1
        else:
            number, made = made, made + 1
        out[i] = number
        if level + size < capacity:
            open_at[level + size] += 1
            stacks.setdefault(level + size, []).append(number)
    return out


_PACKED = "container_kind string, capacity int, doc_id long, piece_no int, start_token long, n_tokens long, container_id string, filled long"


def _pack_shard(key: tuple, rows: pd.DataFrame, round_no: int) -> pd.DataFrame:
    rows = rows.sort_values(["n_tokens", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    capacity = int(rows["capacity"].iloc[0])
    number = sum_of_squares(rows["n_tokens"].to_numpy(), capacity)
    filled = np.bincount(number, weights=rows["n_tokens"].to_numpy()).astype(np.int64)
    rows["container_id"] = [f"{key[0]}-{round_no}-{key[1]}-{n}" for n in number]
    rows["filled"] = filled[number]
    return rows[["container_kind", "capacity", "doc_id", "piece_no", "start_token", "n_tokens", "container_id", "filled"]]


def _round(items: DataFrame, round_no: int, shards: int) -> DataFrame:
    placed = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no", F.lit(round_no)), F.lit(shards)).cast("int"))
    return prepared(placed).groupBy("container_kind", "shard").applyInPandas(lambda key, rows: _pack_shard(key, rows, round_no), _PACKED)


def pack(df: DataFrame, containers: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """One row per piece of a text and container kind: where the piece lies and how full its container is.

    A text is divided only if it alone exceeds the capacity, into full containers and one remainder. Rows without an id are left out. NULL and empty
    texts are pieces of size 0 in a container of their shard. Texts are packed in shards of about ``SHARD_ITEMS``;
    containers that stay below ``FULL`` are emptied and their items packed again in fewer shards. ``containers`` is a
    configuration of a few rows; rows with a NULL or non-positive capacity are skipped. Empty tables give no rows.
    """
    kinds = [(r.container_kind, r.capacity_tokens) for r in containers.select("container_kind", "capacity_tokens").collect() if r.capacity_tokens and r.capacity_tokens > 0]
    spark = df.sparkSession
    if not kinds:
        return spark.createDataFrame([], _PACKED)
    sizes = cut(token_counts(df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", ["doc_id"], ranks))
    shards = max(1, -(-sizes.count() // SHARD_ITEMS))
    options = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(int(c)).alias("capacity")) for k, c in kinds])
    pieces = (
        sizes.withColumn("o", F.explode(options))
        .select(F.col("o.kind").alias("container_kind"), F.col("o.capacity").alias("capacity"), "doc_id", "n_tokens")
        .withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / F.col("capacity")).cast("int") - 1))))
        .withColumn("start_token", F.col("piece_no").cast("long") * F.col("capacity"))
        .withColumn("n_tokens", F.least(F.col("capacity").cast("long"), F.col("n_tokens") - F.col("start_token")))
    )
    cols = ["container_kind", "capacity", "doc_id", "piece_no", "start_token", "n_tokens"]
    whole = pieces.where("n_tokens = capacity").select(
        *cols, F.concat_ws("-", "container_kind", F.lit("full"), F.col("doc_id").cast("string"), F.col("piece_no").cast("string")).alias("container_id"), F.col("n_tokens").alias("filled")
    )
    rest = pieces.where("n_tokens < capacity").select(*cols)
    if shards == 1:
        return whole.unionByName(_round(rest, 1, 1))
    first = cut(_round(rest, 1, shards))
    loose = first.where(F.col("filled") < FULL * F.col("capacity"))
    again = max(1, -(-loose.count() // (SHARD_ITEMS * len(kinds))))
    return whole.unionByName(first.where(F.col("filled") >= FULL * F.col("capacity"))).unionByName(_round(loose.select(*cols), 2, again))


def fill_report(packed: DataFrame) -> DataFrame:
    """Per container kind: pieces, containers, tokens, the least possible number of containers, share of space used."""
    bins = packed.groupBy("container_kind", "capacity", "container_id").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("pieces"))
    return (
        bins.groupBy("container_kind", "capacity")
        .agg(F.sum("pieces").alias("pieces"), F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
        .withColumn("least_containers", F.ceil(F.col("tokens") / F.col("capacity")))
        .withColumn("used_share", F.col("tokens") / (F.col("containers") * F.col("capacity")))
    )

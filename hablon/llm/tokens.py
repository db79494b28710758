"""Token counts and ids from a public rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hablon.plans.workers import prepared

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# fixed value: the public pre-split pattern of the rank files
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPLIT = regex.compile(SPLIT)
PIECE = 1 << 16  # characters that are encoded at once; longer texts are cut between pre-tokens


@lru_cache(maxsize=2)
def encoder(path: str = RANKS):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, path: str = RANKS) -> list[int]:
    """Ids of a text; NULL and empty texts have none. Very long texts are encoded in pieces, which end where a pre-token
    ends, so that the ids are those of the whole text."""
    if not text:
        return []
    enc = encoder(path)
    if len(text) <= PIECE:
        return enc.encode_ordinary(text)
    out, at = [], 0
    for m in _SPLIT.finditer(text):
        if m.end() - at >= PIECE:
            # a pre-token is merged by itself; one of great length would exhaust the pattern matcher
            if m.start() > at:
                out += enc.encode_ordinary(text[at : m.start()])
            out += enc._encode_single_piece(m.group())
            at = m.end()
    return out + enc.encode_ordinary(text[at:])


def token_counts(df: DataFrame, text_col: str, keep: list[str], path: str = RANKS) -> DataFrame:
    """``keep`` columns and ``n_tokens``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.fromiter((len(encode(t, path)) for t in batch.column(text_col).to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n)], [*keep, "n_tokens"])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return prepared(df).select(*keep, text_col).mapInArrow(run, f"{fields}, n_tokens long")

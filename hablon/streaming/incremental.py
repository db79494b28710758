"""Incremental variants on Structured Streaming: append with checkpoints, deduplication, first-article state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.operators.extract import marked_language, sentence_rows
from hablon.plans.workers import prepared


def article_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Articles that arrive as JSON lines: ``url, category, text, ts``."""
    return spark.readStream.schema("url string, category string, text string, ts timestamp").option("maxFilesPerTrigger", files_per_trigger).json(path)


def new_articles(articles: DataFrame, delay: str = "7 days") -> DataFrame:
    """Each address once; state older than the delay is dropped, and with it later repeats."""
    return articles.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["url"])


def new_sentences(articles: DataFrame, delay: str = "7 days") -> DataFrame:
    """Sentences of acceptable length and language, each once."""
    s = sentence_rows(articles.withWatermark("ts", delay), "text", "url", "category", "ts")
    return s.where(marked_language(F.col("sentence"))).dropDuplicatesWithinWatermark(["sentence"])


STATE_MILLIS = 30 * 24 * 3600 * 1000  # how long the owner of a sentence is remembered after it was last seen, in event time
BUCKETS = 2048  # groups of sentences whose owners are kept together; a checkpoint holds for one number


def _packed(known: dict[str, tuple[str | None, int]]) -> bytes:
    owners, until = zip(*known.values())
    batch = pa.record_batch({"sentence": pa.array(known, pa.string()), "owner": pa.array(owners, pa.string()), "until": pa.array(until, pa.int64())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(stored: bytes) -> dict[str, tuple[str | None, int]]:
    columns = pa.ipc.open_stream(stored).read_all().to_pydict()
    return dict(zip(columns["sentence"], zip(columns["owner"], columns["until"])))


def _first_articles(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The rows of one bucket of sentences in one trigger that belong to the owners of their sentences."""
    known = _unpacked(bytes(state.get[0])) if state.exists else {}
    now = state.getCurrentWatermarkMs()
    seen = set()
    if not state.hasTimedOut:
        rows = pd.concat(list(batches), ignore_index=True)
        first = rows.sort_values(["ts", "url"]).drop_duplicates("sentence")
        for sentence, url in zip(first["sentence"], first["url"]):
            known.setdefault(sentence, (url, 0))
        last = rows.groupby("sentence")["ts"].max()
        for sentence, ts in zip(last.index, last):
            known[sentence] = known[sentence][0], max(int(ts.timestamp() * 1000) + STATE_MILLIS, now + 1)
        seen.update(last.index)
        owners = [known[s][0] for s in rows["sentence"]]
        yield rows[[u is not None and u == owner for u, owner in zip(rows["url"], owners)]][["url", "category", "pos", "sentence"]]
    known = {s: k for s, k in known.items() if k[1] >= now or s in seen}
    if known:
        state.update((_packed(known),))
        state.setTimeoutTimestamp(max(min(t for _, t in known.values()), now + 1))
    elif state.exists:
        state.remove()


def first_article_sentences(articles: DataFrame, delay: str = "30 days", buckets: int = BUCKETS) -> DataFrame:
    """Sentences of acceptable length and language in the first article that has them, repeats inside that article
    included. Of articles that arrive together the earliest counts. Articles later than the delay are dropped; a sentence that is
    not seen for ``STATE_MILLIS`` is forgotten. Articles without a time are left out. The owners of the sentences of one of
    ``buckets`` groups are one state, because a call of Python per sentence takes milliseconds."""
    s = sentence_rows(prepared(articles).where("ts is not null").withWatermark("ts", delay), "text", "url", "category", "ts").where(marked_language(F.col("sentence")))
    s = s.withColumn("bucket", F.pmod(F.xxhash64("sentence"), F.lit(buckets)))
    return s.groupBy("bucket").applyInPandasWithState(_first_articles, "url string, category string, pos int, sentence string", "known binary", "append", "EventTimeTimeout")


def new_lines(lines: DataFrame, last: int) -> DataFrame:
    """Lines of a growing numbered source that an earlier run, which ended with line ``last``, has not seen."""
    return lines.where(F.col("line_no") > last)


def category_counts(articles: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Articles per category and time window; late ones within the delay count."""
    return articles.withWatermark("ts", delay).groupBy(F.window("ts", window), "category").agg(F.count("*").alias("articles"))


def append(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Starts writing what is there and ends with it; the checkpoint makes a further run go on from here."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(path)

"""Plug-in points for models and external tools. Each loads its tool once per Python worker through a factory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hablon.plans.workers import prepared


def translate(df: DataFrame, factory: Callable[[], Callable[[list[str]], list[str]]], col: str = "text", out: str = "translated", batch: int = 32) -> DataFrame:
    """``df`` with a translated column. Blank text passes through; a batch that fails, or gets fewer or more answers than it
    has lines, is tried line by line, a line that fails becomes empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for rows in batches:
            texts = [t or "" for t in rows[col]]
            done = [t if not t.strip() else None for t in texts]
            todo = [i for i, d in enumerate(done) if d is None]
            for at in range(0, len(todo), batch):
                part = todo[at : at + batch]
                try:
                    new = list(model([texts[i] for i in part]))
                    if len(new) != len(part):
                        raise ValueError("an answer per text is needed")
                except Exception:
                    new = []
                    for i in part:
                        try:
                            (one,) = model([texts[i]])
                            new.append(one)
                        except Exception:
                            new.append("")
                for i, t in zip(part, new):
                    done[i] = t
            yield rows.assign(**{out: done})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    return prepared(df).drop(out).mapInPandas(run, f"{fields}, `{out}` string")


def remaining(df: DataFrame, done: DataFrame, order: str = "line_no") -> DataFrame:
    """Lines that are still to be translated: those after as many as an earlier run has written. Written lines stand in
    the order of ``df``, so their count tells where to go on."""
    return df.where(F.col(order) > done.count())


def fetch(urls: DataFrame, factory: Callable[[], Callable[[str], tuple[int, str, str]]], url: str = "url", delay: float = 1.0, tries: int = 4, longest: float = 300.0, wait: Callable[[float], None] | None = None) -> DataFrame:
    """``url, status, body`` of pages, by a client that a factory makes per worker and that answers an address with its
    status, body and the time to wait that the server asks for (or '').

    Requests to one host come from one task, ``delay`` seconds apart. Status 429 is tried again after the wait asked for,
    or after ever doubled waits, up to ``tries`` times; a client error gives status 0. Addresses are fetched once each.
    """
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z]+://)?([^/?#]*)", 1))
    jobs = urls.where(F.col(url).isNotNull()).select(F.col(url).alias("url")).distinct().withColumn("host", host)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        pause = wait or time.sleep
        client = factory()
        last: dict[str, float] = {}
        for rows in batches:
            out = []
            for address, at in zip(rows["url"], rows["host"]):
                back = delay
                for attempt in range(tries):
                    pause(max(0.0, last.get(at, 0.0) + delay - time.monotonic()))
                    try:
                        status, body, asked = client(address)
                    except Exception:
                        status, body, asked = 0, "", ""
                    last[at] = time.monotonic()
                    if status != 429:
                        break
                    back = min(longest, float(asked) if asked.strip().isdigit() else back * 2)
                    if attempt + 1 < tries:
                        pause(back)
                out.append((address, status, body))
            yield pd.DataFrame(out, columns=["url", "status", "body"])

    return prepared(jobs.repartition("host")).mapInPandas(run, "url string, status int, body string")


def annotate(df: DataFrame, factory: Callable[[], Callable[[str], str]], col: str, out: str) -> DataFrame:
    """``df`` with what a tool says of each text: a language detector, a grammar checker (as JSON), a recogniser."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = factory()
        for rows in batches:
            yield rows.assign(**{out: [tool(t) if t is not None else None for t in rows[col]]})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    return prepared(df).drop(out).mapInPandas(run, f"{fields}, `{out}` string")


def grammar_issues(df: DataFrame, factory, col: str, custom: list[str], chars: int = 10_000, most: int = 3) -> DataFrame:
    """English issues ``start, end, message, replacements`` of each text, checked in chunks, without custom words."""
    schema = "array<struct<start:int,end:int,message:string,replacements:array<string>>>"

    def chunked() -> Callable[[str], str]:
        import json

        tool = factory()

        def check(text: str) -> str:
            out = []
            for at in range(0, len(text), chars):
                out += [{"start": s + at, "end": e + at, "message": m, "replacements": r[:most]} for s, e, m, r in tool(text[at : at + chars])]
            return json.dumps(out)

        return check

    done = annotate(df, chunked, col, "__issues").withColumn("issues", F.from_json("__issues", schema)).drop("__issues")
    known = F.array(*map(F.lit, custom)).cast("array<string>")
    return done.withColumn("issues", F.filter("issues", lambda i: ~F.array_contains(known, F.lower(F.substr(F.col(col), i["start"] + 1, i["end"] - i["start"])))))


def page_texts(pages: DataFrame) -> DataFrame:
    """``path, text`` of recognised pages: the pages of a document in order, each under a line with its number."""
    one = F.format_string("--- PAGE %d ---\n%s", F.col("page"), F.coalesce("text", F.lit("")))
    whole = pages.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("page", one.alias("t")))).alias("p"))
    return whole.select("path", F.array_join("p.t", "\n\n").alias("text"))


def recognise_pages(files: DataFrame, factory: Callable[[], Callable[[bytes], Iterator[str]]]) -> DataFrame:
    """``path, page, text`` of documents read as binary files, one page at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = factory()
        for rows in batches:
            for path, content in zip(rows["path"], rows["content"]):
                for n, text in enumerate(read(bytes(content)), 1):
                    yield pd.DataFrame({"path": [path], "page": [n], "text": [text]})

    return prepared(files).select("path", "content").mapInPandas(run, "path string, page int, text string")


def pieces(df: DataFrame, model_file: str, col: str = "text", out: str = "pieces") -> DataFrame:
    """``df`` with the pieces of a given SentencePiece model."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        for rows in batches:
            yield rows.assign(**{out: model.encode([t or "" for t in rows[col]], out_type=str, num_threads=1)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != out)
    return prepared(df).drop(out).mapInPandas(run, f"{fields}, `{out}` array<string>")

"""Managing dictionaries, settings and collections as tables, and small operators around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hablon.functions.lexicon import dialect_map
from hablon.functions.text import pytrim, strip_diacritics
from hablon.operators.keyed import upsert


MOST_RULES = 10_000


def phrase_rules(rows: DataFrame, order: str = "line_no") -> tuple[tuple[str, str], ...]:
    """Ordered (pattern, replacement) rules of a small table; rows with a blank side are left out. Refuses a table of more
    than ``MOST_RULES`` rows: every rule becomes an expression of the plan."""
    if rows.limit(MOST_RULES + 1).count() > MOST_RULES:
        raise ValueError("too many rules for one plan")
    kept = rows.where((pytrim("pattern") != "") & (pytrim("replacement") != "")).orderBy(order)
    return tuple((r.pattern, r.replacement) for r in kept.select(pytrim("pattern").alias("pattern"), pytrim("replacement").alias("replacement")).collect())


def add_words(words: DataFrame, new: list[str]) -> DataFrame:
    """Words added in normal form, each once, sorted. Blank ones are left out."""
    extra = words.sparkSession.createDataFrame([(w,) for w in new], "word string")
    return words.select("word").unionByName(extra).select(strip_diacritics(pytrim("word")).alias("word")).where("word <> ''").distinct().orderBy("word")


def remove_words(words: DataFrame, gone: list[str]) -> DataFrame:
    """Words without those given, compared in normal form, sorted."""
    out = words.sparkSession.createDataFrame([(w,) for w in gone], "word string").select(strip_diacritics(pytrim("word")).alias("__w"))
    return words.join(out, strip_diacritics(pytrim("word")) == F.col("__w"), "left_anti").orderBy("word")


def add_entry(entries: DataFrame, base: str, target: str) -> DataFrame:
    """A dictionary entry added or changed; bases are compared in normal form."""
    one = entries.sparkSession.createDataFrame([(base, target)], "word string, target string").select(strip_diacritics(pytrim("word")).alias("word"), pytrim("target").alias("target"))
    return upsert(entries.select("word", "target"), one, "word").orderBy("word")


def remove_entry(entries: DataFrame, base: str) -> DataFrame:
    return entries.where(F.col("word") != strip_diacritics(pytrim(F.lit(base)))).orderBy("word")


def search_entries(entries: DataFrame, text: str) -> DataFrame:
    """Entries with the text in base or target, ignoring case."""
    q = F.lit(text.lower())
    return entries.where(F.contains(F.lower("word"), q) | F.contains(F.lower("target"), q)).orderBy("word")


def set_setting(settings: DataFrame, key: str, value: str) -> DataFrame:
    """A setting written with the time of the change."""
    one = settings.sparkSession.createDataFrame([(key, value)], "key string, value string").withColumn("updated_at", F.current_timestamp())
    return upsert(settings, one, "key")


def create_collection(collections: DataFrame, name: str, headers: list[str]) -> DataFrame:
    """A collection without rows added under a new id."""
    one = collections.sparkSession.createDataFrame([(name, headers)], "name string, headers array<string>")
    one = one.select(F.expr("uuid()").alias("id"), "name", "headers", F.lit(0).alias("row_count"), F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"))
    return collections.unionByName(one.select(*[F.col(c).cast(collections.schema[c].dataType) for c in collections.columns]))


def update_collection(collections: DataFrame, key: str, name: str | None = None, headers: list[str] | None = None) -> DataFrame:
    """Name or headers of a collection changed."""
    here = F.col("id") == key
    out = collections
    if name is not None:
        out = out.withColumn("name", F.when(here, F.lit(name)).otherwise(F.col("name")))
    if headers is not None:
        out = out.withColumn("headers", F.when(here, F.array(*map(F.lit, headers))).otherwise(F.col("headers")))
    return out.withColumn("updated_at", F.when(here, F.current_timestamp()).otherwise(F.col("updated_at")))


def delete_rows_by_id(rows: DataFrame, collections: DataFrame, ids: DataFrame, key: str = "id", collection: str = "collection_id") -> tuple[DataFrame, DataFrame]:
    """(``rows`` without those whose id is in ``ids``, ``collections`` with ``row_count`` as it is afterwards). Unknown and
    repeated ids are harmless; a collection that has lost all rows has 0."""
    left = rows.join(ids.select(key), key, "left_anti").select(*rows.columns)
    counted = left.groupBy(F.col(collection).alias("__c")).agg(F.count("*").alias("__n"))
    count = F.coalesce("__n", F.lit(0)).cast(collections.schema["row_count"].dataType)
    return left, collections.join(counted, F.col("id") == F.col("__c"), "left").withColumn("row_count", count).select(*collections.columns)


def rebuilt_map(entries: DataFrame, extra: DataFrame, base: str = "word", target: str = "target", order: str = "o") -> DataFrame:
    """The dialect map of a dictionary after its extra entries have changed: these count as later than all others."""
    own = entries.select(F.col(base).alias("word"), F.col(target).alias("target"), F.struct(F.lit(0).alias("part"), F.col(order).cast("string").alias("at")).alias("o"))
    more = extra.select(F.col(base).alias("word"), F.col(target).alias("target"), F.struct(F.lit(1).alias("part"), F.col(base).cast("string").alias("at")).alias("o"))
    return dialect_map(own.unionByName(more), "word", "target", "o")


def merged_spans(first: Column, second: Column) -> Column:
    """Spans of two kinds in order of their start; a span that overlaps one already taken is left out."""
    both = F.sort_array(F.concat(first, second))
    none = F.filter(both, lambda s: F.lit(False))

    def step(acc: Column, s: Column) -> Column:
        last = F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(0))
        return F.when(s["start"] >= last, F.concat(acc, F.array(s))).otherwise(acc)

    return F.aggregate(both, none, step)


def longest(df: DataFrame, size: Column, n: int = 20, *ties: str) -> DataFrame:
    """The n rows of the greatest size, a report; of equal ones the first by ``ties``."""
    return df.withColumn("size", size).orderBy(F.desc("size"), *ties).limit(n)


def known_books(df: DataFrame, requested: list[str], books: list[str], col: str = "book") -> DataFrame:
    """Rows of the requested books; an unknown one is an error."""
    unknown = sorted(set(requested) - set(books))
    if unknown:
        raise ValueError(f"unknown books: {', '.join(unknown)}")
    return df.where(F.col(col).isin(requested))


def files_by_folder(files: DataFrame) -> DataFrame:
    """``dir, names``: file names per folder, sorted."""
    return files.groupBy("dir").agg(F.array_sort(F.collect_list("name")).alias("names")).orderBy("dir")


def print_report(report: DataFrame, most: int = 200) -> str:
    """A tidy report as text, one metric a line with its mark; refuses more than ``most`` metrics."""
    mark = {"bad": "✗", "warn": "!", "ok": "✓"}
    rows = report.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} metrics")
    return "\n".join(f"{mark[r.flag]} {r.metric:<18}{r.value:>12g}{r.pct:>9.2f} %" for r in rows)


def empty_collections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "id string, name string, headers array<string>, row_count int, created_at timestamp, updated_at timestamp")

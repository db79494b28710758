"""Readers of corpus files. Every relation carries ``line_no``; missing text is empty, never NULL."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hablon.functions.text import entities, pytrim, strip_diacritics

SRC_NAMES, TGT_NAMES = ("source", "src", "en", "input"), ("target", "tgt", "translation", "output")  # fixed values
DELIMITERS = ",\t|;"


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows numbered in ``line_no`` by their file ``__f``, their block in it ``__b`` and an increasing number ``__i``.

    Lines are numbered by the order of file blocks: the rows of each input split are counted once, then numbered from
    the sums, so the numbers are dense without a sort of the file.
    """
    sums = rows.groupBy("__f", "__b").agg(F.count("*").alias("__n"))  # a row per input split
    base = sums.select("__f", "__b", (F.sum("__n").over(Window.orderBy("__f", "__b")) - F.col("__n")).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__f", "__b").orderBy("__i"))
    out = rows.withColumn("__r", inside).join(F.broadcast(base), ["__f", "__b"])
    return out.withColumn("line_no", F.col("__base") + F.col("__r")).drop("__f", "__b", "__i", "__r", "__base")


def _blocks(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.text(path, **options).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__i"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, text`` of a text file, blank lines kept, a byte order mark removed."""
    return _numbered(_blocks(spark, path)).select("line_no", F.when(F.col("line_no") == 1, F.regexp_replace("text", r"^\x{FEFF}", "")).otherwise(F.col("text")).alias("text"))


def filled_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are not blank, with their numbers in the file."""
    return text_lines(spark, path).where(pytrim("text") != "")


def sniff(spark: SparkSession, path: str, chars: int = 4096) -> str:
    """The delimiter of a table file, from its head; by suffix where the head does not tell."""
    head = "\n".join(r.value for r in spark.read.text(path).limit(50).collect())[:chars]
    try:
        return csv.Sniffer().sniff(head, DELIMITERS).delimiter
    except csv.Error:
        return "\t" if path.endswith((".tsv", ".txt")) else ","


def _numeric(cell: str) -> bool:
    return (cell or "").lstrip("-").replace(".", "").isdigit()


_RAGGED = "__ragged"


def _cells(spark: SparkSession, path: str, sep: str, header: bool) -> DataFrame:
    """``line_no`` and all cells, with the text of rows that have too few or too many of them in ``__ragged``.

    A file is read in parallel by lines unless some quoted cell holds a line break.
    """
    lines = spark.read.text(path)
    broken = not lines.where(F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 1).isEmpty()
    options = dict(sep=sep, header=header, quote='"', escape='"', multiLine=broken, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, mode="PERMISSIVE")
    names = spark.read.csv(path, inferSchema=False, **options).columns
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*names, _RAGGED])
    df = spark.read.schema(schema).csv(path, columnNameOfCorruptRecord=_RAGGED, enforceSchema=True, **options)
    rows = df.select("*", F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"), F.monotonically_increasing_id().alias("__i"))
    return _numbered(rows).select("line_no", *[F.col(f"`{c}`") for c in df.columns])


def table(spark: SparkSession, path: str, sep: str | None = None, header: bool = True) -> DataFrame:
    """All-string table with ``line_no`` from 1; short rows are padded, cells beyond the header cut, quotes doubled."""
    return _cells(spark, path, sep or ("\t" if path.endswith((".tsv", ".txt")) else ","), header).drop(_RAGGED).fillna("")


def resolve_columns(columns: list[str], src: str | int | None = None, tgt: str | int | None = None) -> tuple[str, str]:
    """Names of the source and target column: given by name or number, else by usual names, else the first two."""

    def pick(given: str | int | None, names: tuple[str, ...], default: int) -> str:
        if given is not None:
            if isinstance(given, int) or (isinstance(given, str) and given not in columns and given.isdigit()):
                return columns[int(given)]
            if given not in columns:
                raise ValueError(f"no column {given}")
            return given
        low = {c.lower(): c for c in reversed(columns)}
        return next((low[n] for n in names if n in low), columns[min(default, len(columns) - 1)])

    return pick(src, SRC_NAMES, 0), pick(tgt, TGT_NAMES, 1)


def pairs(spark: SparkSession, path: str, src: str | int | None = None, tgt: str | int | None = None, sep: str | None = None) -> DataFrame:
    """``line_no, src, tgt``, stripped, of a CSV or TSV file; a first row of numbers only is data. A row that is too short for
    either column has two empty texts; a file of fewer than two columns is an error."""
    sep = sep or sniff(spark, path)
    raw = _cells(spark, path, sep, header=False)
    names = [c for c in raw.columns if c not in ("line_no", _RAGGED)]
    if len(names) < 2:
        raise ValueError(f"at least two columns are needed, found {len(names)}")
    first = raw.where("line_no = 1").collect()
    head = [first[0][c] or "" for c in names] if first else []
    is_data = bool(head) and all(_numeric(h) for h in head)
    a, b = resolve_columns(head if head and not is_data else names, src, tgt)
    where = dict(zip(head if head and not is_data else names, names))
    body = raw if is_data else raw.where("line_no > 1").withColumn("line_no", F.col("line_no") - 1)
    last = max(names.index(where[a]), names.index(where[b]))
    bare = F.regexp_replace(_RAGGED, '"(?:[^"]|"")*"', "")
    short = F.col(_RAGGED).isNotNull() & (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) < last)
    cell = lambda c: F.when(short, "").otherwise(pytrim(F.coalesce(F.col(c), F.lit(""))))
    return body.select("line_no", cell(where[a]).alias("src"), cell(where[b]).alias("tgt"))


def load(spark: SparkSession, path: str) -> DataFrame:
    """A text file as one column ``text``, any other as a table by its suffix."""
    return text_lines(spark, path) if path.endswith(".txt") else table(spark, path)


def discover(spark: SparkSession, root: str, pattern: str = "*.tsv") -> DataFrame:
    """``path, name, dir`` of files below a folder, sorted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path")
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.regexp_replace("path", "/[^/]*$", "").alias("dir")).orderBy("path")


def json_records(lines: DataFrame, text: str = "text", all_targets: bool = True) -> tuple[DataFrame, DataFrame]:
    """(``line_no, src, tgt`` pairs, invalid lines) of JSON lines ``{src, trgs}``; ``trgs`` may be one string. A record
    that is no object, or has no targets, counts as invalid. Blank lines are skipped, pairs with an empty side dropped."""
    body = lines.where(pytrim(text) != "")
    j = F.try_parse_json(text)
    targets = F.coalesce(F.try_variant_get(j, "$.trgs", "array<string>"), F.when(F.try_variant_get(j, "$.trgs", "string").isNotNull(), F.array(F.try_variant_get(j, "$.trgs", "string"))))
    parsed = body.select("line_no", F.col(text).alias("text"), pytrim(F.try_variant_get(j, "$.src", "string")).alias("src"), targets.alias("trgs"))
    ok = F.col("src").isNotNull() & F.col("trgs").isNotNull()
    chosen = F.col("trgs") if all_targets else F.slice("trgs", 1, 1)
    good = parsed.where(ok).select("line_no", "src", F.posexplode(chosen).alias("pos", "t")).select("line_no", "pos", "src", pytrim("t").alias("tgt")).where("src <> '' and tgt <> ''")
    return good, parsed.where(~ok).select("line_no", "text")


def tmx(spark: SparkSession, path: str, src: str, tgt: str) -> DataFrame:
    """``src, tgt`` of a translation memory; languages match by prefix, the first unit of a language wins."""
    schema = "tuv array<struct<_lang:string,`_xml:lang`:string,seg:string>>"
    units = spark.read.format("xml").option("rowTag", "tu").schema(schema).load(path)
    code = lambda v: F.lower(F.coalesce(v["_lang"], v["_xml:lang"], F.lit("")))
    one = lambda lang: pytrim(F.get(F.filter("tuv", lambda v: F.startswith(code(v), F.lit(lang.lower()))), 0)["seg"])
    return units.select(one(src).alias("src"), one(tgt).alias("tgt")).where("src <> '' and tgt <> ''")


def moses_xml(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, text`` of the sentences of a tokenised XML file that have words; words may be nested.

    The file is read in parallel, cut at the ends of its sentences. Comments and CDATA sections are not expected.
    """
    rows = _blocks(spark, path, lineSep="</s>")
    inside = F.regexp_extract("text", r"(?s).*<s\b(?:[^>/]|/(?!>))*>(.*)\z", 1)
    words = F.regexp_extract_all(inside, F.lit(r"<w\b(?:[^>/]|/(?!>))*>([^<]+)"), 1)
    return _numbered(rows.withColumn("text", pytrim(F.array_join(F.transform(words, entities), " "))).where("text <> ''")).select("line_no", "text")


def moses_pairs(spark: SparkSession, src_path: str, tgt_path: str) -> DataFrame:
    """``line_no, src, tgt`` of two tokenised XML files, as far as the shorter one goes."""
    a, b = moses_xml(spark, src_path), moses_xml(spark, tgt_path)
    return a.withColumnRenamed("text", "src").join(b.withColumnRenamed("text", "tgt"), "line_no")


def tab_lines(lines: DataFrame, text: str = "text") -> DataFrame:
    """``line_no, cells``: unquoted lines cut at tabs, white space at their ends removed, blank lines dropped."""
    t = F.regexp_replace(text, r"(?U)\s+$", "")
    return lines.where(t != "").select("line_no", F.split(t, "\t").alias("cells"))


def second_column(lines: DataFrame, text: str = "text") -> DataFrame:
    """The second cell of tab-separated lines after the header, where there is one."""
    cells = F.split(text, "\t")
    return lines.where((F.col("line_no") > 1) & (F.size(cells) >= 2)).select("line_no", pytrim(cells[1]).alias("text")).where("text <> ''")


def visited(spark: SparkSession, path: str) -> DataFrame:
    """Distinct stripped keys of a checkpoint file."""
    return spark.read.text(path).select(pytrim("value").alias("key")).where("key <> ''").distinct()


def custom_words(settings: DataFrame | None, words: DataFrame) -> DataFrame:
    """Custom dictionary words: those of the settings table as they are stored if it has a list, even an empty one, else
    those of the file in normal form."""
    own = words.select(strip_diacritics(pytrim("word")).alias("word")).where("word <> ''").distinct()
    if settings is None:
        return own
    stored = settings.where("key = 'custom_dict'").select(F.from_json("value", "array<string>").alias("words")).where("words is not null")
    return own if stored.isEmpty() else stored.select(F.explode("words").alias("word")).where("word is not null").distinct()


_HTTP_DATE = "dd MMM yyyy HH:mm:ss z"


def retry_after(value: Column, now: Column | None = None) -> Column:
    """Seconds a server asks to wait: a number, or the time until a date, at least 1; 10 where neither is given."""
    v = pytrim(value)
    at = F.try_to_timestamp(F.regexp_replace(v, r"^[A-Za-z]+,\s*", ""), F.lit(_HTTP_DATE))
    left = at.cast("double") - (now if now is not None else F.current_timestamp()).cast("double")
    return F.when(v.rlike(r"\A\p{Nd}+\z"), v.cast("double")).when(at.isNotNull(), F.greatest(F.lit(1.0), left)).otherwise(F.lit(10.0))


def contained_path(base: str, path: Column) -> Column:
    """The path below ``base`` that a relative path stands for, without ``.`` and ``..``; NULL if it leads out of it or is
    NULL. Links are not followed."""
    root = "/" + "/".join(p for p in base.split("/") if p)
    whole = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root + "/"), path))
    none = F.array().cast("array<string>")
    up = lambda acc: F.slice(acc, 1, F.greatest(F.lit(0), F.size(acc) - 1))
    steps = F.aggregate(F.split(whole, "/"), none, lambda acc, p: F.when((p == "") | (p == "."), acc).when(p == "..", up(acc)).otherwise(F.concat(acc, F.array(p))))
    out = F.concat(F.lit("/"), F.array_join(steps, "/"))
    return F.when((out == root) | F.startswith(out, F.lit(root.rstrip("/") + "/")), out)

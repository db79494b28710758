"""Writers of corpus files. Ordered texts are written as parts whose names sort like their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _ordered(df: DataFrame, order: str, single: bool) -> DataFrame:
    """Rows in order: ranges of the order, one file each, in files whose names sort alike; or all in one task."""
    return df.coalesce(1).sortWithinPartitions(order) if single else df.repartitionByRange(order).sortWithinPartitions(order)


def delimited(df: DataFrame, path: str, order: str | None = "line_no", sep: str = "\t", line_end: str = "\n", header: bool = True, single: bool = False) -> None:
    """A table with minimal quoting; ``\\r\\n`` line ends where asked for. The order column is not written. The rows of
    the files, read in the order of their names, are in order; ``single`` asks for one file, written by one task."""
    out = _ordered(df, order, single).drop(order) if order else df.coalesce(1) if single else df
    out.write.mode("overwrite").option("sep", sep).option("header", header).option("quote", '"').option("escape", '"').option("emptyValue", "").option("nullValue", "").option("lineSep", line_end).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def lines(df: DataFrame, path: str, col: str = "text", order: str = "line_no", single: bool = False) -> None:
    """A text; NULL lines are empty. In files as ``delimited`` writes them."""
    _ordered(df.select(order, F.coalesce(F.col(col), F.lit("")).alias("value")), order, single).select("value").write.mode("overwrite").text(path)


def json_array(df: DataFrame, order: str, most: int = 100_000) -> str:
    """A small table as a JSON array; refuses a larger one, which is to be written as JSON lines."""
    rows = df.orderBy(order).select(F.to_json(F.struct(*df.columns)).alias("j")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too large for one JSON array; use json_lines")
    return "[" + ",\n".join(r.j for r in rows) + "]"


def json_lines(df: DataFrame, path: str, append: bool = True) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def source_only(df: DataFrame, path: str, col: str = "src", order: str = "line_no") -> None:
    """Sentences with an empty second column, without header."""
    lines(df.select(order, F.concat(F.col(col), F.lit("\t")).alias("text")), path, order=order)


def labelled(df: DataFrame, url: str, when: str, path: str) -> None:
    """A text report: preamble, then ``[n] text`` per paragraph."""
    n = df.count()
    head = df.sparkSession.createDataFrame([(-4, f"Source: {url}"), (-3, f"Scraped: {when}"), (-2, f"Total paragraphs: {n}"), (-1, "")], "line_no long, text string")
    body = df.select(F.col("index").cast("long").alias("line_no"), F.format_string("[%d] %s", F.col("index"), F.col("text")).alias("text"))
    lines(head.unionByName(body), path)


def aligned_splits(df: DataFrame, path: str, order: str = "position") -> None:
    """For each split two files of equally many lines in one order: ``<split>.hil`` and ``<split>.en`` folders."""
    for name in ("train", "dev"):
        part = df.where(F.col("split") == name)
        for col in ("hil", "en"):
            lines(part.select(order, F.col(col).alias("text")), f"{path}/{name}.{col}", order=order)


CURRENT = "CURRENT"


def rewrite(df: DataFrame, path: str, version: str, **options) -> str:
    """A new version of a table beside the old ones, which then becomes the current one; its path is returned.

    The version is named in a pointer file that is replaced by one rename after all rows are written, so a reader sees the
    old table or the new one, and a table that is being read is never overwritten.
    """
    root = path.rstrip("/")
    target = f"{root}__{version}"
    delimited(df, target, **options)
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    pointer, fresh = jvm.org.apache.hadoop.fs.Path(f"{root}/{CURRENT}"), jvm.org.apache.hadoop.fs.Path(f"{root}/{CURRENT}.{version}")
    fs = pointer.getFileSystem(conf)
    out = fs.create(fresh, True)
    out.write(bytearray(target.encode()))
    out.close()
    fs.delete(pointer, False)
    if not fs.rename(fresh, pointer):
        raise OSError(f"could not name {target} the current version")
    return target


def current(spark: SparkSession, path: str) -> str:
    """The path of the current version of a table written by ``rewrite``."""
    return spark.read.text(f"{path.rstrip('/')}/{CURRENT}", wholetext=True).first()[0]


def clipboard(df: DataFrame, cols: list[str], order: str, most: int = 10_000) -> str:
    """Selected rows as tab-separated text; refuses more than ``most`` rows."""
    rows = df.orderBy(order).limit(most + 1).select(F.array_join(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), "\t").alias("v")).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; write a table instead")
    return "\n".join(r.v for r in rows)

"""Quality profiles of monolingual and parallel corpora.

A parallel corpus has ``line_no, src, tgt``, a monolingual one ``line_no, text``. NULL text counts as empty. Empty
corpora give a row of zeros. Columns beyond these are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.functions.text import char_count, html_tags, pytrim, row_keys, tokens

RATIO, TOKENS = (0.2, 5.0), (3, 200)  # default limits of length ratio and token counts
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
WORD_CHAR = r"[\p{L}\p{N}_]"


def _all_digits(t: Column) -> Column:
    return (F.size(t) > 0) & F.forall(t, lambda w: w.rlike(r"\A\p{Nd}+\z"))


def pair_features(pairs: DataFrame, ratio: tuple[float, float] = RATIO, limits: tuple[int, int] = TOKENS) -> DataFrame:
    """Per pair: stripped sides, token arrays, lengths and all issue flags. Flags other than the empty ones are false
    where a side is empty."""
    s, t = (F.coalesce(c, F.lit("")) for c in ("src", "tgt"))
    base = pairs.select("line_no", s.alias("src"), t.alias("tgt"), pytrim(s).alias("s"), pytrim(t).alias("t"))
    base = base.withColumn("full", (F.col("s") != "") & (F.col("t") != ""))
    base = base.withColumns({"st": F.when(F.col("full"), tokens("src")).otherwise(F.array().cast("array<string>")), "tt": F.when(F.col("full"), tokens("tgt")).otherwise(F.array().cast("array<string>"))})
    base = base.withColumns({"sl": F.size("st"), "tl": F.size("tt")})
    full, sl, tl = F.col("full"), F.col("sl"), F.col("tl")
    low, high = limits
    value = F.when(tl > 0, sl / tl).when(sl > 0, F.lit(float("inf")))
    return base.withColumns(
        {
            "ratio": value,
            "both_empty": (F.col("s") == "") & (F.col("t") == ""),
            "src_empty": (F.col("s") == "") & (F.col("t") != ""),
            "tgt_empty": (F.col("s") != "") & (F.col("t") == ""),
            "src_punctuation": full & ~F.col("src").rlike(WORD_CHAR),
            "tgt_punctuation": full & ~F.col("tgt").rlike(WORD_CHAR),
            "control": full & (F.col("src").rlike(CONTROL) | F.col("tgt").rlike(CONTROL)),
            "numeric": full & _all_digits(F.col("st")) & _all_digits(F.col("tt")),
            "ratio_issue": full & F.coalesce((value < ratio[0]) | (value > ratio[1]), F.lit(False)),
            "short": full & (((sl > 0) & (sl < low)) | ((tl > 0) & (tl < low))),
            "long": full & ((sl > high) | (tl > high)),
            "html_mismatch": full & (F.sort_array(html_tags("src")) != F.sort_array(html_tags("tgt"))),
        }
    )


FLAGS = ("src_empty", "tgt_empty", "both_empty", "src_punctuation", "tgt_punctuation", "control", "numeric", "html_mismatch", "ratio_issue", "short", "long")


def length_stats(df: DataFrame, col: str, name: str) -> list[Column]:
    """min, max, mean and upper median of the positive values of a column; 0 if there are none."""
    v = F.when(F.col(col) > 0, F.col(col))
    median = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY CASE WHEN {col} > 0 THEN {col} END DESC)")
    z = lambda c: F.coalesce(c, F.lit(0))
    return [z(F.min(v)).cast("long").alias(f"{name}_min"), z(F.max(v)).cast("long").alias(f"{name}_max"), z(F.avg(v)).cast("double").alias(f"{name}_mean"), z(median).cast("long").alias(f"{name}_median")]


def _extra(counted: DataFrame, name: str) -> DataFrame:
    n = F.col("n")
    return counted.agg(F.coalesce(F.sum(F.when(n > 1, n - 1)), F.lit(0)).alias(f"{name}_extra"), F.count(F.when(n > 1, 1)).alias(f"{name}_types"))


def duplicate_counts(features: DataFrame) -> DataFrame:
    """One row: repeated pairs and sides among pairs with two non-empty sides."""
    full = features.where("full")
    pair = _extra(full.groupBy("s", "t").agg(F.count("*").alias("n")), "pair")
    src = _extra(full.groupBy("s").agg(F.count("*").alias("n")), "src")
    tgt = _extra(full.groupBy("t").agg(F.count("*").alias("n")), "tgt")
    return pair.crossJoin(src.select("src_extra")).crossJoin(tgt.select("tgt_extra"))  # three single rows


def health(total: Column, weighted: list[tuple[Column, int]]) -> Column:
    """100 less a capped penalty per issue, rounded half to even, not below 0; 100 for an empty corpus."""
    penalty = sum((F.least(c / F.greatest(total, F.lit(1)) * w * 100, F.lit(float(w * 10))) for c, w in weighted), F.lit(0.0))
    return F.greatest(F.lit(0), F.bround(F.lit(100.0) - penalty, 0).cast("long"))


def parallel_metrics(pairs: DataFrame, ratio: tuple[float, float] = RATIO, limits: tuple[int, int] = TOKENS) -> DataFrame:
    """All counters, length statistics, duplicate counts, vocabulary sizes and the health score, in one row."""
    f = pair_features(pairs, ratio, limits)
    counters = [F.count_if(c).alias(c) for c in FLAGS]
    f = f.withColumns({"sc": F.when(F.col("full"), F.length("s")).otherwise(0), "tc": F.when(F.col("full"), F.length("t")).otherwise(0)})
    stats = [x for c, n in (("sl", "src_len"), ("tl", "tgt_len"), ("sc", "src_char"), ("tc", "tgt_char")) for x in length_stats(f, c, n)]
    one = f.agg(F.count("*").alias("total"), *counters, F.coalesce(F.sum("sl"), F.lit(0)).alias("src_tokens"), F.coalesce(F.sum("tl"), F.lit(0)).alias("tgt_tokens"), *stats)
    vocab = (
        f.select(F.explode(F.concat(F.transform("st", lambda w: F.struct(F.lit("s").alias("side"), w.alias("w"))), F.transform("tt", lambda w: F.struct(F.lit("t").alias("side"), w.alias("w"))))).alias("x"))
        .groupBy("x.side", "x.w").agg(F.lit(1).alias("one"))
        .agg(F.count_if(F.col("side") == "s").alias("src_vocab"), F.count_if(F.col("side") == "t").alias("tgt_vocab"))
    )
    row = one.crossJoin(duplicate_counts(f)).crossJoin(vocab)  # single rows
    total = F.col("total")
    score = health(total, [(F.col("src_empty"), 5), (F.col("tgt_empty"), 5), (F.col("both_empty"), 5), (F.col("ratio_issue"), 2), (F.col("pair_extra"), 2), (F.col("short"), 1)])
    return row.withColumn("health", score)


def flagged(pairs: DataFrame, ratio: tuple[float, float] = RATIO, limits: tuple[int, int] = TOKENS) -> DataFrame:
    """``line_no, src, tgt, issues`` of flagged pairs; repeated pairs are flagged from their second line on, blank pairs
    included. Issues are sorted and joined by ``|``."""
    f = pair_features(pairs, ratio, limits)
    firsts = f.groupBy(*[k.alias(n) for k, n in zip(row_keys(F.col("s"), F.col("t")), ("__k", "__x"))]).agg(F.min("line_no").alias("__first")).select("__first")  # joined by line, not by text
    f = f.join(firsts, F.col("line_no") == F.col("__first"), "left")
    again = F.col("__first").isNull()
    names = {
        "duplicate": again, "long": F.col("long"), "ratio": F.col("ratio_issue"), "short": F.col("short"),
        "src_empty": F.col("s") == "", "tgt_empty": F.col("t") == "",
    }
    issues = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in sorted(names.items())]))
    return f.select("line_no", "src", "tgt", F.array_join(issues, "|").alias("issues")).where("issues <> ''")


def top_tokens(lines: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent tokens; of equally frequent ones those that occur first."""
    words = lines.select("line_no", F.posexplode(tokens(F.coalesce(F.col(col), F.lit("")))).alias("pos", "token"))
    counted = words.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct("line_no", "pos")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(k).select("token", "n")


def histogram(values: DataFrame, col: str, buckets: int = 10) -> DataFrame:
    """``low, high, n`` of equal buckets from the smallest value; a single value makes one bucket."""
    ends = values.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    step = F.greatest(F.lit(1), F.floor((F.col("hi") - F.col("lo")) / buckets))
    low = F.floor((F.col(col) - F.col("lo")) / step) * step + F.col("lo")
    return values.select(col).where(F.col(col).isNotNull()).crossJoin(F.broadcast(ends)).select(low.cast("long").alias("low"), (low + step - 1).cast("long").alias("high")).groupBy("low", "high").agg(F.count("*").alias("n"))


def recommendations(metrics: DataFrame) -> DataFrame:
    """``severity, issue, n`` from the row of ``parallel_metrics``, most severe first."""
    share = lambda c: F.col(c) / F.greatest(F.col("total"), F.lit(1)) * 100
    level = lambda c, limit, high, low: F.when(share(c) > limit, high).otherwise(low)
    useless = F.greatest("src_punctuation", "tgt_punctuation") + F.col("numeric")
    rules = [
        (level("long", 5, "HIGH", "MED"), "long", F.col("long")),
        (level("short", 2, "HIGH", "MED"), "short", F.col("short")),
        (level("ratio_issue", 2, "HIGH", "MED"), "ratio", F.col("ratio_issue")),
        (F.lit("MED"), "duplicate", F.col("pair_extra")),
        (level("html_mismatch", 1, "MED", "LOW"), "html", F.col("html_mismatch")),
        (F.lit("LOW"), "useless", useless),
        (F.lit("MED"), "skew", F.when(F.col("src_len_mean") > F.col("src_len_median") * 3, F.lit(1)).otherwise(0)),
    ]
    rank = lambda s: F.when(s == "HIGH", 0).when(s == "MED", 1).otherwise(2)
    items = F.array(*[F.struct(rank(s).alias("rank"), F.lit(i).alias("place"), s.alias("severity"), F.lit(n).alias("issue"), c.cast("long").alias("n")) for i, (s, n, c) in enumerate(rules)])
    return metrics.select(F.explode(items).alias("r")).where("r.n > 0").orderBy("r.rank", "r.place").select("r.severity", "r.issue", "r.n")


def line_features(lines: DataFrame, limits: tuple[int, int] = TOKENS) -> DataFrame:
    s = pytrim(F.coalesce(F.col("text"), F.lit("")))
    base = lines.select("line_no", s.alias("s"))
    base = base.withColumn("tok", tokens("s")).withColumns({"n": F.size("tok"), "chars": char_count("s"), "full": F.col("s") != ""})
    full, n = F.col("full"), F.col("n")
    return base.withColumns(
        {
            "empty": ~full,
            "punctuation": full & ~F.col("s").rlike(WORD_CHAR),
            "numeric": full & _all_digits(F.col("tok")),
            "control": full & F.col("s").rlike(CONTROL),
            "short": full & (n > 0) & (n < limits[0]),
            "long": full & (n > limits[1]),
        }
    )


def mono_metrics(lines: DataFrame, limits: tuple[int, int] = TOKENS) -> DataFrame:
    """The profile of a monolingual corpus in one row."""
    f = line_features(lines, limits)
    names = ("empty", "punctuation", "numeric", "control", "short", "long")
    one = f.agg(F.count("*").alias("total"), *[F.count_if(c).alias(c) for c in names], F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), *length_stats(f, "n", "len"), *length_stats(f, "chars", "char"))
    dup = _extra(f.where("full").groupBy("s").agg(F.count("*").alias("n")), "dup")
    vocab = f.select(F.explode("tok").alias("w")).groupBy("w").agg(F.lit(1).alias("one")).agg(F.count("*").alias("vocab"))
    score = health(F.col("total"), [(F.col("empty"), 5), (F.col("dup_extra"), 2), (F.col("short"), 1)])
    return one.crossJoin(dup).crossJoin(vocab).withColumn("health", score)


def mono_recommendations(metrics: DataFrame) -> DataFrame:
    """``severity, issue, n`` from the row of ``mono_metrics``."""
    items = F.array(*[F.struct(F.lit(s).alias("severity"), F.lit(i).alias("issue"), F.col(c).cast("long").alias("n")) for s, i, c in (("MED", "duplicate", "dup_extra"), ("MED", "short", "short"), ("LOW", "long", "long"))])
    return metrics.select(F.inline(items)).where("n > 0")


def report(metrics: DataFrame) -> DataFrame:
    """Tidy ``metric, value, pct, flag`` of a row of metrics: above 1 % is bad, above 0 a warning."""
    names = [c for c in metrics.columns if c != "total"]
    row = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"), (F.col(c) / F.greatest(F.col("total"), F.lit(1)) * 100).cast("double").alias("pct")) for c in names])
    out = metrics.select(F.inline(row))
    return out.withColumn("flag", F.when(F.col("pct") > 1, "bad").when(F.col("pct") > 0, "warn").otherwise("ok"))


def samples(features: DataFrame, flag: str, n: int = 5, width: int = 60) -> DataFrame:
    """The first n flagged pairs in line order, texts cut to a width."""
    return features.where(F.col(flag)).orderBy("line_no").limit(n).select("line_no", F.substring("src", 1, width).alias("src"), F.substring("tgt", 1, width).alias("tgt"))

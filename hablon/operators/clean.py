"""The row cleaner: a fixed order of steps as one labelled projection instead of a fold over copies of the table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hablon.functions.text import TAG, row_keys, strip_html, token_count

MAX_TOKENS, MIN_TOKENS, RATIO = 150, 3, (0.5, 9.0)
LETTER = r"[a-zA-Z\x{00C0}-\x{FFFF}]"
STEPS = ("long", "short", "ratio", "duplicate", "html", "punctuation")

#: Further row steps by name: a function from the text columns to the condition under which a row is dropped. They run
#: after the built-in steps in the order of their registration.
EXTRA: dict[str, Callable[[list[Column]], Column]] = {}


def register_step(name: str, drops: Callable[[list[Column]], Column]) -> None:
    EXTRA[name] = drops


def label(df: DataFrame, cols: list[str], order: str = "line_no", max_tokens: int = MAX_TOKENS, min_tokens: int = MIN_TOKENS, ratio: tuple[float, float] = RATIO) -> DataFrame:
    """``df`` with cleaned columns ``c__clean`` and ``dropped_by`` (the first step that drops the row, or NULL).

    NULL counts as empty text. The ratio step needs two columns and compares the first two. Of equal rows the first
    survivor of the earlier steps stays; rows that become equal only by removing markup stay. The order column is unique.
    """
    # counts are columns of their own, so that the branches and filters that use them do not count again
    counted = df.withColumns({f"__n{i}": token_count(F.coalesce(F.col(c), F.lit(""))) for i, c in enumerate(cols)})
    counts = [F.col(f"__n{i}") for i in range(len(cols))]
    early = F.when(F.greatest(*counts, F.lit(0)) > max_tokens, "long").when(F.least(*counts, F.lit(2**31 - 1)) < min_tokens, "short")
    if len(cols) >= 2:
        r = counts[0] / F.greatest(counts[1], F.lit(1))
        early = early.when((r < ratio[0]) | (r > ratio[1]), "ratio")
    marked = counted.withColumn("__early", early).drop(*[f"__n{i}" for i in range(len(cols))])
    keys = [k.alias(f"__{i}") for i, k in enumerate(row_keys(*[F.col(c) for c in cols]))]
    # the first survivor of each group of equal rows; the join is on the unique order, so that a large group is no hot key
    firsts = marked.where("__early is null").groupBy(*keys).agg(F.min(order).alias("__first")).select("__first")
    cleaned = {f"{c}__clean": strip_html(F.coalesce(F.col(c), F.lit(""))) for c in cols}
    out = marked.join(firsts, F.col(order) == F.col("__first"), "left").withColumns(cleaned)
    kept = [F.col(f"{c}__clean") for c in cols]
    late = F.coalesce("__early", F.when(F.col("__first").isNull(), "duplicate"))
    letters = F.lit(True)
    for k in kept:
        letters = letters & k.rlike(LETTER)
    late = F.coalesce(late, F.when(~letters, "punctuation"))
    for name, drops in EXTRA.items():
        late = F.coalesce(late, F.when(drops(kept), name))
    return out.withColumn("dropped_by", late).drop("__early", "__first")


def clean(df: DataFrame, cols: list[str], **options) -> DataFrame:
    """The surviving rows with markup removed, columns as in ``df``."""
    marked = label(df, cols, **options)
    return marked.where("dropped_by is null").select(*[F.col(f"{c}__clean").alias(c) if c in cols else F.col(c) for c in df.columns])


def accounting(df: DataFrame, cols: list[str], **options) -> DataFrame:
    """``step, n``: rows each step drops (for ``html``: rows with markup among those it sees), steps without any too."""
    marked = label(df, cols, **options)
    tagged = F.lit(False)
    for c in cols:
        tagged = tagged | F.coalesce(F.col(c), F.lit("")).rlike(TAG)
    seen = F.coalesce(F.col("dropped_by"), F.lit("")).isin("long", "short", "ratio", "duplicate")
    names = [*STEPS, *EXTRA]
    counts = marked.agg(*[F.count_if(tagged & ~seen if s == "html" else F.coalesce(F.col("dropped_by") == s, F.lit(False))).alias(s) for s in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("n")) for s in names])))


def modified_cells(df: DataFrame, cols: list[str], order: str = "line_no", **options) -> DataFrame:
    """``line_no, column, before, after`` of the cells of surviving rows that cleaning changes."""
    marked = label(df, cols, order=order, **options).where("dropped_by is null")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("")).alias("before"), F.col(f"{c}__clean").alias("after")) for c in cols])
    return marked.select(order, F.inline(cells)).where("before <> after")

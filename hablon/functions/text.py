"""Column functions over text that stay inside whole-stage code generation.

All of them return NULL for a NULL input unless stated otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"  # Unicode word run
TAG = r"<[^>]+>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pytrim(x: Column | str) -> Column:
    """Strip Unicode white space at both ends (Spark's trim strips U+0020 only)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def squeeze(x: Column | str) -> Column:
    """Collapse white-space runs to one blank and strip."""
    return pytrim(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def tokens(x: Column | str) -> Column:
    """Lower-cased word runs in order."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(WORD), 0)


def token_count(x: Column | str) -> Column:
    return F.size(F.regexp_extract_all(_c(x), F.lit(WORD), 0))


def char_count(x: Column | str) -> Column:
    """Code points after stripping."""
    return F.length(pytrim(x))


def word_count(x: Column | str) -> Column:
    """White-space separated words."""
    return F.size(F.regexp_extract_all(_c(x), F.lit(r"(?U)\S+"), 0))


def html_tags(x: Column | str) -> Column:
    return F.regexp_extract_all(_c(x), F.lit(TAG), 0)


def strip_html(x: Column | str) -> Column:
    return pytrim(F.regexp_replace(_c(x), TAG, ""))


def _code_point(n: Column) -> Column:
    """The character of a code point; the replacement character where there is none."""
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise("\uFFFD")


def entities(x: Column | str) -> Column:
    """Character references of HTML and XML decoded once: numbers, and names that end with a semicolon. Unknown ones stay."""
    from html.entities import name2codepoint

    x = _c(x)
    table = F.create_map(*[F.lit(v) for name, code in sorted({**name2codepoint, "apos": 39}.items()) for v in (name, chr(code))])
    parts = F.regexp_extract_all(x, F.lit(r"(?s)&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"), 0)

    def one(t: Column) -> Column:
        decimal = F.regexp_extract(t, r"\A&#(\d+);\z", 1)
        hexadecimal = F.regexp_extract(t, r"\A&#[xX]([0-9a-fA-F]+);\z", 1)
        name = F.regexp_extract(t, r"\A&([A-Za-z][A-Za-z0-9]*);\z", 1)
        return (
            F.when(decimal != "", _code_point(decimal.cast("int")))
            .when(hexadecimal != "", _code_point(F.conv(hexadecimal, 16, 10).cast("int")))
            .when(name != "", F.coalesce(F.element_at(table, name), t))
            .otherwise(t)
        )

    return F.when(F.contains(x, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(x)


def letters_digits(x: Column | str) -> Column:
    """Lower-cased letters and digits only; NULL counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(_c(x), F.lit(""))), r"[^\p{L}\p{N}]+", "")


def row_keys(*cols: Column) -> tuple[Column, Column]:
    """A 128-bit key of some texts and an independent 64-bit hash that tells colliding keys apart: 24 bytes to group by in
    place of the texts. Lengths keep ("ab", "c") and ("a", "bc") apart; NULL counts as empty."""
    texts = [F.coalesce(c, F.lit("")) for c in cols]
    whole = F.concat(*[x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t)])
    return F.unhex(F.md5(whole)), F.xxhash64(whole)


def sentences(x: Column | str) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(_c(x), r"(?<=[.!?])(?U:\s+)")


def _latin_table() -> tuple[str, str]:
    """Precomposed letters below U+0250 and in Latin Extended Additional with their bare letter, from Unicode data."""
    import unicodedata

    src, dst = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        flat = "".join(ch for ch in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(ch) != "Mn").lower()
        if len(flat) == 1 and flat != chr(code):
            src.append(chr(code))
            dst.append(flat)
    return "".join(src), "".join(dst)


def strip_diacritics(x: Column | str) -> Column:
    """Lower case without accents for precomposed Latin letters and loose combining marks."""
    src, dst = _latin_table()
    return F.translate(F.lower(F.regexp_replace(_c(x), r"\p{Mn}+", "")), src, dst)

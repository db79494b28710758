"""Fragments of SQL for checks, in the dialect of the checking engine (RE2 patterns)."""

WS = r"[\p{Z}\t\n\x0b\f\r\x{85}]"


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return trim(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def toks(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+')"


def ntok(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+'))"


def nwords(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^\p{{Z}}\t\n\x0b\f\r\x{{85}}]+'))"


def tags(x: str) -> str:
    return f"list_sort(regexp_extract_all({x}, '<[^>]+>'))"


def strip_html(x: str) -> str:
    return trim(f"regexp_replace({x}, '<[^>]+>', '', 'g')")


def fold(x: str) -> str:
    return f"lower(strip_accents({x}))"


PAIRS = "pairs as (select row_id as line_no, coalesce(src, '') as src, coalesce(tgt, '') as tgt from test)"
LINES = "lines as (select doc_id * 100000 + i as line_no, part as text from (select doc_id, unnest(string_split(text, chr(10))) as part, generate_subscripts(string_split(text, chr(10)), 1) - 1 as i from documents where text is not null))"

"""Queries of positional and keyed joins, row edits, records in JSON and other source operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hablon.operators import edit, keyed
from hablon.plans.corpus_queries import pairs
from hablon.plans.sqltext import PAIRS, trim
from hablon.session import table
from hablon.sources import readers


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both files of each pair of files, blank lines left out and the rest numbered anew."""
    p = table(spark, sf, "paired_lines")
    out = []
    for c in ("src", "tgt"):
        filled = p.where(F.trim(F.coalesce(c, F.lit(""))) != "").select("file_id", F.col("line_no").alias("old"), F.col(c).alias("text"))
        out.append(filled.withColumn("line_no", F.row_number().over(Window.partitionBy("file_id").orderBy("old"))).drop("old"))
    return out[0], out[1]


def join_zip_truncate(spark, sf):
    return keyed.zip_truncate(*sides(spark, sf), "file_id")


def join_zip_pad(spark, sf):
    return keyed.zip_pad(*sides(spark, sf), "file_id")


def join_numbered(spark, sf):
    t = table(spark, sf, "test").select("row_id", "split")
    return keyed.numbered(t, "row_id").select("row_id", F.col("line_no").cast("long").alias("line_no"))


def verses(spark, sf):
    """Two versions keyed alike: the lines of all orders, and those of the documents of all orders."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("book"), F.col("l_linenumber").cast("int").alias("verse"), F.col("l_returnflag").alias("text"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("book"), F.lit(1).alias("verse"), F.col("o_orderstatus").alias("text")), li


def join_aligned(spark, sf):
    return keyed.aligned(*verses(spark, sf), "book", "verse")


def join_merge_new(spark, sf):
    return keyed.merge_new(*verses(spark, sf), "book", "verse")


def join_overlay(spark, sf):
    p = pairs(spark, sf)
    edits = p.where("line_no % 7 = 0").select("line_no", F.upper("src").alias("src"))
    return keyed.overlay(p, edits, "line_no", "src")


def join_upsert(spark, sf):
    p = pairs(spark, sf)
    changes = p.where("line_no % 9 = 0").select((F.col("line_no") + 5).alias("line_no"), F.lit("new").alias("src"), "tgt")
    return keyed.upsert(p, changes, "line_no")


def join_incomplete(spark, sf):
    t = table(spark, sf, "paired_lines")
    expected = t.groupBy("file_id").agg(F.max("line_no").cast("long").alias("n"))
    return keyed.incomplete(t.where("tgt <> ''"), expected, "file_id", "line_no", "n")


def rows(spark, sf):
    """The pairs with a dense position from 0."""
    t = table(spark, sf, "test").select("row_id", F.coalesce("src", F.lit("")).alias("src"), F.coalesce("tgt", F.lit("")).alias("tgt"))
    return keyed.numbered(t, "row_id").withColumn("position", (F.col("line_no") - 1).cast("long")).drop("line_no")


CHOSEN = [2, 3, 7, 9, 10, 11, 40]


def edit_update_cell(spark, sf):
    return edit.update_cell(rows(spark, sf), 5, "src", "edited")


def edit_delete_rows(spark, sf):
    return edit.delete_rows(rows(spark, sf), CHOSEN).select("row_id", "position")


def edit_delete_many(spark, sf):
    gone = rows(spark, sf).where(F.length("src") % 7 == 0).select("position")
    return edit.delete_many(rows(spark, sf), gone).select("row_id", "position")


def edit_replace_one(spark, sf):
    return edit.replace_one(rows(spark, sf), 3, "src", 2, 6, "<one>").select("row_id", "src")


def edit_move_up(spark, sf):
    return edit.move_rows(rows(spark, sf), CHOSEN, True).select("row_id", "position")


def edit_move_down(spark, sf):
    return edit.move_rows(rows(spark, sf), CHOSEN, False).select("row_id", "position")


def edit_insert_blank(spark, sf):
    return edit.insert_blank(rows(spark, sf), 4).select("row_id", "position", "src")


def edit_append_blank(spark, sf):
    return edit.append_blank(rows(spark, sf)).select("row_id", "position")


def edit_page(spark, sf):
    return edit.page(rows(spark, sf), 2, 50).select("row_id", "position")


def edit_search(spark, sf):
    return edit.search(rows(spark, sf), ["src", "tgt"], "Balay").select("row_id")


def edit_replace_all(spark, sf):
    return edit.replace_all(rows(spark, sf), ["src", "tgt"], "[aeiou]{2}", "<$0>").select("row_id", "src", "tgt")


def collections(spark, sf):
    t = table(spark, sf, "test")
    inside = F.row_number().over(Window.partitionBy("source").orderBy("row_id")) - 1
    return t.select("source", inside.cast("long").alias("position"), F.create_map(F.lit("src"), F.col("src"), F.lit("tgt"), F.col("tgt")).alias("data"))


def collection_next_position(spark, sf):
    return edit.next_position(collections(spark, sf), "source")


def collection_import(spark, sf):
    new = table(spark, sf, "documents").select(F.lit("news_pairs").alias("source"), "doc_id", F.create_map(F.lit("src"), F.col("source")).alias("data"))
    out = edit.import_rows(collections(spark, sf), new, "source", "doc_id")
    return out.select("source", "position", F.coalesce(F.element_at("data", "src"), F.lit("")).alias("src"))


def collection_row_counts(spark, sf):
    d = collections(spark, sf)
    names = d.select("source").distinct().unionByName(spark.range(1).select(F.lit("unused").alias("source")))
    return edit.row_counts(d, names, "source")


def collection_delete(spark, sf):
    d = collections(spark, sf)
    gone = d.groupBy("source").agg(F.count("*").alias("n")).where("n > 400").select("source")
    return edit.delete_collection(d, gone, "source").select("source", "position")


def collection_export(spark, sf):
    d = collections(spark, sf).where("source = 'news_pairs'")
    return edit.export(d, ["tgt", "src", "none"])


def collection_columns(spark, sf):
    return edit.map_columns(rows(spark, sf), {"hil": "tgt"}, ["SRC", "hil", "note"])


def json_lines(spark, sf):
    """Records made of the pairs: several targets, one as a bare string, broken and incomplete ones among them."""
    p = pairs(spark, sf)
    q = F.to_json(F.struct(F.col("src"), F.array("tgt", F.upper("tgt")).alias("trgs")))
    one = F.to_json(F.struct(F.col("src"), F.col("tgt").alias("trgs")))
    n = F.col("line_no") % 11
    return p.select("line_no", F.when(n == 0, F.substring(q, 1, 20)).when(n == 1, one).when(n == 2, F.lit("  ")).when(n == 3, F.lit('{"src": "x"}')).when(n == 4, F.lit("[1]")).otherwise(q).alias("text"))


def source_json_pairs(spark, sf):
    return readers.json_records(json_lines(spark, sf))[0].select("line_no", "src", "tgt")


def source_json_first(spark, sf):
    return readers.json_records(json_lines(spark, sf), all_targets=False)[0].select("line_no", "src", "tgt")


def source_json_invalid(spark, sf):
    return readers.json_records(json_lines(spark, sf))[1].select("line_no")


def source_json_props(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").cast("long").alias("k"))


def tab_text(spark, sf):
    p = pairs(spark, sf)
    return p.select("line_no", F.when(F.col("line_no") % 5 == 0, F.col("src")).otherwise(F.concat_ws("\t", F.regexp_replace("src", "\\s+", " "), F.regexp_replace("tgt", "\\s+", " "), F.lit(""))).alias("text"))


def source_tab_lines(spark, sf):
    return readers.tab_lines(tab_text(spark, sf)).select("line_no", F.size("cells").cast("long").alias("n"), F.col("cells")[0].alias("first"))


def source_second_column(spark, sf):
    return readers.second_column(tab_text(spark, sf))


def set_operations(spark, sf):
    """Intersection and difference of the texts of both sides, by distinct value."""
    p = pairs(spark, sf)
    a, b = p.select(F.lower("src").alias("t")), p.select(F.lower("tgt").alias("t"))
    both, only = keyed.intersection(a, b), keyed.difference(a, b)
    return both.select(F.lit("both").alias("kind"), "t").unionByName(only.select(F.lit("src").alias("kind"), "t")).groupBy("kind").agg(F.count("*").alias("n"))


QUERIES = (
    join_zip_truncate, join_zip_pad, join_numbered, join_aligned, join_merge_new, join_overlay, join_upsert, join_incomplete, edit_update_cell, edit_delete_rows, edit_delete_many, edit_replace_one,
    edit_move_up, edit_move_down, edit_insert_blank, edit_append_blank, edit_page, edit_search, edit_replace_all, collection_next_position, collection_import,
    collection_row_counts, collection_delete, collection_export, collection_columns, source_json_pairs, source_json_first, source_json_invalid, source_json_props,
    source_tab_lines, source_second_column, set_operations,
)


def queries():
    return {f.__name__: f for f in QUERIES}


_SIDES = ", ".join(f"{n} as (select file_id, row_number() over (partition by file_id order by line_no) line_no, {c} as text from paired_lines where trim(coalesce({c}, ''), ' ') <> '')" for n, c in (("a", "src"), ("b", "tgt")))
_ROWS = "r as (select row_id, coalesce(src, '') as src, coalesce(tgt, '') as tgt, row_number() over (order by row_id) - 1 as position from test)"
_IN = "(" + ", ".join(map(str, CHOSEN)) + ")"
_DATA = "d as (select source, row_number() over (partition by source order by row_id) - 1 as position, src, tgt from test)"
_V = "v1 as (select o_orderkey book, 1 verse, o_orderstatus as text from orders), v2 as (select l_orderkey book, cast(l_linenumber as int) verse, l_returnflag as text from lineitem)"


def _move(up: bool) -> str:
    """Expected positions by the rule of contiguous runs: the edge row of each run changes places with its neighbour."""
    step = -1 if up else 1
    edges = [r for r in CHOSEN if r + step not in CHOSEN and r + step >= 0]
    cases = " ".join(f"when {r} then {r + step} when {r + step} then {r}" for r in edges)
    return f"with {_ROWS} select row_id, case position {cases} else position end as position from r"


def oracle_sql() -> dict[str, str]:
    ok = f"j as (select line_no, {trim('src')} s, {trim('tgt')} t, line_no % 11 n from pairs)"
    return {
        "join_zip_truncate": f"with {_SIDES} select file_id, line_no, a.text as src, b.text as tgt from a join b using (file_id, line_no)",
        "join_zip_pad": f"with {_SIDES} select file_id, line_no, coalesce(a.text, '') as src, coalesce(b.text, '') as tgt from a full join b using (file_id, line_no)",
        "join_numbered": "select row_id, row_number() over (order by row_id) as line_no from test",
        "join_aligned": f"with {_V} select book, verse, v1.text as src, v2.text as tgt from v1 join v2 using (book, verse)",
        "join_merge_new": f"with {_V} select * from v1 union all select * from v2 where not exists (select 1 from v1 where v1.book = v2.book and v1.verse = v2.verse)",
        "join_overlay": f"with {PAIRS} select line_no, case when line_no % 7 = 0 then upper(src) else src end as src, tgt from pairs",
        "join_upsert": f"with {PAIRS}, c as (select line_no + 5 as line_no, 'new' as src, tgt from pairs where line_no % 9 = 0) select * from pairs where line_no not in (select line_no from c) union all select * from c",
        "join_incomplete": "with e as (select file_id, cast(max(line_no) as bigint) n from paired_lines group by file_id), h as (select file_id, count(distinct line_no) have from paired_lines where tgt <> '' group by file_id) select file_id, n, coalesce(have, 0) as have from e left join h using (file_id) where coalesce(have, 0) < n",
        "edit_update_cell": f"with {_ROWS} select row_id, case when position = 5 then 'edited' else src end as src, tgt, position from r",
        "edit_delete_rows": f"with {_ROWS} select row_id, row_number() over (order by position) - 1 as position from r where position not in {_IN}",
        "edit_delete_many": f"with {_ROWS} select row_id, row_number() over (order by position) - 1 as position from r where length(src) % 7 <> 0",
        "edit_replace_one": f"with {_ROWS} select row_id, case when position = 3 then left(src, 2) || '<one>' || substr(src, 7) else src end as src from r",
        "edit_move_up": _move(True),
        "edit_move_down": _move(False),
        "edit_insert_blank": f"with {_ROWS} select row_id, case when position >= 5 then position + 1 else position end as position, src from r union all select null, 5, ''",
        "edit_append_blank": f"with {_ROWS} select row_id, position from r union all select null, count(*) from r",
        "edit_page": f"with {_ROWS} select row_id, position from r order by position limit 50 offset 100",
        "edit_search": f"with {_ROWS} select row_id from r where contains(lower(src), 'balay') or contains(lower(tgt), 'balay')",
        "edit_replace_all": rf"with {_ROWS} select row_id, regexp_replace(src, '([aeiou]{{2}})', '<\1>', 'g') as src, regexp_replace(tgt, '([aeiou]{{2}})', '<\1>', 'g') as tgt from r",
        "collection_next_position": f"with {_DATA} select source, max(position) + 1 as next from d group by source",
        "collection_import": f"with {_DATA} select source, position, coalesce(src, '') as src from d union all select 'news_pairs', row_number() over (order by doc_id) - 1 + (select count(*) from d where source = 'news_pairs'), coalesce(source, '') from documents",
        "collection_row_counts": "select source, count(*) as n from test group by source union all select 'unused', 0",
        "collection_delete": f"with {_DATA}, k as (select source from d group by source having count(*) > 400) select source, position from d where source not in (select source from k)",
        "collection_export": f"with {_DATA} select -1 as position, 'tgt' || chr(9) || 'src' || chr(9) || 'none' as line union all select position, coalesce(tgt, '') || chr(9) || coalesce(src, '') || chr(9) from d where source = 'news_pairs'",
        "collection_columns": f"with {_ROWS} select position, src as SRC, tgt as hil, '' as note from r",
        "source_json_pairs": f"with {PAIRS}, {ok} select line_no, s as src, t as tgt from j where n = 1 and s <> '' and t <> '' union all select line_no, s, unnest([t, upper(t)]) from j where n > 4 and s <> '' and t <> ''",
        "source_json_first": f"with {PAIRS}, {ok} select line_no, s as src, t as tgt from j where (n = 1 or n > 4) and s <> '' and t <> ''",
        "source_json_invalid": f"with {PAIRS} select line_no from pairs where line_no % 11 in (0, 3, 4)",
        "source_json_props": "select event_id, cast(props ->> '$.k' as bigint) as k from events",
        "source_tab_lines": rf"with {PAIRS}, t as (select line_no, case when line_no % 5 = 0 then src else regexp_replace(src, '[ \t\n\x0b\f\r]+', ' ', 'g') || chr(9) || regexp_replace(tgt, '[ \t\n\x0b\f\r]+', ' ', 'g') || chr(9) end x from pairs), u as (select line_no, regexp_replace(x, '[\p{{Z}}\t\n\x0b\f\r\x{{85}}]+$', '') x from t where x <> '') select line_no, len(string_split(x, chr(9))) as n, string_split(x, chr(9))[1] as first from u where x <> ''",
        "source_second_column": rf"with {PAIRS}, t as (select line_no, string_split(case when line_no % 5 = 0 then src else regexp_replace(src, '[ \t\n\x0b\f\r]+', ' ', 'g') || chr(9) || regexp_replace(tgt, '[ \t\n\x0b\f\r]+', ' ', 'g') || chr(9) end, chr(9)) c from pairs), u as (select line_no, {trim('c[2]')} as text from t where len(c) >= 2 and line_no > 1) select * from u where text <> ''",
        "set_operations": f"with {PAIRS}, a as (select distinct lower(src) t from pairs), b as (select distinct lower(tgt) t from pairs) select * from (select 'both' as kind, count(*) as n from a where t in (select t from b) union all select 'src', count(*) from a where t not in (select t from b)) where n > 0",
    }

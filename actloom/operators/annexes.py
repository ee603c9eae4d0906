"""Annexes of a page, and annexes of an amending act put into a document."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from actloom.functions import classify as C
from actloom.functions import text as X
from actloom.operators import preamble, revise
from actloom.operators.structure import has
from actloom.runtime import partitions, written

T = "text_fn"


def cell_texts(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, parent_pos, text, is_header): every table cell; its direct paragraphs on lines of their own, else the whole text."""
    cells = elements.where("tag in ('td', 'th')").select("doc_id", "pos", "parent_pos", F.col(T).alias("whole"), ((F.col("tag") == "th") | has("oj-tbl-hdr")).alias("is_header"))
    inner = elements.where("tag in ('p', 'div')").where(X.clean(F.col(T)) != "").select("doc_id", F.col("parent_pos").alias("pos"), F.struct("pos", F.col(T).alias("t")).alias("l"))
    lines = inner.groupBy("doc_id", "pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list("l")), lambda x: x["t"]), "\n").alias("lines"))
    direct = elements.where("tag in ('p', 'div')").select("doc_id", F.col("parent_pos").alias("pos"), F.lit(True).alias("has")).distinct()
    got = cells.join(lines, ["doc_id", "pos"], "left").join(direct, ["doc_id", "pos"], "left")
    return got.select("doc_id", "pos", "parent_pos", F.when(F.col("has"), F.coalesce("lines", F.lit(""))).otherwise(F.col("whole")).alias("text"), "is_header")


def _sizes(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, end_pos, rows, cells, is_styled) of every table, its rows and cells at any depth, from running counts
    (no interval join)."""
    upto = Window.partitionBy("doc_id").orderBy("pos")
    n = lambda *tags: F.sum(F.col("tag").isin(*tags).cast("int")).over(upto)
    run = elements.select("doc_id", "pos", "end_pos", "tag", has("oj-table").alias("is_styled")).withColumns({"r": n("tr"), "c": n("td", "th")})
    ends = run.select("doc_id", F.col("pos").alias("end_pos"), F.col("r").alias("r2"), F.col("c").alias("c2"))
    return run.where("tag = 'table'").join(ends, ["doc_id", "end_pos"]).select("doc_id", "pos", "end_pos", (F.col("r2") - F.col("r")).alias("rows"), (F.col("c2") - F.col("c")).alias("cells"), "is_styled")


def largest_tables(elements: DataFrame) -> DataFrame:
    """(doc_id, box, pos, end_pos, rows, cells): the largest table of each annex container by ten times its rows and its cells;
    styled tables come before others, the first of equals."""
    inside = _sizes(elements).join(preamble.boxes(elements, "anx").select("doc_id", "box", "lo", "hi"), "doc_id").where("pos > lo and pos <= hi")
    best = inside.groupBy("doc_id", "box").agg(F.max_by(F.struct("pos", "end_pos", "rows", "cells"), F.struct("is_styled", F.col("rows") * 10 + F.col("cells"), -F.col("pos"))).alias("m"))
    return best.select("doc_id", "box", "m.*")


def nearest_containers(elements: DataFrame, heads: DataFrame) -> DataFrame:
    """(doc_id, pos, container): the closest container of class eli-subdivision around each heading (doc_id, pos), a heading that is one itself included."""
    box = elements.where(has("eli-subdivision")).select("doc_id", F.col("pos").alias("lo"), F.col("end_pos").alias("hi"))
    got = heads.select("doc_id", "pos").join(box, "doc_id").where("lo <= pos and pos <= hi").groupBy("doc_id", "pos").agg(F.max("lo").alias("container"))
    return heads.select("doc_id", "pos").join(got, ["doc_id", "pos"], "left")


def emitted(elements: DataFrame) -> DataFrame:
    """(doc_id, box, ord, text, left_cm, first_line_cm): the lines of each annex container as they are laid out.

    Direct children decide: an enumeration gives its heading, its body lines and its table rows, a table its rows, a plain
    paragraph itself; the annex heading gives none.  Rows are cells set apart by tabs.
    """
    box = preamble.boxes(elements, "anx").select("doc_id", "box", F.col("lo").alias("up"))
    t = X.clean(F.col(T))
    kids = elements.join(box.withColumnRenamed("up", "parent_pos"), ["doc_id", "parent_pos"]).where(t != "").where(~((F.col("tag") == "p") & has("oj-doc-ti")))
    kids = kids.withColumn("kind", F.when((F.col("tag") == "div") & has("oj-enumeration-spacing"), "list").when(F.col("tag") == "table", "table").when((F.col("tag") == "p") & has("oj-normal"), "line")).where("kind is not null")
    lists = kids.where("kind = 'list'").select("doc_id", "box", F.col("pos").alias("list_pos"), t.alias("whole"))
    parts = elements.where("tag <> 'table'").where(t != "").select("doc_id", F.col("parent_pos").alias("list_pos"), "pos", t.alias("t"), has("oj-normal").alias("is_body")).join(lists, ["doc_id", "list_pos"])
    heading = parts.where("not is_body").groupBy("doc_id", "list_pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ").alias("h"))
    none = parts.groupBy("doc_id", "list_pos").agg(F.max("is_body").alias("bodies"))
    heads = lists.join(heading, ["doc_id", "list_pos"], "left").join(none, ["doc_id", "list_pos"], "left").where("h is not null or bodies is null")
    line = lambda df, pos, text, left, first: df.select("doc_id", "box", F.col(pos).alias("pos"), text.alias("text"), F.lit(left).alias("left_cm"), F.lit(first).alias("first_line_cm"))
    out = line(heads, "list_pos", X.marker_spacing(F.coalesce("h", "whole"), True), 1, -1)
    out = out.unionByName(line(parts.where("is_body"), "pos", F.col("t"), 1, 0)).unionByName(line(kids.where("kind = 'line'"), "pos", t, 0, 0))
    tables = kids.where("kind = 'table'").select("doc_id", "box", "pos", "end_pos", F.lit(False).alias("spaced"))
    inner = elements.where("tag = 'table'").select("doc_id", F.col("parent_pos").alias("list_pos"), "pos", "end_pos").join(lists.select("doc_id", "list_pos", "box"), ["doc_id", "list_pos"]).select("doc_id", "box", "pos", "end_pos", F.lit(True).alias("spaced"))
    rows = _row_texts(elements).join(tables.unionByName(inner).withColumnsRenamed({"pos": "lo", "end_pos": "hi"}), "doc_id").where("tr_pos > lo and tr_pos <= hi")
    rows = rows.withColumn("t", F.array_join("cells", "\t")).withColumn("t", F.when(F.col("spaced"), X.marker_spacing(F.col("t"), True)).otherwise(F.col("t")))
    out = out.unionByName(line(rows, "tr_pos", F.col("t"), 2, -1))
    return out.select("doc_id", "box", F.row_number().over(Window.partitionBy("doc_id", "box").orderBy("pos", "text")).alias("ord"), "text", "left_cm", "first_line_cm")


def _row_texts(elements: DataFrame) -> DataFrame:
    """(doc_id, tr_pos, cells, is_header) of the table rows that hold text, empty cells left out."""
    cells = cell_texts(elements).where("text <> ''").select("doc_id", F.col("parent_pos").alias("tr_pos"), F.struct("pos", F.col("text").alias("t")).alias("c"), "is_header")
    return cells.groupBy("doc_id", "tr_pos").agg(F.transform(F.sort_array(F.collect_list("c")), lambda x: x["t"]).alias("cells"), F.max("is_header").alias("is_header"))


def structured_tables(elements: DataFrame) -> DataFrame:
    """(doc_id, box, ord, left, right, is_header): annexes that are a titled table as rows of two columns, the largest table of each."""
    titled = elements.where((F.col("tag") == "p") & has("oj-ti-tbl")).select("doc_id", F.col("pos").alias("tp"))
    t = largest_tables(elements).select("doc_id", "box", "pos", "end_pos")
    box = preamble.boxes(elements, "anx").select("doc_id", "box", "lo", "hi").join(titled, "doc_id").where("tp > lo and tp <= hi").select("doc_id", "box").distinct()
    rows = _row_texts(elements).join(t.join(box, ["doc_id", "box"]), "doc_id").where("tr_pos > pos and tr_pos <= end_pos")
    ord_ = F.row_number().over(Window.partitionBy("doc_id", "box").orderBy("tr_pos"))
    return rows.select("doc_id", "box", ord_.alias("ord"), F.get("cells", F.lit(0)).alias("left"), F.array_join(F.slice("cells", 2, F.size("cells")), "\n").alias("right"), "is_header")


# into a document -----------------------------------------------------------------------------------------------------

_HEAD = re.compile(r"[IVXLC]+\.(?=\s|$)", re.IGNORECASE)
_MARK = re.compile(r"[‘'\"]?\d+[A-Za-z]?\.")
_POINT = re.compile(r"\([a-z]+\)", re.IGNORECASE)
CHANGED = f"doc_id string, label string, anchor bigint, nth int, text string, runs {revise.RUNS}, left_cm int, first_line_cm int"


def levels(lines: list[str]) -> list[tuple[int, int]]:
    """(left_cm, first_line_cm) of the body lines of an inserted annex: sections 1, numbers 2, points by the first of their
    series, other lines as what they stand under."""
    out, now, body, points, was_point = [], 1, 1, None, False
    for t in lines:
        section, point = bool(_HEAD.match(t)), bool(_POINT.match(t))
        number = bool(_MARK.match(t)) and not section
        if section or number:
            now = body = 1 if section else 2
            points, was_point = None, False
        elif point:
            points = points or (3 if now >= 2 else 2)
            now, was_point = points, True
        else:
            if was_point and re.match("[A-Z]", t):
                now = max(1, body)
            body, was_point = now, False
        out.append((now, -1 if section or number or point else 0))
    return out


def _run(text: str, kind: str, color: str | None) -> dict:
    return {"text": text, "kind": kind, "strike": kind == "delete", "double_underline": kind == "insert", "color": color}


SENT = 4096  # lines that are sent on together


def _changed(doc: str, label: str, old: list[tuple], new: list[tuple], color: str) -> Iterator[tuple]:
    """The lines of one annex, from those that stand and the new ones (ord, text, kind, value, runs)."""
    if not old:
        lines = [r[1] for r in new]
        for n, (t, at) in enumerate(zip(lines, [(0, 0), *levels(lines[1:])], strict=True)):
            yield doc, label, None, n, t, [_run(t, "insert", color)], *at
        return
    held = {r[0]: r[4] for r in old}
    for n, (action, anchor, was, text) in enumerate(revise.actions([r[:4] for r in old], [r[:4] for r in new])):
        kept = [dict(x) for x in held[anchor]] if held.get(anchor) else [_run(was or "", "equal", None)]
        if action == "equal":
            text, runs = was, kept
        elif action == "delete":
            text, runs = "", [x | {"strike": True, "color": color, "kind": "delete"} for x in kept]
        elif action == "insert":
            runs = [_run(text, "insert", color)]
        else:
            runs = [x for x in kept if x["strike"]] + revise.revision(was, text, color)
        # an insertion goes before its anchor
        yield doc, label, anchor, n if action == "insert" else 10**6 + n, text, runs, None, None


def _change(color: str, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The lines of many annexes, one annex behind the other, those that stand before the new ones."""
    batch = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * len(schema), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("doc_id", "label", "side", "ord", "text", "kind", "value", "runs")], strict=True))
        out: list[tuple] = []
        for (doc, label), own in groupby(rows, lambda r: r[:2]):
            sides: tuple[list, list] = ([], [])
            for r in own:
                sides[r[2]].append(r[3:])
            for got in _changed(doc, label, *sides, color) if sides[1] else ():
                out.append(got)
                if len(out) >= SENT:
                    yield batch(out)
                    out = []
        yield batch(out)

    return run


def with_annexes(paragraphs: DataFrame, changes: DataFrame, color: str) -> DataFrame:
    """(doc_id, ord, text, runs): ``paragraphs`` (the same columns) with the annexes of ``changes`` (doc_id, annex_label, mode, ord, text).

    An annex that is replaced is aligned line by line with the one that stands; one that is not there yet comes behind the
    annex its letter belongs to, else behind the last one.  An added annex that is there already changes nothing.  The unit
    of the fold is one annex of one document.
    """
    label = C.annex_label(F.col("text"))
    turn = F.when(label.isNotNull(), F.struct(label.alias("l"))).when(C.chapter_number(F.col("text")).isNotNull() | C.article_number(F.col("text")).isNotNull(), F.struct(F.lit(None).cast("string").alias("l")))
    w = Window.partitionBy("doc_id").orderBy("ord")
    lines = paragraphs.select("doc_id", F.col("ord").cast("bigint").alias("ord"), "text", "runs").withColumn("label", F.last(turn, ignorenulls=True).over(w)["l"])
    ends = lines.where("label is not null").groupBy("doc_id", "label").agg(F.max("ord").alias("end"))
    new = changes.select("doc_id", F.upper("annex_label").alias("label"), "mode", "ord", X.clean(F.col("text")).alias("text")).where("text <> ''")
    new = new.join(ends.select("doc_id", "label", F.lit(True).alias("there")), ["doc_id", "label"], "left").where("mode = 'replace' or there is null")
    keyed = lambda df: revise.contextual_keys(df.withColumn("own", F.col("doc_id")).withColumn("doc_id", F.concat_ws(":", "doc_id", "label"))).withColumn("doc_id", F.col("own")).drop("own")
    spaced = preamble.comparable_annex_lines(new.select(F.concat_ws("\u0001", "doc_id", "label").alias("doc_id"), "ord", "text"))
    spaced = spaced.select(F.substring_index("doc_id", "\u0001", 1).alias("doc_id"), F.substring_index("doc_id", "\u0001", -1).alias("label"), "ord", "text")
    old = keyed(lines.join(new.select("doc_id", "label").distinct(), ["doc_id", "label"], "left_semi").select("doc_id", "label", "ord", "text", "runs"))
    side = lambda df, n, runs: df.select("doc_id", "label", F.lit(n).alias("side"), F.col("ord").cast("bigint").alias("ord"), "text", "kind", "value", runs.cast(revise.RUNS).alias("runs"))
    # most annexes are a few lines, for which a group each costs more than the work on it: they are sorted and folded as they come
    unit, schema = ("doc_id", "label"), paragraphs.sparkSession.createDataFrame([], CHANGED).schema
    rows = side(old, 0, F.col("runs")).unionByName(side(keyed(spaced), 1, F.lit(None))).repartition(4 * partitions(paragraphs.sparkSession), *unit).sortWithinPartitions(*unit, "side", "ord")
    done = written(rows.mapInArrow(_change(color, to_arrow_schema(schema)), schema), "annexes")
    base = F.when(~F.col("label").rlike("^[IVXLC]+$"), F.regexp_extract("label", r"^([IVXLC]+)[A-Z]$", 1))
    last = ends.groupBy("doc_id").agg(F.max("end").alias("last"))
    size = lines.groupBy("doc_id").agg(F.max("ord").alias("size"))
    at = done.withColumn("base", base).join(ends.withColumnsRenamed({"label": "base", "end": "base_end"}), ["doc_id", "base"], "left").join(ends, ["doc_id", "label"], "left").join(last, "doc_id", "left").join(size, "doc_id", "left")
    behind = F.coalesce("end", "base_end", "last", "size", F.lit(0))
    rows = at.select("doc_id", F.coalesce("anchor", behind).cast("double").alias("at"), F.when(F.col("anchor").isNull(), F.col("nth") + 3 * 10**6).otherwise(F.col("nth")).alias("k"), "label", "text", "runs")
    kept = lines.join(done.where("anchor is not null").select("doc_id", "label").distinct(), ["doc_id", "label"], "left_anti")
    rows = rows.unionByName(kept.select("doc_id", F.col("ord").cast("double").alias("at"), F.lit(2 * 10**6).alias("k"), "label", "text", "runs"))
    return rows.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("at", "k", "label")) - 1).alias("ord"), "text", "runs")

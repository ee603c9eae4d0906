"""The typed parts of an act from its element rows: joins on intervals and windows in document order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import text as X


def order():  # noqa: ANN201
    """Document order; made when used, as a window needs a session."""
    return Window.partitionBy("doc_id").orderBy("pos")


#: title of a page without one (a fixed value)
UNTITLED = "Untitled EUR-Lex document"
#: classes whose text is metadata, and what is always told of a page (fixed values)
METADATA = {"oj-hd-oj": "official_journal", "oj-hd-date": "oj_date", "oj-hd-lg": "language"}


def source_id() -> Column:
    return F.coalesce(*[F.nullif(F.try_element_at(F.col("attrs"), F.lit(a)), F.lit("")) for a in ("id", "name", "eid", "xml:id")])


def has(*names: str) -> Column:
    return C.has_any(F.col("classes"), names)


def legal_root(elements: DataFrame) -> DataFrame:
    """(doc_id, root_pos, root_end): the container with the most legal matter, else the body, else the first element; the first of equals."""
    weight = sum((F.when(has(c), w).otherwise(0) for c, w in (("oj-ti-art", 100), ("eli-main-title", 25), ("eli-title", 10), ("oj-normal", 1), ("oj-table", 5), ("oj-note", 2))), F.lit(0))
    # what stands in a container is the difference of two running sums, at its end and at itself
    run = elements.select("doc_id", "pos", "end_pos", has("eli-container").alias("box"), F.sum(weight).over(order()).alias("w"))
    ends = run.select("doc_id", F.col("pos").alias("end_pos"), F.col("w").alias("upto"))
    scored = run.where("box").join(ends, ["doc_id", "end_pos"]).select("doc_id", F.col("pos").alias("root_pos"), F.col("end_pos").alias("root_end"), (F.col("upto") - F.col("w")).alias("score"))
    best = scored.groupBy("doc_id").agg(F.max_by(F.struct("root_pos", "root_end"), F.struct("score", -F.col("root_pos"))).alias("r")).select("doc_id", "r.*")
    rest = elements.groupBy("doc_id").agg(F.min_by(F.struct("pos", "end_pos"), F.struct(F.col("tag") != "body", "pos")).alias("f"), F.max("pos").alias("last"), F.max((F.col("tag") == "body").cast("int")).alias("body"))
    joined = rest.join(best, "doc_id", "left")
    return joined.select("doc_id", F.coalesce("root_pos", F.col("f.pos") - F.when(F.col("body") == 1, 0).otherwise(1)).alias("root_pos"), F.coalesce("root_end", F.when(F.col("body") == 1, F.col("f.end_pos")).otherwise(F.col("last"))).alias("root_end"))


def legal_stream(elements: DataFrame, root: DataFrame) -> DataFrame:
    """Legal elements below the root in document order with their 1-based place ``i`` and markup text ``t``."""
    below = elements.where(C.is_legal_element(F.col("classes")) & C.is_emitted(F.col("classes"))).join(root, "doc_id").where("pos > root_pos and pos <= root_end")
    kept = below.withColumn("t", X.once(X.clean_markup(F.col("text")))).where((F.col("t") != "") | has(*C.TABLE))
    return kept.withColumn("i", F.row_number().over(order()))


def footnotes(elements: DataFrame, root: DataFrame) -> DataFrame:
    """(doc_id, ord, note_id, marker, text) of the notes not nested in another, the first of equal ones."""
    notes = elements.join(root, "doc_id").where(has("oj-note") & (F.col("pos") > F.col("root_pos")) & (F.col("pos") <= F.col("root_end"))).withColumn("idx", F.row_number().over(order()))
    outer = F.max("end_pos").over(order().rowsBetween(Window.unboundedPreceding, -1))
    top = notes.withColumn("outer", outer).where("outer is null or outer < pos")
    # each tag belongs to the last outer note that begins before it, if it still stands in it
    open_ = F.when(F.col("is_note") & ((F.col("over").isNull()) | (F.col("over") < F.col("pos"))), F.struct("pos", "end_pos"))
    marks = elements.where(has("oj-note", "oj-note-tag")).withColumns({"is_note": has("oj-note"), "is_tag": has("oj-note-tag")}).withColumn("over", F.max(F.when(F.col("is_note"), F.col("end_pos"))).over(order().rowsBetween(Window.unboundedPreceding, -1)))
    marks = marks.withColumn("note", F.last(open_, ignorenulls=True).over(order())).where("is_tag and pos > note.pos and pos <= note.end_pos")
    first = marks.groupBy("doc_id", F.col("note.pos").alias("pos")).agg(F.min_by("text", "pos").alias("label"))
    tagged = top.join(first, ["doc_id", "pos"], "left").select("doc_id", "pos", "idx", "text", source_id().alias("sid"), F.col("label").alias("tag"))
    marker = F.when(F.col("tag").isNotNull(), X.clean_markup(F.col("tag"))).otherwise(F.col("idx").cast("string"))
    body = F.when(F.col("tag").isNotNull() & F.startswith("text", F.col("tag")), F.expr("substring(text, length(tag) + 1)")).otherwise(F.col("text"))
    rows = tagged.select("doc_id", "pos", marker.alias("marker"), X.clean_markup(body).alias("text"), "sid", "idx").withColumn("note_id", F.coalesce("sid", F.concat(F.lit("note_"), F.when(F.col("marker") != "", F.col("marker")).otherwise(F.col("idx").cast("string")))))
    once = rows.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "note_id", "marker", "text").orderBy("pos"))).where("r = 1")
    return once.select("doc_id", F.row_number().over(order()).alias("ord"), "note_id", "marker", "text")


def footnote_bodies(elements: DataFrame) -> DataFrame:
    """(doc_id, number, body): note text by number; the last of a number wins."""
    n = C.found(X.clean(F.col("text")), r"^\(?\s*(\d+)")
    notes = elements.where(has("oj-note") & (F.col("tag") == "p")).select("doc_id", "pos", n.alias("number"), X.footnote_body(F.regexp_replace(X.clean(F.col("text")), r"^\(?\s*\d+\s*\)?\s*", "")).alias("body")).where("number is not null")
    return notes.groupBy("doc_id", "number").agg(F.max_by("body", "pos").alias("body"))


def recitals(stream: DataFrame) -> DataFrame:
    """The contiguous numbered run before the first article: begins at number 1, takes each next number, ends at a gap; lower numbers are skipped."""
    first = F.min(F.when(has("oj-ti-art"), F.col("i"))).over(Window.partitionBy("doc_id"))
    n = C.found(F.col("t"), r"(?sU)^\s*\(?\s*(\d{1,3})\s*\)?\s+.*").cast("int")
    rows = stream.withColumn("first", first).where("first is not null and i < first").where(has("oj-normal")).withColumn("n", n).where("n is not null")
    upto = order().rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("on", F.max((F.col("n") == 1).cast("int")).over(upto)).where("on = 1")
    rows = rows.withColumn("top", F.coalesce(F.max("n").over(order().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("gaps", F.sum((F.col("n") > F.col("top") + 1).cast("int")).over(upto)).where("gaps = 0 and n = top + 1")
    return rows.select("doc_id", F.concat(F.lit("recital_"), "n").alias("provision_id"), F.col("n").cast("string").alias("number"), F.col("t").alias("text"), "classes", source_id().alias("source_id"))


def sections(stream: DataFrame) -> DataFrame:
    rows = stream.where(C.is_section_heading(F.col("classes"), F.col("t")) & (F.col("t") != ""))
    pid = F.concat(F.lit("section_"), F.col("i"), F.lit("_"), F.substring(X.slug(F.col("t")), 1, 40))
    return rows.select("doc_id", pid.alias("provision_id"), F.substring_index("t", " ", 1).alias("label"), C.section_level(F.col("classes")).alias("level"), F.col("t").alias("text"), "classes", source_id().alias("source_id"))


def article_stream(stream: DataFrame) -> DataFrame:
    """The stream with the article it belongs to: from a heading to the next one or to a text that starts an annex."""
    head = has("oj-ti-art")
    upto = order().rowsBetween(Window.unboundedPreceding, 0)
    rows = stream.withColumn("k", F.sum(head.cast("int")).over(upto)).where("k > 0")
    own = Window.partitionBy("doc_id", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("ended", F.max((~head & F.col("t").rlike(C.ANNEX_START)).cast("int")).over(own)).where("ended = 0")
    heading = F.first(F.col("t")).over(own)
    number = F.coalesce(C.found(heading, r"(?iU)\bArticle\s+(\d+[A-Za-z]?)\b"), F.col("k").cast("string"))
    return rows.withColumn("heading", heading).withColumn("number", number).withColumn("is_head", head)


def articles(stream: DataFrame) -> DataFrame:
    """(doc_id, provision_id, number, heading, subtitle, source_id); the last subtitle counts."""
    rows = article_stream(stream)
    got = rows.groupBy("doc_id", "k", "number", "heading").agg(
        F.max_by("t", F.when(has("oj-sti-art") & (F.col("t") != "") & ~F.col("is_head"), F.col("pos"))).alias("subtitle"), F.first(F.when(F.col("is_head"), source_id()), ignorenulls=True).alias("source_id")
    )
    return got.select("doc_id", "k", F.concat(F.lit("article_"), X.slug(F.col("number"))).alias("provision_id"), "number", "heading", "subtitle", "source_id")


def article_blocks(stream: DataFrame) -> DataFrame:
    """(doc_id, k, provision_id, block_type, pos, text, role, classes, source_id) of the text blocks and tables of articles."""
    rows = article_stream(stream).where(~F.col("is_head") & ~has("oj-sti-art"))
    table = has(*C.TABLE) & ((F.col("tag") == "table") | has("oj-table"))
    text = ~has(*C.TABLE) & ~has(*C.NOTE) & has("oj-normal", "oj-enumeration-spacing") & (F.col("t") != "")
    rows = rows.withColumn("block_type", F.when(table, "table").when(text, "text")).where("block_type is not null")
    n = F.row_number().over(Window.partitionBy("doc_id", "k", "block_type").orderBy("pos"))
    pid = F.concat(F.lit("article_"), X.slug(F.col("number")), F.when(F.col("block_type") == "table", "_table_").otherwise("_block_"), n)
    role = F.when(F.col("block_type") == "text", C.block_role(F.col("t"), F.col("classes")))
    return rows.select("doc_id", "k", pid.alias("provision_id"), "block_type", "pos", F.col("t").alias("text"), role.alias("role"), "classes", source_id().alias("source_id"))


def annexes(elements: DataFrame) -> DataFrame:
    """(doc_id, k, provision_id, heading, pos, stop): short annex headings, once for each text; each ends at the next element that looks like a heading, whether it counts as one or not."""
    like = elements.withColumn("t", X.clean_markup(F.col("text"))).where(C.is_annex_heading(F.col("classes"), F.col("t")))
    like = like.withColumn("next", F.lead("pos").over(order()))
    first = like.where(F.length("t") <= 120).withColumn("r", F.row_number().over(Window.partitionBy("doc_id", F.upper("t")).orderBy("pos"))).where("r = 1")
    size = elements.groupBy("doc_id").agg((F.max("pos") + 1).alias("size"))
    rows = first.withColumn("k", F.row_number().over(order())).join(size, "doc_id")
    label = F.coalesce(C.found(F.col("t"), C.ANNEX_START), F.col("k").cast("string"))
    return rows.select("doc_id", "k", F.concat(F.lit("annex_"), X.slug(label)).alias("provision_id"), F.col("t").alias("heading"), "pos", F.coalesce("next", "size").alias("stop"), source_id().alias("source_id"))


def annex_blocks(elements: DataFrame, heads: DataFrame) -> DataFrame:
    """(doc_id, k, provision_id, block_type, pos, text, role): what stands in each annex, an interval join on the document."""
    h = heads.select("doc_id", "pos", F.struct("k", "provision_id", F.col("pos").alias("lo"), "stop").alias("head"))
    kept = C.is_legal_element(F.col("classes")) & C.is_emitted(F.col("classes")) & ~has(*C.NOTE) & ~has("eli-container")
    # annexes do not overlap: the last heading before a row is its own, if the annex has not ended
    at = elements.withColumn("kept", kept).join(h, ["doc_id", "pos"], "left").where("kept or head is not null").withColumn("head", F.last("head", ignorenulls=True).over(order()))
    rows = at.where("kept and pos > head.lo and pos < head.stop").select("*", "head.k", "head.provision_id").withColumn("t", X.clean_markup(F.col("text")))
    table = has(*C.TABLE) & ((F.col("tag") == "table") | has("oj-table"))
    text = ~has(*C.TABLE) & has(*C.LEGAL) & (F.col("t") != "")
    rows = rows.withColumn("block_type", F.when(table, "table").when(text, "text")).where("block_type is not null")
    n = F.row_number().over(Window.partitionBy("doc_id", "k", "block_type").orderBy("pos"))
    return rows.select("doc_id", "k", F.concat("provision_id", F.when(F.col("block_type") == "table", "_table_").otherwise("_block_"), n).alias("provision_id"), "block_type", "pos", F.col("t").alias("text"), F.when(F.col("block_type") == "text", C.block_role(F.col("t"), F.col("classes"))).alias("role"))


def tables(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, caption, rows): every table with its cells; a table without rows is one cell of its text."""
    t = elements.where((F.col("tag") == "table") | has("oj-table")).select("doc_id", F.col("pos").alias("table_pos"), F.col("end_pos").alias("table_end"), F.col("parent_pos").alias("up"), X.clean_markup(F.col("text")).alias("whole"), F.col("classes").alias("table_classes"))
    tr = elements.where("tag = 'tr'").select("doc_id", F.col("pos").alias("tr_pos"))
    number = lambda a: F.coalesce(F.try_element_at("attrs", F.lit(a)).try_cast("int"), F.lit(1))
    cell = F.struct(X.clean_markup(F.col("text")).alias("text"), ((F.col("tag") == "th") | has("oj-tbl-hdr")).alias("is_header"), number("colspan").alias("colspan"), number("rowspan").alias("rowspan"), F.col("classes").alias("classes"))
    cells = elements.where("tag in ('td', 'th')").select("doc_id", F.col("parent_pos").alias("tr_pos"), F.struct("pos", cell.alias("c")).alias("pc"))
    row = cells.groupBy("doc_id", "tr_pos").agg(F.transform(F.sort_array(F.collect_list("pc")), lambda x: x["c"]).alias("cells"))
    in_table = tr.join(row, ["doc_id", "tr_pos"]).join(t, "doc_id").where("tr_pos > table_pos and tr_pos <= table_end")
    rows = in_table.groupBy("doc_id", "table_pos").agg(F.transform(F.sort_array(F.collect_list(F.struct("tr_pos", "cells"))), lambda x: x["cells"]).alias("rows"))
    before = elements.select("doc_id", F.col("parent_pos").alias("up"), F.col("pos").alias("sp"), F.when(has("oj-ti-tbl"), X.clean_markup(F.col("text"))).alias("cap"))
    caption = t.join(before, ["doc_id", "up"]).where("sp < table_pos").groupBy("doc_id", "table_pos").agg(F.max_by("cap", "sp").alias("caption"))
    alone = F.array(F.array(F.struct(F.col("whole").alias("text"), F.lit(False).alias("is_header"), F.lit(1).alias("colspan"), F.lit(1).alias("rowspan"), F.col("table_classes").alias("classes"))))
    got = t.join(rows, ["doc_id", "table_pos"], "left").join(caption, ["doc_id", "table_pos"], "left")
    return got.select("doc_id", F.col("table_pos").alias("pos"), "caption", F.coalesce("rows", F.when(F.col("whole") != "", alone)).alias("rows"))


def titles(elements: DataFrame, root: DataFrame) -> DataFrame:
    """(doc_id, title): the first of four title classes that has text, below the root before elsewhere; else the page's title; else a constant."""
    kinds = ("eli-main-title", "oj-hd-ti", "eli-title", "oj-doc-ti")
    rank = F.coalesce(*[F.when(has(c), i) for i, c in enumerate(kinds)], F.when(F.col("tag") == "title", 4))
    rows = elements.join(root, "doc_id").withColumns({"rank": rank, "t": X.clean_markup(F.col("text")), "out": ~((F.col("pos") > F.col("root_pos")) & (F.col("pos") <= F.col("root_end")))})
    best = rows.where("rank is not null and t <> ''").groupBy("doc_id").agg(F.min_by("t", F.struct("rank", F.when(F.col("rank") < 4, F.col("out")).otherwise(False), "pos")).alias("title"))
    return root.select("doc_id").join(best, "doc_id", "left").select("doc_id", F.coalesce("title", F.lit(UNTITLED)).alias("title"))


def metadata(elements: DataFrame, root: DataFrame) -> DataFrame:
    """(doc_id, metadata): a map of the page's journal, date and language lines (below the root before elsewhere), its path and the size of its legal stream."""
    rows = elements.join(root, "doc_id").withColumn("out", ~((F.col("pos") > F.col("root_pos")) & (F.col("pos") <= F.col("root_end"))))
    each = rows.withColumn("key", F.explode(F.array_compact(F.array(*[F.when(has(c), F.lit(k)) for c, k in METADATA.items()]))))
    first = each.groupBy("doc_id", "key").agg(F.min_by(X.clean_markup(F.col("text")), F.struct("out", "pos")).alias("value"))
    held = first.groupBy("doc_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("m"))
    size = legal_stream(elements, root).groupBy("doc_id").agg(F.count(F.lit(1)).cast("string").alias("n"))
    got = root.select("doc_id").join(held, "doc_id", "left").join(size, "doc_id", "left")
    own = F.create_map(F.lit("source_path"), F.col("doc_id"), F.lit("format"), F.lit("html"), F.lit("stream_size"), F.coalesce("n", F.lit("0")))
    return got.select("doc_id", F.map_concat(own, F.coalesce("m", F.create_map().cast("map<string,string>"))).alias("metadata"))


def summary(root: DataFrame, **parts: DataFrame) -> DataFrame:
    """(doc_id, one count and one list of ids a part, warnings): parts are tables with doc_id; a part with provision_id or note_id lists them."""
    got = root.select("doc_id")
    for name, df in parts.items():
        key = next((c for c in ("provision_id", "note_id") if c in df.columns), None)
        ids = [F.sort_array(F.collect_list(key)).alias(f"{name}_ids")] if key and name != "blocks" else []
        got = got.join(df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name), *ids), "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
        for i in ids[:1]:
            got = got.withColumn(f"{name}_ids", F.coalesce(f"{name}_ids", F.array().cast("array<string>")))
    # the parser's warnings (fixed values)
    said = {"recitals": "No recitals detected.", "sections": "No sections detected.", "articles": "No articles detected.", "annexes": "No annexes detected.", "footnotes": "No footnotes detected."}
    return got.withColumn("warnings", F.array_compact(F.array(*[F.when(F.col(n) == 0, F.lit(w)) for n, w in said.items() if n in parts])))


def diagnostics(elements: DataFrame) -> dict[str, DataFrame]:
    """The five diagnostic tables: what stands before the first article, recital and annex candidates, notes, structure classes."""
    t, c = X.clean(F.col("text")), F.array_join("classes", " ")
    first = elements.where(has("oj-ti-art")).groupBy("doc_id").agg(F.min("pos").alias("first"))
    pre = elements.join(first, "doc_id").where("pos < first").select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("pos"))).alias("n"), "tag", c.alias("classes"), "id", F.substring(t, 1, 250).alias("text"))
    named = elements.withColumn("seen", F.sum(F.contains(F.upper(t), F.lit("ANNEX")).cast("int")).over(order()))
    ends = named.select("doc_id", F.col("pos").alias("end_pos"), F.col("seen").alias("upto"))
    # a frame has no text, but holds what stands in it
    named = named.join(ends, ["doc_id", "end_pos"]).where(F.contains(F.upper(t), F.lit("ANNEX")) | (F.col("text").isNull() & (F.col("upto") > F.col("seen"))))
    up = elements.select("doc_id", F.col("pos").alias("parent_pos"), F.array_join("classes", " ").alias("parent_classes"))
    kinds = ("eli-main-title", "eli-title", "eli-subdivision", "oj-doc-ti", "oj-ti-art", "oj-sti-art", "oj-ti-section-1", "oj-ti-section-2", "oj-note", "oj-table")  # fixed values
    each = elements.withColumn("kind", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).alias("class")) for i, k in enumerate(kinds)]))).where(F.array_contains("classes", F.col("kind.class")))
    return {
        "pre_article": pre,
        "recital_candidates": elements.where(t.startswith("(")).select("doc_id", "pos", "tag", c.alias("classes"), "id", t.alias("text")),
        "annex_candidates": named.join(up, ["doc_id", "parent_pos"], "left").select("doc_id", "pos", "tag", c.alias("classes"), "id", F.substring(t, 1, 250).alias("text"), "parent_classes"),
        "footnotes": elements.where(has("oj-note")).select("doc_id", "pos", "tag", c.alias("classes"), "id", F.substring(t, 1, 500).alias("text")),
        "structure": each.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("kind.i", "pos")).alias("n"), F.col("kind.class").alias("class"), "tag", "id", F.substring(t, 1, 250).alias("text")),
    }


def numbered_layout(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, ord, text, left_cm, first_line_cm): a marker alone takes the next line as its body, however many stand in a row.

    In a run of lone markers every second one is taken as body, so the parity inside the run decides; the line after a
    run of odd length belongs to its last marker.  ``paragraphs``: doc_id, ord, text, table_depth.
    """
    w = Window.partitionBy("doc_id").orderBy("ord")
    t = F.col("text")
    rows = paragraphs.where(X.clean(t) != "").withColumn("alone", C.is_standalone_marker(t))
    rows = rows.withColumn("turn", (F.col("alone") != F.coalesce(F.lag("alone").over(w), ~F.col("alone"))).cast("int")).withColumn("run", F.sum("turn").over(w))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "run").orderBy("ord")))
    takes = F.col("alone") & (F.col("nth") % 2 == 1)
    rows = rows.withColumn("takes", takes & F.lead("ord").over(w).isNotNull()).withColumn("body", F.lead("text").over(w)).withColumn("taken", F.coalesce(F.lag("takes").over(w), F.lit(False)))
    digit = F.max((C.marker_type(t) == "digit").cast("int")).over(Window.partitionBy("doc_id"))
    rows = rows.withColumn("offset", F.coalesce(digit, F.lit(0))).where("not taken")
    joined = X.marker_spacing(F.when(F.col("takes"), F.concat(t, F.lit("\t"), F.col("body"))).otherwise(t))
    hang = F.col("takes") | C.marker_type(t).isNotNull()
    depth = F.col("table_depth") + F.col("offset")
    return rows.select("doc_id", "ord", joined.alias("text"), F.when(hang, F.greatest(depth, F.lit(1))).otherwise(depth).alias("left_cm"), F.when(hang, -1).otherwise(0).alias("first_line_cm"))

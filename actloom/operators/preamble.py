"""Parts of an act known by the ids of their containers: preamble, chapters, recitals, entry into force, annexes that an amending act carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import text as X
from actloom.operators.amendments import item_text
from actloom.operators.revise import RUNS
from actloom.operators.structure import has

T = "text_fn"


def _order() -> Window:
    return Window.partitionBy("doc_id").orderBy("pos")


def boxes(elements: DataFrame, prefix: str) -> DataFrame:
    """(doc_id, box, lo, hi, tail) of the containers with ids of a prefix; tail is the id without it."""
    e = elements.where(F.col("id").rlike(f"^{prefix}_[A-Za-z0-9]+$"))
    return e.select("doc_id", F.col("id").alias("box"), F.col("pos").alias("lo"), F.col("end_pos").alias("hi"), F.regexp_replace("id", f"^{prefix}_", "").alias("tail"))


def box_lines(elements: DataFrame, prefix: str) -> DataFrame:
    """(doc_id, box, tail, pos, text, table_depth): body paragraphs of each container that belong to no container inside it."""
    p = elements.where((F.col("tag") == "p") & has("oj-normal", "oj-enumeration-spacing") & ~has("oj-note") & ~F.coalesce(F.contains(F.col("id"), F.lit(".tit_")), F.lit(False)))
    p = p.select("doc_id", "pos", F.col("structural_id").alias("box"), X.clean(F.col(T)).alias("text"), "table_depth").where("text <> ''")
    return p.join(boxes(elements, prefix), ["doc_id", "box"]).where("pos > lo and pos <= hi").select("doc_id", "box", "tail", "pos", "text", "table_depth")


def recitals(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, number, text): numbered recitals by container; a line that is only the number is none of the body."""
    own = boxes(elements, "rct").where(F.col("tail").rlike(r"^\d+$"))
    n = F.col("tail")
    mine = F.regexp_replace(F.col("text"), F.concat(F.lit(r"^\(?"), n, F.lit(r"\)?\s*")), F.lit(""))
    body = box_lines(elements, "rct").where(~F.col("text").isin("", "()")).where((F.col("text") != n) & (F.col("text") != F.concat(F.lit("("), n, F.lit(")"))))
    body = body.select("doc_id", "box", "pos", mine.alias("t")).where("t <> ''").groupBy("doc_id", "box").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), " ").alias("body"))
    whole = elements.select("doc_id", F.col("pos").alias("lo"), X.clean(F.col(T)).alias("text"))
    got = own.join(body, ["doc_id", "box"], "left").join(whole, ["doc_id", "lo"])
    text = F.concat(F.lit("("), n, F.lit(") "), F.coalesce("body", F.trim(mine)))
    return got.select("doc_id", F.col("lo").alias("pos"), n.alias("number"), text.alias("text")).where(~C.is_report_fragment(F.col("text")))


def fallback_recitals(elements: DataFrame) -> DataFrame:
    """(doc_id, pos, text): where no container gives recitals, numbered paragraphs before the first article, each text once."""
    first = elements.where(F.col("id").startswith("art_")).groupBy("doc_id").agg(F.min("pos").alias("stop"))
    p = elements.where((F.col("tag") == "p") & has("oj-normal")).select("doc_id", "pos", X.clean(F.col("text")).alias("text")).where(F.col("text").rlike(r"^\(\d+\)") & ~C.is_report_fragment(F.col("text")))
    p = p.join(first, "doc_id", "left").where("stop is null or pos < stop").drop("stop")
    return p.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("pos"))).where("r = 1").drop("r")


def fallback_items(elements: DataFrame) -> DataFrame:
    """(doc_id, article_number, article_heading, pos, text, source_instruction): every text of an article once, without instruction."""
    box = boxes(elements, "art")
    head = elements.where(has("oj-ti-art")).select("doc_id", F.col("pos").alias("hp"), X.clean(F.col("text")).alias("h"))
    named = box.join(head, "doc_id").where("hp > lo and hp <= hi").groupBy("doc_id", "box").agg(F.min_by("h", "hp").alias("h"))
    p = elements.where((F.col("tag") == "p") & has("oj-normal")).select("doc_id", "pos", X.clean(F.col("text")).alias("text")).where((F.col("text") != "") & ~C.is_report_fragment(F.col("text")))
    rows = p.join(box, "doc_id").where("pos > lo and pos <= hi").withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "box", "text").orderBy("pos"))).where("r = 1")
    return rows.join(named, ["doc_id", "box"], "left").select("doc_id", F.col("tail").alias("article_number"), F.coalesce("h", F.concat(F.lit("Article "), F.col("tail"))).alias("article_heading"), "pos", "text", F.lit(None).cast("string").alias("source_instruction"))


def preamble(elements: DataFrame) -> DataFrame:
    """(doc_id, part, pos, text): enacting entities, citations, the bridge before the recitals, the adoption formula."""
    t = X.clean(F.col(T))
    lines = elements.where(has("oj-normal")).select("doc_id", "pos", "parent_pos", "structural_id", t.alias("text")).where("text <> ''")
    block = elements.where("id = 'pbl_1'").select("doc_id", F.col("pos").alias("parent_pos"))
    cit = boxes(elements, "cit").groupBy("doc_id").agg(F.min("lo").alias("first_cit"), F.max("hi").alias("last_cit"))
    rct = boxes(elements, "rct").groupBy("doc_id").agg(F.min("lo").alias("first_rct"))
    marks = cit.join(rct, "doc_id", "full_outer")
    part = lambda df, name: df.select("doc_id", F.lit(name).alias("part"), "pos", "text")
    entities = lines.join(block, ["doc_id", "parent_pos"]).join(marks, "doc_id", "left").where("first_cit is null or pos < first_cit")
    inside = box_lines(elements, "cit")
    empty = boxes(elements, "cit").join(inside.select("doc_id", "box").distinct(), ["doc_id", "box"], "left_anti").select("doc_id", F.col("lo").alias("pos")).join(elements.select("doc_id", "pos", t.alias("text")), ["doc_id", "pos"])
    bridge = lines.join(marks, "doc_id").where("structural_id is null and pos < first_rct and (last_cit is not null and pos > last_cit)")
    formula = elements.where(F.col("tag").isin("p", "div")).select("doc_id", "pos", "tag", t.alias("text"))
    strict = (F.col("tag") == "p") & F.col("text").rlike(r"(?i)^HAVE\s+ADOPTED\s+THIS\s+REGULATION\s*:$")
    formula = formula.where(strict | (F.contains("text", F.lit("HAVE ADOPTED THIS REGULATION")) & (F.length("text") <= 120)))
    formula = formula.groupBy("doc_id").agg(F.min_by(F.struct("pos", "text"), F.struct(~strict, "pos")).alias("m")).select("doc_id", "m.*")
    out = part(entities, "entity")
    for df, name in ((inside, "citation"), (empty, "citation"), (bridge, "bridge"), (formula, "formula")):
        out = out.unionByName(part(df, name))
    return out


def article_titles(elements: DataFrame) -> DataFrame:
    """(doc_id, box, number, title, lo): title of each article container from its subtitle, else from its title id."""
    box = boxes(elements, "art")
    sub = elements.where(has("oj-sti-art")).select("doc_id", F.col("structural_id").alias("box"), "pos", X.clean(F.col("text")).alias("t"), F.lit(0).alias("rank")).where(~F.col("t").rlike(r"(?i)^Article\s+\d+") & (F.col("t") != ""))
    alt = elements.where(F.col("id").rlike(r"^art_[A-Za-z0-9]+\.tit_\d+$")).select("doc_id", F.regexp_replace("id", r"\.tit_\d+$", "").alias("box"), "pos", F.trim(F.regexp_replace(X.clean(F.col("text")), r"(?i)^Article\s+\d+\s*", "")).alias("t"), F.lit(1).alias("rank")).where("t <> ''")
    best = sub.unionByName(alt).groupBy("doc_id", "box").agg(F.min_by("t", F.struct("rank", "pos")).alias("title"))
    return box.join(best, ["doc_id", "box"], "left").select("doc_id", "box", F.col("tail").alias("number"), "title", "lo", "hi")


def chapters(elements: DataFrame) -> DataFrame:
    """(doc_id, box, heading, title, lo, hi): chapter containers; the title by id before short headings outside articles."""
    box = boxes(elements, "cpt")
    t = X.clean(F.col("text"))
    by_id = elements.where(F.col("id").rlike(r"^cpt_[A-Za-z0-9]+\.tit_\d+$")).select("doc_id", F.regexp_replace("id", r"\.tit_\d+$", "").alias("box"), "pos", t.alias("t"), F.lit(0).alias("rank"))
    kinds = F.when(has("oj-ti-section-1"), 1).when(has("oj-ti-section-2"), 2).when(has("eli-title"), 3).when(has("oj-doc-ti"), 4)
    other = elements.select("doc_id", "pos", t.alias("t"), kinds.alias("rank"), "structural_id").where("rank is not null and length(t) <= 120").where(~F.coalesce(F.startswith("structural_id", F.lit("art_")), F.lit(False)) & ~F.col("t").rlike(r"(?i)^Article\s+\d+"))
    other = other.join(box, "doc_id").where("pos >= lo and pos <= hi").select("doc_id", "box", "pos", "t", "rank")
    best = by_id.unionByName(other).where((F.col("t") != "") & ~F.col("t").rlike(r"(?i)^CHAPTER\s")).groupBy("doc_id", "box").agg(F.min_by("t", F.struct("rank", "pos")).alias("title"))
    return box.join(best, ["doc_id", "box"], "left").select("doc_id", "box", F.concat(F.lit("CHAPTER "), "tail").alias("heading"), "title", "lo", "hi")


def operatives(elements: DataFrame) -> DataFrame:
    """(doc_id, ord, chapter, number, title): articles in chapters first, then those in none, each once."""
    art, cpt = article_titles(elements), chapters(elements).select("doc_id", F.col("box").alias("chapter"), F.col("lo").alias("clo"), F.col("hi").alias("chi"))
    held = art.join(cpt, "doc_id", "left").withColumn("in", F.coalesce((F.col("lo") > F.col("clo")) & (F.col("lo") <= F.col("chi")), F.lit(False)))
    once = held.groupBy("doc_id", "number").agg(F.min_by(F.struct("chapter", "in", "clo", "lo", "title"), F.struct(~F.col("in"), "clo", "lo")).alias("m"))
    rows = once.select("doc_id", "number", F.when(F.col("m.in"), F.col("m.chapter")).alias("chapter"), F.col("m.title").alias("title"), F.when(F.col("m.in"), F.col("m.clo")).alias("clo"), F.col("m.lo").alias("lo"))
    return rows.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("clo"), "lo")).alias("ord"), "chapter", "number", "title")


def entry_into_force(elements: DataFrame) -> DataFrame:
    """(doc_id, article_heading_line, article_subheading_line, article_body, final_lines): the first article on entry into force, and the act's closing lines."""
    said = r"(?i)\bentry\s+into\s+force\b"
    art = article_titles(elements).where(F.coalesce(F.col("title").rlike(said), F.lit(False))).groupBy("doc_id").agg(F.min_by(F.struct("box", "number", "title"), "lo").alias("m")).select("doc_id", "m.*")
    lines = box_lines(elements, "art").select("doc_id", "box", "pos", item_text(F.col("text")).alias("t")).where("t <> ''")
    body = art.join(lines, ["doc_id", "box"], "left").groupBy("doc_id", "box", "number", "title").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]).alias("article_body"))
    final = elements.where((F.col("tag") == "div") & has("oj-final")).groupBy("doc_id").agg(F.min("pos").alias("parent_pos"))
    close = elements.where((F.col("tag") == "p") & has("oj-normal")).join(final, ["doc_id", "parent_pos"]).select("doc_id", "pos", X.clean(F.col(T)).alias("t")).where((F.col("t") != "") & ~C.is_instruction(F.col("t")))
    close = close.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]).alias("final_lines"))
    none = F.array().cast("array<string>")
    got = body.join(close, "doc_id", "full_outer")
    return got.select("doc_id", F.when(F.col("number").isNotNull(), F.concat(F.lit("Article "), "number")).alias("article_heading_line"), F.col("title").alias("article_subheading_line"), F.coalesce("article_body", none).alias("article_body"), F.coalesce("final_lines", none).alias("final_lines"))


def signatories(elements: DataFrame) -> DataFrame:
    """(doc_id, block, pos, text, italic): signature lines by block."""
    block = elements.where((F.col("tag") == "div") & has("oj-signatory")).select("doc_id", F.col("pos").alias("block"), "end_pos")
    it = elements.where(has("oj-italic")).select("doc_id", F.col("parent_pos").alias("pos"), F.lit(True).alias("italic")).distinct()
    p = elements.where((F.col("tag") == "p") & has("oj-signatory")).select("doc_id", "pos", X.clean(F.col(T)).alias("text")).where("text <> ''")
    return p.join(block, "doc_id").where("pos > block and pos <= end_pos").join(it, ["doc_id", "pos"], "left").select("doc_id", "block", "pos", "text", F.coalesce("italic", F.lit(False)).alias("italic"))


def annex_changes(elements: DataFrame) -> DataFrame:
    """(doc_id, annex_label, mode, ord, text): the annexes an amending act replaces or adds, line by line."""
    box = boxes(elements, "anx").groupBy("doc_id").agg(F.min_by(F.struct("lo", "hi"), "lo").alias("b")).select("doc_id", "b.*")
    p = elements.where("tag = 'p'").select("doc_id", "pos", X.clean(F.col(T)).alias("text")).where("text <> ''").join(box, "doc_id").where("pos > lo and pos <= hi")
    switch = F.when(F.col("text").rlike(r"(?i)\bannexes?\s+[ivxlcdm0-9\s,toand]+\s+are\s+replaced\s+by\s+the\s+following\b"), "replace").when(F.col("text").rlike(r"(?i)\bthe\s+following\s+annex(?:es)?\s+are\s+added\b"), "add")
    rows = p.withColumns({"switch": switch, "head": C.annex_label(F.col("text"))})
    rows = rows.withColumn("mode", F.last("switch", ignorenulls=True).over(_order()))
    turn = F.when(F.col("switch").isNotNull(), F.struct(F.lit(None).cast("string").alias("l"))).when(F.col("head").isNotNull(), F.struct(F.col("head").alias("l")))
    rows = rows.withColumn("annex_label", F.last(turn, ignorenulls=True).over(_order())["l"]).where("switch is null and mode is not null and annex_label is not null")
    text = F.when(F.col("head").isNotNull(), F.concat(F.lit("ANNEX "), "head")).otherwise(F.col("text"))
    return rows.select("doc_id", "annex_label", "mode", F.row_number().over(Window.partitionBy("doc_id", "annex_label").orderBy("pos")).alias("ord"), text.alias("text"))


def merged_lines(lines: DataFrame) -> DataFrame:
    """``lines`` (doc_id, ord, text) with lone list markers joined to the next line and outer quotes off."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    alone = X.is_list_marker(F.col("text"))
    rows = lines.withColumn("alone", alone).withColumn("body", F.lead("text").over(w))
    rows = rows.withColumn("joins", F.col("alone") & (X.clean(F.col("body")) != "") & ~X.is_list_marker(F.col("body"))).withColumn("taken", F.coalesce(F.lag("joins").over(w), F.lit(False))).where("not taken")
    t = F.when(F.col("joins"), F.concat(X.clean(F.col("text")), F.lit("\t"), X.clean(F.col("body")))).otherwise(X.clean(F.col("text")))
    t = F.when(F.row_number().over(w) == 1, F.regexp_replace(t, "^[‘'\"]+", "")).otherwise(t)
    return rows.select("doc_id", "ord", F.trim(F.regexp_replace(t, "[’'\"]$", "")).alias("text")).where("text <> ''")


def comparable_annex_lines(lines: DataFrame) -> DataFrame:
    """Annex lines with markers tabbed, and a heading joined to a title that is no structural line."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = lines.where(X.clean(F.col("text")) != "").select("doc_id", "ord", X.annex_line(F.col("text")).alias("text"))
    rows = rows.withColumns({"n": F.row_number().over(w), "next": F.lead("text").over(w)})
    heads = (F.col("n") == 1) & F.col("text").rlike(r"(?i)^ANNEX\s+[IVXLC]+[A-Za-z]?\b") & F.col("next").isNotNull() & ~F.col("next").rlike(r"(?i)^(?:[IVXLC]+\.|[A-Z]\.|\d+[A-Za-z]?[.)]|\([a-z]+\))(?=\s|$)")
    rows = rows.withColumn("joins", heads).withColumn("taken", F.coalesce(F.lag("joins").over(w), F.lit(False))).where("not taken")
    return rows.select("doc_id", "ord", F.when(F.col("joins"), F.concat("text", F.lit("\n"), "next")).otherwise(F.col("text")).alias("text"))


def inserted_article_markers(elements: DataFrame, instructions: DataFrame) -> DataFrame:
    """(doc_id, pos, marker): for each instruction element (doc_id, pos) the lettered article that the next sibling container names by id, else the first of ten following siblings that begins with its heading."""
    at = instructions.join(elements.select("doc_id", "pos", F.col("parent_pos").alias("up")), ["doc_id", "pos"])
    sib = elements.select("doc_id", F.col("parent_pos").alias("up"), F.col("pos").alias("sp"), "tag", "id", X.clean(F.col("text")).alias("t"))
    near = at.join(sib, ["doc_id", "up"]).where("sp > pos").withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "pos").orderBy("sp")))
    digits = F.concat(F.regexp_extract("id", r"^0*(\d+)[A-Za-z]$", 1), F.lower(F.regexp_extract("id", r"^0*\d+([A-Za-z])$", 1)))
    div = F.when(F.col("tag") == "div", F.struct("sp", F.nullif(digits, F.lit("")).alias("m")))
    text = F.when(F.col("n") <= 10, F.lower(C.found(F.col("t"), r"(?i)^[‘'\"\[]?Article\s+(\d+[A-Za-z])\b")))
    got = near.groupBy("doc_id", "pos").agg(F.min(div).alias("d"), F.min_by(text, F.when(text.isNotNull(), F.col("sp"))).alias("m"))
    return got.select("doc_id", "pos", F.coalesce("d.m", "m").alias("marker")).where("marker is not null")


def _inserted(text: Column, color: str | None) -> Column:
    """One run of inserted text, null where the lines carry no runs."""
    if color is None:
        return F.lit(None).cast(RUNS)
    return F.array(F.struct(text.alias("text"), F.lit("insert").alias("kind"), F.lit(False).alias("strike"), F.lit(True).alias("double_underline"), F.lit(color).alias("color")))


def _placed(rows: DataFrame, runs: bool) -> DataFrame:
    got = rows.select("doc_id", (F.row_number().over(Window.partitionBy("doc_id").orderBy("at", "k", "text")) - 1).alias("ord"), "text", "added", "runs")
    return got if runs else got.drop("runs")


def with_title_and_recitals(paragraphs: DataFrame, title: DataFrame, recital_lines: DataFrame, color: str | None = None) -> DataFrame:
    """(doc_id, ord, text, added): an act's paragraphs with the amending title behind its own title block and the amending recitals behind its last recital.

    ``title``: doc_id, text; ``recital_lines``: doc_id, pos, text.  Texts that are there already are not added again, so a
    second run changes nothing.  With a ``color`` the paragraphs' runs are kept and the new lines are inserted runs.
    """
    held = F.col("runs") if "runs" in paragraphs.columns else F.lit(None).cast(RUNS)
    own = paragraphs.select("doc_id", F.col("ord").cast("double").alias("at"), F.lit(0).cast("bigint").alias("k"), "text", F.lit(False).alias("added"), held.alias("runs"))
    there = paragraphs.select("doc_id", X.clean(F.col("text")).alias("c")).distinct()
    # flags and not texts are sent, and of these only what an act's first article and recitals need
    flags = paragraphs.select("doc_id", "ord", F.col("text").rlike(r"^\s*\(\d+\)").alias("rec"), C.article_number(F.col("text")).isNotNull().alias("art"))
    size = flags.groupBy("doc_id").agg(F.min("ord").alias("lo"), F.min(F.when(F.col("art"), F.col("ord"))).alias("stop"))
    before = flags.where("rec").join(size, "doc_id").where("stop is null or ord < stop")
    marks = before.groupBy("doc_id").agg(F.max("ord").alias("hi"), F.min("ord").alias("first"))
    ends = size.join(marks, "doc_id", "left").select("doc_id", F.coalesce("hi", "lo").alias("last_recital"), F.coalesce(F.col("first") - 1, F.col("lo")).alias("title_end"))
    new = lambda df: df.withColumn("c", X.clean(F.col("text"))).where("c <> ''").join(there, ["doc_id", "c"], "left_anti").join(ends, "doc_id")
    head = new(title).select("doc_id", F.explode(F.array(F.lit("as amended by"), F.array_join(X.title_lines(F.col("text")), "\n"))).alias("text"), "title_end")
    head = head.select("doc_id", (F.col("title_end") + 0.25).alias("at"), F.when(F.col("text") == "as amended by", 0).otherwise(1).cast("bigint").alias("k"), "text", F.lit(True).alias("added"), _inserted(F.col("text"), color).alias("runs"))
    lines = recital_lines.withColumn("tabbed", F.regexp_replace(X.clean(F.col("text")), r"^(\(\d+\))\s*", "$1\t"))
    # a recital of an earlier run stands with its tab, which counts as the space it was
    tail = new(lines).select("doc_id", (F.col("last_recital") + 0.5).alias("at"), F.col("pos").cast("bigint").alias("k"), F.col("tabbed").alias("text"), F.lit(True).alias("added"), _inserted(F.col("tabbed"), color).alias("runs"))
    return _placed(own.unionByName(head).unionByName(tail), color is not None)


def closing_lines(block: DataFrame, signed: DataFrame) -> DataFrame:
    """(doc_id, pos, text): what an amending act adds at the end, from :func:`entry_into_force` and :func:`signatories`."""
    heading = F.concat_ws("\n", F.nullif(X.clean(F.col("article_heading_line")), F.lit("")), F.nullif(X.clean(F.col("article_subheading_line")), F.lit("")))
    lines = block.select("doc_id", F.posexplode(F.concat(F.array(heading), F.transform("article_body", X.marker_tab), "final_lines")).alias("pos", "text"))
    last = signed.select("doc_id", (F.lit(10**6) + F.row_number().over(Window.partitionBy("doc_id").orderBy("block", "pos"))).alias("pos"), "text")
    return lines.where("text <> ''").unionByName(last)


def with_closing(paragraphs: DataFrame, closing: DataFrame, color: str | None = None) -> DataFrame:
    """(doc_id, ord, text, added): an act's paragraphs with closing lines (doc_id, pos, text) before its first annex, else at its
    end; those already there are left out.  Runs as in :func:`with_title_and_recitals`."""
    held = F.col("runs") if "runs" in paragraphs.columns else F.lit(None).cast(RUNS)
    there = paragraphs.select("doc_id", X.clean(F.col("text")).alias("c")).distinct()
    annex = F.when(C.annex_label(F.col("text")).isNotNull(), F.col("ord"))
    last = paragraphs.groupBy("doc_id").agg(F.coalesce(F.min(annex) - 0.5, F.max("ord") + 0.5).alias("last"))
    new = closing.withColumn("c", X.clean(F.col("text"))).where("c <> ''").join(there, ["doc_id", "c"], "left_anti").join(last, "doc_id")
    own = paragraphs.select("doc_id", F.col("ord").cast("double").alias("at"), F.lit(0).cast("bigint").alias("k"), "text", F.lit(False).alias("added"), held.alias("runs"))
    more = new.select("doc_id", F.col("last").cast("double").alias("at"), F.col("pos").cast("bigint").alias("k"), "text", F.lit(True).alias("added"), _inserted(F.col("text"), color).alias("runs"))
    return _placed(own.unionByName(more), color is not None)

"""From raw amendment items to resolved ones, as one chain of windows over (act, order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.operators import ordered
from actloom.runtime import partitions, written


def order():  # noqa: ANN201
    """Document order; made when used, as a window needs a session."""
    return Window.partitionBy("doc_id").orderBy("item_idx")


REPLACED = r"(?i)\breplaced by the following\b"
TARGETS = ("target_article_number", "target_paragraph_number", "target_point_marker", "target_annex_number", "target_annex_point_marker")


def _has(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


#: paragraphs at the beginning of an act in which its number is looked for (a fixed value)
OPENING = 30


def target_regulation(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, target): the first number of a regulation in the opening paragraphs of each act (doc_id, ord from 0, text)."""
    named = paragraphs.where(F.col("ord") < OPENING).select("doc_id", "ord", G.regulation(F.col("text")).alias("n")).where("n is not null")
    return named.groupBy("doc_id").agg(F.min_by("n", "ord").alias("target"))


def relevant(items: DataFrame, target: Column) -> DataFrame:
    return items.where(C.is_relevant(F.col("article_heading"), F.col("source_instruction"), target))


def coalesce_markers(items: DataFrame) -> DataFrame:
    """A row that is only a list marker takes the body of the next row, which goes; the body's instruction wins, missing targets are filled from it."""
    own_marker = X.is_list_marker(F.col("text"))
    body = F.struct("text", "source_instruction", *TARGETS[:3], own_marker.alias("m"))
    rows = ordered.neighbours(items.withColumn("_m", own_marker), "doc_id", "item_idx", body, "_before", "_next")
    # a marker joins the row after it if that has a text and is none; that row then goes
    joins = lambda marker, text, other: marker & F.coalesce((X.clean(text) != "") & ~other, F.lit(False))
    rows = rows.withColumn("_joins", joins(F.col("_m"), F.col("_next.text"), F.col("_next.m"))).withColumn("_taken", F.coalesce(joins(F.col("_before.m"), F.col("text"), F.col("_m")), F.lit(False))).where("not _taken")
    own = F.lower(C.found(X.clean(F.col("text")), r"(?i)^\(([a-z]+)\)$"))
    take = lambda c: F.when(F.col("_joins") & ~_has(c), F.coalesce(F.col(f"_next.{c}"), F.col(c))).otherwise(F.col(c))
    return rows.withColumns(
        {
            "text": F.when(F.col("_joins"), F.concat(X.clean(F.col("text")), F.lit("\t"), X.clean(F.col("_next.text")))).otherwise(F.col("text")),
            "target_point_marker": F.when(F.col("_joins"), own).otherwise(F.col("target_point_marker")),
            "target_article_number": take("target_article_number"),
            "target_paragraph_number": take("target_paragraph_number"),
            "source_instruction": F.when(F.col("_joins") & (F.coalesce(F.col("_next.source_instruction"), F.lit("")) != ""), F.col("_next.source_instruction")).otherwise(F.col("source_instruction")),
        }
    ).drop("_m", "_before", "_next", "_joins", "_taken")


_SCAFFOLD = r"(?i)^\([ivxlcdm]+\) +(?=\([a-z]+\)|in\s+the\b|the\s+following\b|paragraph\b|point\b|Article\b)"


def item_text(c: Column) -> Column:
    """Payload form of an item's text; empty for scaffolding."""

    def payload(t: Column) -> Column:
        scaffold = C.is_instruction(t) | X.is_bare_marker(t) | t.rlike(r"(?i)^\([a-z]+\)\s*;\s*$") | t.rlike(r"^;\s*$")
        return F.when((t == "") | scaffold, "").otherwise(X.marker_tab(t))

    bare = X.let(X.without_anchors(c), lambda t: X.unquoted(X.without_marker_quote(t)))
    return X.let(F.regexp_replace(bare, _SCAFFOLD, ""), payload)


def normalize(items: DataFrame) -> DataFrame:
    """Kind and payload of every item; items without payload go unless they delete."""
    kind = F.when(_has("amendment_kind"), F.col("amendment_kind")).otherwise(C.amendment_kind(F.col("source_instruction"), F.col("text")))
    rows = items.withColumn("amendment_kind", kind).withColumn("_i", X.clean(F.col("source_instruction"))).withColumn("_p", X.clean(F.col("target_point_marker")))
    deletes = F.col("amendment_kind") == "deletion"
    text = F.when(deletes, X.clean(F.when(_has("text"), F.col("text")).otherwise(F.col("source_instruction")))).otherwise(item_text(F.col("text")))
    rows = rows.withColumn("text", X.once(text))
    heading = F.col("text").rlike(r"(?i)^[IVXLC]+\.$") & F.col("_i").rlike(r"(?i)\bin\s+Annex\b") & F.col("_i").rlike(REPLACED)
    rows = rows.withColumn("text", F.when(heading, "").otherwise(F.col("text")))
    named = F.lower(F.col("_p")) == G.point(F.col("_i"))
    named = F.coalesce(named | F.array_contains(F.transform(F.regexp_extract_all("_i", F.lit(r"(?i)\bpoint\s*\(([a-z]+)\)"), F.lit(1)), F.lower), F.lower(F.col("_p"))), F.lit(False))
    added = F.col("_i").rlike(r"(?i)\bthe following points?\s+(?:is|are)\s+(?:added|inserted)\b")
    prefix = (F.col("_p") != "") & (F.col("text") != "") & ~deletes & (named | added) & C.point_marker(F.col("text")).isNull()
    rows = rows.withColumn("text", F.when(prefix, F.concat(F.lit("("), F.col("_p"), F.lit(")\t"), F.col("text"))).otherwise(F.col("text")))
    rows = rows.withColumn("text", X.once(F.col("text")))
    return rows.where((F.col("text") != "") | deletes).drop("_i", "_p")


def backfill(items: DataFrame) -> DataFrame:
    """Targets from the instruction; a relative instruction takes the article of the row before that had one.

    The carried article is a window over values that do not depend on it: a value filled from the carry equals the carry.
    """
    i = X.clean(F.col("source_instruction"))
    rows = items.withColumns({"_i": i, "_art": G.article(i), "_annex": G.annex(i)})
    takes_annex = (F.col("_i") != "") & ~_has("target_annex_number") & F.col("_annex").isNotNull()
    base = F.when(takes_annex, F.lit(None).cast("string")).otherwise(F.coalesce("_art", F.nullif("target_article_number", F.lit(""))))
    rows = rows.withColumn("_takes", takes_annex).withColumn("_base", base)
    rows = ordered.carried(rows, "doc_id", "item_idx", F.col("_base"), "_carry")
    relative = (F.col("_i") != "") & F.col("_i").rlike(r"(?i)\b(?:paragraph|subparagraph|point|points|introductory wording)\b")
    fill = lambda c, v: F.when(F.col("_takes"), F.lit(None).cast("string")).when((F.col("_i") != "") & ~_has(c), F.coalesce(v, F.col(c))).otherwise(F.col(c))
    return rows.withColumns(
        {
            "target_article_number": F.when(F.col("_takes"), F.lit(None).cast("string")).otherwise(F.coalesce("_base", F.when(relative, F.col("_carry")), "target_article_number")),
            "target_paragraph_number": fill("target_paragraph_number", G.paragraph(F.col("_i"))),
            "target_point_marker": fill("target_point_marker", G.point(F.col("_i"))),
            "target_annex_number": F.when(F.col("_takes"), F.col("_annex")).otherwise(F.col("target_annex_number")),
            "target_annex_point_marker": F.when((F.col("_i") != "") & ~_has("target_annex_point_marker"), F.coalesce(G.annex_point(F.col("_i")), "target_annex_point_marker")).otherwise(F.col("target_annex_point_marker")),
        }
    ).drop("_i", "_art", "_annex", "_takes", "_base", "_carry")


def replacement_targets(items: DataFrame) -> DataFrame:
    """Where the instruction says replaced by the following, its own point and annex win over what was set."""
    i = X.clean(F.col("source_instruction"))
    on = i.rlike(REPLACED)
    annex = F.when(on, G.annex(i))
    rows = items.withColumns({"_annex": annex, "_point": F.when(on, G.point(i)), "_apoint": F.when(on, G.annex_point(i))})
    unless = lambda c: F.when(F.col("_annex").isNotNull(), F.lit(None).cast("string")).otherwise(c)
    return rows.withColumns(
        {
            "target_article_number": unless(F.col("target_article_number")),
            "target_paragraph_number": unless(F.col("target_paragraph_number")),
            "target_point_marker": unless(F.coalesce("_point", "target_point_marker")),
            "target_annex_number": F.coalesce("_annex", "target_annex_number"),
            "target_annex_point_marker": F.coalesce("_apoint", "target_annex_point_marker"),
        }
    ).drop("_annex", "_point", "_apoint")


def identify(items: DataFrame, target: Column | None = None) -> DataFrame:
    """The whole chain in its order: relevance, markers, payload, backfill, replacement targets."""
    rows = relevant(items, target) if target is not None else items
    # a payload takes many searches, so the rows are spread before, whatever is left of the partitions of the windows
    return replacement_targets(backfill(written(normalize(coalesce_markers(rows).repartition(partitions(items.sparkSession))), "items")))


def insertion_runs(items: DataFrame) -> DataFrame:
    """(doc_id, run, first_idx, n, marker, mentions): maximal runs of items that insert an article without naming one, with the lettered article most often mentioned (at least twice)."""
    on = X.clean(F.col("source_instruction")).rlike(r"(?i)\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\b") & ~_has("target_article_number")
    rows = items.withColumn("_on", F.coalesce(on, F.lit(False)))
    rows = rows.withColumn("_turn", (F.col("_on") & ~F.coalesce(F.lag("_on").over(order()), F.lit(False))).cast("int")).withColumn("run", F.sum("_turn").over(order())).where("_on")
    runs = rows.groupBy("doc_id", "run").agg(F.min("item_idx").alias("first_idx"), F.count(F.lit(1)).alias("n"))
    named = rows.select("doc_id", "run", "item_idx", F.posexplode(F.transform(F.regexp_extract_all(X.clean(F.col("text")), F.lit(r"(?i)\bArticle\s+(\d+[A-Za-z])\b"), F.lit(1)), F.lower)).alias("p", "marker"))
    counted = named.groupBy("doc_id", "run", "marker").agg(F.count(F.lit(1)).alias("mentions"), F.min(F.struct("item_idx", "p")).alias("at"))
    best = counted.withColumn("r", F.row_number().over(Window.partitionBy("doc_id", "run").orderBy(F.desc("mentions"), "at"))).where("r = 1 and mentions >= 2")
    return runs.join(best.select("doc_id", "run", "marker", "mentions"), ["doc_id", "run"], "left")


def insert_after(runs: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, run, marker, base): runs whose lettered article is not there yet and whose base article is (anti and semi join)."""
    named = runs.where("marker is not null").withColumn("base", C.split_number(F.col("marker"))["number"])
    have = sections.select("doc_id", F.col("article").alias("a"))
    missing = named.join(have, (named["doc_id"] == have["doc_id"]) & (F.col("marker") == F.col("a")), "left_anti")
    return missing.join(have, (missing["doc_id"] == have["doc_id"]) & (F.col("base") == F.col("a")), "left_semi").select("doc_id", "run", "marker", "base")

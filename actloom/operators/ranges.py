"""Interval and order joins on numbered paragraphs, planned as equi joins or windows on the document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C


def doc_order(*partition: str) -> Window:
    return Window.partitionBy(*partition).orderBy("ord")


def article_sections(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, article, nth, start, stop) of ``paragraphs`` (doc_id, ord, text): each article heading up to the next one, cut at a chapter or annex heading; nth counts the headings of one number."""
    marks = paragraphs.select("doc_id", "ord", F.lower(C.article_number(F.col("text"))).alias("article"), C.is_hard_boundary(F.col("text")).alias("hard"))
    size = paragraphs.groupBy("doc_id").agg((F.max("ord") + 1).alias("size"))
    heads = marks.where(F.col("article").isNotNull() | F.col("hard"))
    bounded = heads.withColumn("next", F.lead("ord").over(doc_order("doc_id"))).where("article is not null")
    nth = F.row_number().over(doc_order("doc_id", "article"))
    return bounded.join(size, "doc_id").select("doc_id", "article", nth.alias("nth"), F.col("ord").alias("start"), F.coalesce("next", "size").alias("stop"))


def annex_sections(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, annex, nth, start, stop): each annex heading up to the next."""
    heads = paragraphs.select("doc_id", "ord", C.annex_number(F.col("text")).alias("annex")).where("annex is not null")
    size = paragraphs.groupBy("doc_id").agg((F.max("ord") + 1).alias("size"))
    got = heads.withColumn("next", F.lead("ord").over(doc_order("doc_id"))).join(size, "doc_id")
    return got.select("doc_id", "annex", F.row_number().over(doc_order("doc_id", "annex")).alias("nth"), F.col("ord").alias("start"), F.coalesce("next", "size").alias("stop"))


def sectioned(paragraphs: DataFrame) -> DataFrame:
    """``paragraphs`` with the article they stand in and its start (null outside), by carrying the last heading forward."""
    number, hard = F.lower(C.article_number(F.col("text"))), C.is_hard_boundary(F.col("text"))
    turn = F.when(number.isNotNull(), F.struct(number.alias("article"), F.col("ord").alias("start"))).when(hard, F.struct(F.lit(None).cast("string").alias("article"), F.lit(None).cast(paragraphs.schema["ord"].dataType).alias("start")))
    return paragraphs.withColumn("_at", F.last(turn, ignorenulls=True).over(doc_order("doc_id"))).withColumns({"article": F.col("_at.article"), "start": F.col("_at.start")}).drop("_at")


def paragraph_blocks(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, article, marker, start, stop): each numbered paragraph of an article section up to the next marker or the section's end."""
    inside = sectioned(paragraphs).where("article is not null")
    end = F.max("ord").over(Window.partitionBy("doc_id", "start")) + 1
    marked = inside.withColumn("stop", end).withColumn("marker", C.paragraph_marker(F.col("text"))).where("marker is not null")
    stop = F.coalesce(F.lead("ord").over(doc_order("doc_id", "start")), "stop")
    return marked.select("doc_id", "article", "marker", F.col("ord").alias("start"), stop.alias("stop"), F.col("start").alias("section"))


def point_blocks(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, article, paragraph, marker, start, stop): each point up to the next point, paragraph marker, capitalised line without marker, or the section's end; roman points nested under a letter stay inside it."""
    inside = sectioned(paragraphs).where("article is not null")
    w = doc_order("doc_id", "start")
    t = F.col("text")
    rows = inside.withColumns({"para": C.paragraph_marker(t), "point": C.point_marker(t)})
    plain = F.col("para").isNull() & F.col("point").isNull() & C.clean(t).rlike("^[A-Z]") & ~C.clean(t).rlike(r"^(?:and|or)\b")
    rows = rows.withColumn("nested", F.coalesce(C.is_small_roman(F.col("point")) & F.last(F.when(F.col("point").isNotNull() & ~C.is_small_roman(F.col("point")), True).when(F.col("para").isNotNull(), False), ignorenulls=True).over(w), F.lit(False)))
    rows = rows.withColumn("paragraph", F.last("para", ignorenulls=True).over(w)).withColumn("stops", F.col("para").isNotNull() | (F.col("point").isNotNull() & ~F.col("nested")) | plain)
    end = F.max("ord").over(Window.partitionBy("doc_id", "start")) + 1
    nxt = F.min(F.when(F.col("stops"), F.col("ord"))).over(w.rowsBetween(1, Window.unboundedFollowing))
    own = rows.withColumn("stop", F.coalesce(nxt, end)).where("point is not null and not nested")
    return own.select("doc_id", "article", "paragraph", F.col("point").alias("marker"), F.col("ord").alias("start"), "stop")


def insertion_index(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, article, marker, at): where a new numbered paragraph belongs, the start of the first block with a larger marker, else the section's end.

    ``wanted``: doc_id, article, marker.  An as-of join: equi join on the section, least start of the larger keys.
    """
    key = C.sort_key(F.col("marker"))
    end = blocks.groupBy("doc_id", "article").agg(F.max("stop").alias("end"))
    larger = wanted.withColumn("key", key).join(blocks.select("doc_id", "article", key.alias("other"), "start"), ["doc_id", "article"], "left")
    first = larger.groupBy("doc_id", "article", "marker").agg(F.min(F.when(F.col("other") > F.col("key"), F.col("start"))).alias("first"))
    return first.join(end, ["doc_id", "article"]).select("doc_id", "article", "marker", F.coalesce("first", "end").alias("at"))


def subparagraph(paragraphs: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(doc_id, article, marker, ord): the k-th non-empty line without point marker of each numbered paragraph."""
    lines = sectioned(paragraphs).where("article is not null").select("doc_id", F.col("start").alias("section"), "ord", "text")
    b = blocks.select("doc_id", "section", "article", "marker", F.col("start").alias("lo"), F.col("stop").alias("hi"))
    inside = b.join(lines, ["doc_id", "section"]).where("ord >= lo and ord < hi").where((C.clean(F.col("text")) != "") & C.point_marker(F.col("text")).isNull())
    rank = F.row_number().over(Window.partitionBy("doc_id", "lo").orderBy("ord"))
    return inside.withColumn("k", rank).where(F.col("k") == k).select("doc_id", "article", "marker", "ord")


def paragraphs_with_all_points(points: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, article, item, paragraph): for each item the paragraph that holds all its points, if just one does (relational division).

    ``points`` as :func:`point_blocks`; ``wanted``: doc_id, article, item, marker.
    """
    need = wanted.groupBy("doc_id", "article", "item").agg(F.countDistinct("marker").alias("need"))
    hit = wanted.join(points.select("doc_id", "article", "paragraph", "marker").where("paragraph is not null").distinct(), ["doc_id", "article", "marker"])
    full = hit.groupBy("doc_id", "article", "item", "paragraph").agg(F.countDistinct("marker").alias("have")).join(need, ["doc_id", "article", "item"]).where("have = need")
    return full.groupBy("doc_id", "article", "item").agg(F.min("paragraph").alias("paragraph"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def marker_inversions(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, article, previous_marker, previous_ord, marker, ord): paragraph markers that come after a larger one of their section."""
    w = doc_order("doc_id", "start")
    marked = sectioned(paragraphs).where("article is not null").withColumn("marker", C.spaced_paragraph_marker(F.col("text"))).where("marker is not null and ord > start")
    marked = marked.withColumns({"previous_marker": F.lag("marker").over(w), "previous_ord": F.lag("ord").over(w)})
    return marked.where("previous_marker is not null").where(C.sort_key(F.col("marker")) < C.sort_key(F.col("previous_marker"))).select("doc_id", "article", "previous_marker", "previous_ord", "marker", "ord")


def inside(points: DataFrame, intervals: DataFrame, key: str, at: str, lo: str, hi: str) -> DataFrame:
    """Rows of ``points`` joined to the intervals lo <= at < hi of the same key: a hash or merge join with a residual range test."""
    return points.join(intervals, key).where((F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi)))


def annex_points(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, annex, point, start, stop): each roman section of an annex up to the next one or the annex's end."""
    turn = F.when(C.annex_number(F.col("text")).isNotNull(), F.struct(C.annex_number(F.col("text")).alias("annex"), F.col("ord").alias("lo")))
    inside = paragraphs.withColumn("_at", F.last(turn, ignorenulls=True).over(doc_order("doc_id"))).where("_at is not null").select("doc_id", "ord", "text", "_at.annex", "_at.lo")
    end = F.max("ord").over(Window.partitionBy("doc_id", "lo")) + 1
    heads = inside.withColumn("end", end).withColumn("point", C.annex_point(F.col("text"))).where("point is not null")
    return heads.select("doc_id", "annex", "point", F.col("ord").alias("start"), F.coalesce(F.lead("ord").over(doc_order("doc_id", "lo")), "end").alias("stop"))


def first_subparagraph_end(paragraphs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc_id, article, marker, at): the first line of each numbered paragraph that follows a point and is none, else the paragraph's end."""
    lines = sectioned(paragraphs).where("article is not null").select("doc_id", F.col("start").alias("section"), "ord", (C.clean(F.col("text")) != "").alias("full"), C.point_marker(F.col("text")).isNotNull().alias("point"))
    b = blocks.select("doc_id", "section", "article", "marker", F.col("start").alias("lo"), F.col("stop").alias("hi"))
    at = b.join(lines, ["doc_id", "section"]).where("ord >= lo and ord < hi").withColumn("seen", F.max(F.when(F.col("point"), True)).over(doc_order("doc_id", "lo").rowsBetween(Window.unboundedPreceding, -1)))
    got = at.groupBy("doc_id", "article", "marker", "lo", "hi").agg(F.min(F.when(F.col("seen") & F.col("full") & ~F.col("point"), F.col("ord"))).alias("first"))
    return got.select("doc_id", "article", "marker", F.coalesce("first", "hi").alias("at"))


def point_insertion_index(points: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, article, paragraph, marker, at): where a new lettered point belongs, before the first larger letter of its paragraph, else behind the last point and the romans nested in it.

    ``points`` as :func:`point_blocks`; ``wanted``: doc_id, article, paragraph, marker.
    """
    letters = points.where(~C.is_small_roman(F.col("marker"))).select("doc_id", "article", "paragraph", F.col("marker").alias("other"), "start", "stop")
    both = wanted.join(letters, ["doc_id", "article", "paragraph"])
    return both.groupBy("doc_id", "article", "paragraph", "marker").agg(F.coalesce(F.min(F.when(F.col("other") > F.col("marker"), F.col("start"))), F.max("stop")).alias("at"))


def landmarks(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, title_end, last_recital, formula, binding, first_article, first_annex, size): the places of a document that
    insertions go by, null where it has none."""
    t = C.clean(F.col("text"))
    art, annex = C.article_number(F.col("text")).isNotNull(), C.annex_number(F.col("text")).isNotNull()
    rows = paragraphs.select("doc_id", "ord", t.alias("t"), art.alias("art"), annex.alias("annex"))
    first = rows.withColumn("front", ~F.coalesce(F.max(F.when(F.col("art"), True)).over(doc_order("doc_id")), F.lit(False)))
    rec = F.col("front") & F.col("t").rlike(r"^\(\d+\)")
    at = lambda on: F.min(F.when(on, F.col("ord")))
    got = first.groupBy("doc_id").agg(
        at(rec).alias("first_recital"), F.max(F.when(rec, F.col("ord"))).alias("last_recital"), at(F.col("t").rlike("(?i)have adopted this")).alias("formula"), at(F.col("t").rlike("(?i)shall be binding in its entirety")).alias("binding"),
        at(F.col("art")).alias("first_article"), at(F.col("annex")).alias("first_annex"), F.min("ord").alias("lo"), (F.max("ord") + 1).alias("size"),
    )
    return got.select("doc_id", F.coalesce(F.col("first_recital") - 1, F.col("lo")).alias("title_end"), "last_recital", "formula", "binding", "first_article", "first_annex", "size")

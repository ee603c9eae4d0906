"""The three entry points of the engine, each one plan over many acts at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import compare as K
from actloom.functions import text as X
from actloom.functions import tokens as T
from actloom.operators import amendments, apply, checks, collect, coverage
from actloom.operators import annexes as N
from actloom.operators import preamble as P
from actloom.operators import structure as S
from actloom.runtime import spread, written
from actloom.sources import html

STRICT, PRACTICAL = 0.995, 0.985


def parse(pages: DataFrame) -> dict[str, DataFrame]:
    """The typed parts of all ``pages`` (doc_id, html)."""
    e = written(html.elements(pages), "elements")  # every part reads them, the pages are parsed once
    root = S.legal_root(e)
    stream = S.legal_stream(e, root)
    heads = S.annexes(e)
    parts = {"recitals": S.recitals(stream), "sections": S.sections(stream), "articles": S.articles(stream), "annexes": heads, "footnotes": S.footnotes(e, root)}
    return parts | {"elements": e, "stream": stream, "titles": S.titles(e, root), "article_blocks": S.article_blocks(stream), "annex_blocks": S.annex_blocks(e, heads), "tables": S.tables(e), "summary": S.summary(root, **parts)}


def amending_lines(elements: DataFrame) -> DataFrame:
    """Lines of amending articles for :mod:`collect`: the paragraphs inside containers art_*, with the article each stands in and the lettered article that follows an instruction."""
    box = elements.where(F.col("id").rlike(r"^art_[A-Za-z0-9]+$")).select("doc_id", "pos", "end_pos", F.regexp_replace("id", "^art_", "").alias("article_number"))
    inner = elements.where("tag = 'p'").where(S.has("oj-normal")).select("doc_id", F.col("pos").alias("p"), F.col("text_fn").alias("text"), (F.col("table_depth") > 0).alias("in_table"))
    head = elements.where(S.has("oj-ti-art", "oj-sti-art")).select("doc_id", F.col("pos").alias("hp"), X.clean(F.col("text")).alias("h"))
    named = box.join(head, "doc_id").where("hp > pos and hp <= end_pos").groupBy("doc_id", "pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("hp", "h"))), lambda x: x["h"]), " ").alias("article_heading"))
    adds = inner.where(X.clean(F.col("text")).rlike(r"(?i)\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\b")).select("doc_id", F.col("p").alias("pos"))
    near = P.inserted_article_markers(elements, adds).select("doc_id", F.col("pos").alias("p"), F.col("marker").alias("near_article"))
    lines = inner.join(box, "doc_id").where("p > pos and p <= end_pos").join(named, ["doc_id", "pos"], "left").join(near, ["doc_id", "p"], "left")
    return lines.select("doc_id", "article_number", F.coalesce("article_heading", F.lit("")).alias("article_heading"), F.col("p").alias("pos"), "text", "in_table", "near_article")


def consolidate(paragraphs: DataFrame, amending: DataFrame, color: str, target: str | None = None, require_full: bool = False, infer_target: bool = False, matches: bool = True) -> dict[str, DataFrame]:
    """One layer: ``paragraphs`` (doc_id, ord, text and optionally runs) of acts revised by the ``amending`` pages (doc_id of the act, html).

    In order: title and recitals, entry into force and closing lines, annexes, items; then proofs and the one-go check.
    Of several acts amended by one page only the items of the ``target`` are taken; with ``infer_target`` it is the first
    number each act names in its opening.  With ``require_full`` an operation without its preconditions, or a document not applied in one go, is an error.
    Without ``matches`` the analysis lacks the best match of each item (see :func:`apply.apply_layer`).
    """
    e = written(html.elements(spread(amending)), "elements")
    paragraphs = written(paragraphs, "paragraphs")  # every part looks at them
    # what a page adds is written before it meets the act, so no plan holds the whole layer and none of its parts is made twice
    title = written(S.titles(e, S.legal_root(e)).where(F.col("title") != S.UNTITLED).select("doc_id", F.col("title").alias("text")), "title")
    numbered = written(P.recitals(e).select("doc_id", "pos", "text"), "recitals")
    fallback = written(P.fallback_recitals(e).join(numbered.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", "pos", "text"), "recitals")
    closing = written(P.closing_lines(P.entry_into_force(e), P.signatories(e)), "closing")
    lines = written(P.with_title_and_recitals(paragraphs, title, numbered.unionByName(fallback), color).drop("added"), "lines")
    lines = written(P.with_closing(lines, closing, color).drop("added"), "lines")
    lines = written(N.with_annexes(lines, written(P.annex_changes(e), "changes"), color), "lines")
    raw = written(collect.items(amending_lines(e)), "raw")
    if infer_target and not target:
        raw = raw.join(amendments.target_regulation(paragraphs), "doc_id", "left")
    items = written(amendments.identify(raw, F.lit(target) if target else F.col("target") if infer_target else None), "items")
    result = written(apply.apply_layer(lines, items, color, matches), "layer")
    done = result.where("part = 'item'")
    out = {"items": items, "paragraphs": apply.next_layer(result), "analysis": done, "proofs": checks.operation_proofs(done), "one_go": checks.one_go(done.withColumn("article_number", F.lit(None).cast("string")), apply.next_layer(result).select("doc_id", "ord", "text"))}
    checks.gate(out["proofs"], out["one_go"], not require_full)
    return out


def verify(target: DataFrame, source: DataFrame, chars: int = K.CHARS_EXACT, tokens: int = K.TOKENS_EXACT) -> DataFrame:
    """One row (doc_id, strict and practical coverage, edit distances, passed) of ``target`` and ``source`` (doc_id, text).

    A document that one side lacks is compared with nothing and fails, unless neither has a word.  Texts above ``chars``
    characters or ``tokens`` tokens have estimated distances.
    """
    out = None
    for name, kept in (("strict", False), ("practical", True)):
        one = coverage.summary(coverage.compare(source, target, "doc_id", T.words(X.clean(F.col("text"))), kept), "doc_id").select("doc_id", F.col("coverage_ratio").alias(f"{name}_coverage"))
        out = one if out is None else out.join(one, "doc_id", "full_outer")
    both = target.select("doc_id", F.col("text").alias("a"), F.lit(True).alias("in_target")).join(source.select("doc_id", F.col("text").alias("b"), F.lit(True).alias("in_source")), "doc_id", "full_outer")
    far = both.select("doc_id", (F.col("in_target").isNotNull() & F.col("in_source").isNotNull()).alias("compared"), K.char_distance(F.col("a"), F.col("b"), chars).alias("characters"), K.token_distance(F.col("a"), F.col("b"), tokens).alias("tokens"))
    got = far.join(out, "doc_id", "left").fillna(1.0, ["strict_coverage", "practical_coverage"])
    return got.withColumn("passed", F.col("compared") & ((F.col("strict_coverage") >= STRICT) | (F.col("practical_coverage") >= PRACTICAL)))


def report(result: DataFrame, source: DataFrame, color: str) -> DataFrame:
    """The audit of a layer, one row a document: every check's figures and examples, issues, notes, passed.

    ``result`` as :func:`apply.apply_layer` gives it; ``source`` (doc_id, text): the official texts to compare with.
    """
    lines, items = apply.next_layer(result), result.where("part = 'item'")
    visible = lines.select("doc_id", "ord", F.array_join(F.transform("runs", lambda r: r["text"]), "").alias("text"))
    standing = lines.select("doc_id", "ord", C.effective_text(F.col("runs")).alias("text"))
    whole = standing.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))
    placed = checks.placement(items, standing)
    n = lambda c: F.sum(F.col(c).cast("bigint")).alias(c)
    flags = ("missing_heading", "missing_exact_heading", "duplicate_heading", "missing_in_section", "found_before", "found_elsewhere")
    unmarked = items.where(X.clean(F.col("source_instruction")).rlike(r"(?i)\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\b") & F.col("inserted_article_marker").isNull()).groupBy("doc_id").agg(F.count(F.lit(1)).alias("without_marker"))
    parts = {
        "formatting": checks.revision_formatting(lines, color), "application": checks.application(items, visible), "application_examples": checks.application_examples(items, visible),
        "placement": placed.groupBy("doc_id").agg(*[n(c) for c in flags]).join(unmarked, "doc_id", "full_outer"), "paragraph_order": checks.order(standing), "comparison": verify(whole, source),
    }
    got = result.select("doc_id").distinct().join(items.groupBy("doc_id").agg(F.sum((F.col("applied_mode") == "replaced").cast("bigint")).alias("replacements")), "doc_id", "left")
    for name, df in parts.items():
        cols = [c for c in df.columns if c != "doc_id"]
        got = got.join(df.select("doc_id", F.struct(*cols).alias(name)), "doc_id", "left")
    some = lambda c: F.coalesce(F.col(c) > 0, F.lit(False))
    none = lambda c: F.coalesce(F.col(c) == 0, F.lit(True))
    found = {
        "no_inserted_runs_in_layer_color": none("formatting.inserted_runs_current"), "no_deleted_runs_despite_replacements": some("replacements") & none("formatting.deleted_runs_current"),
        "inserted_items_missing": some("application.inserted_items_missing_from_output"), "replacements_not_applied": some("application.replacement_instruction_items_not_properly_applied"),
        "inserted_article_heading_missing": some("placement.missing_heading"), "inserted_article_without_marker": some("placement.without_marker"), "inserted_article_heading_not_exact": some("placement.missing_exact_heading"),
        "inserted_article_heading_twice": some("placement.duplicate_heading"), "inserted_text_not_in_its_article": some("placement.missing_in_section"), "inserted_text_before_its_article": some("placement.found_before"),
        "inserted_text_in_other_articles": some("placement.found_elsewhere"), "paragraph_markers_out_of_order": some("paragraph_order.marker_order_inversions"),
        "no_source_compared": ~F.coalesce("comparison.compared", F.lit(False)), "coverage_below_threshold": F.coalesce(F.col("comparison.compared") & ~F.col("comparison.passed"), F.lit(False)),
    }
    got = got.withColumn("issues", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in found.items()])))
    strict = F.coalesce(F.col("comparison.passed") & (F.col("comparison.strict_coverage") < STRICT), F.lit(False))
    return got.withColumn("notes", F.array_compact(F.array(F.when(strict, F.lit("passed_by_practical_coverage_only"))))).withColumn("passed", F.size("issues") == 0)


def read_acts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return parse(html.read_pages(spark, path))

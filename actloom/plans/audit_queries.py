"""Revision layers applied to the articles of acts, and what the audits say of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import compare as K
from actloom.functions import text as X
from actloom.operators import amendments as A
from actloom.operators import apply as P
from actloom.operators import checks as H
from actloom.operators import revise as V
from actloom.plans import line_queries as L
from actloom.plans.coverage_queries import _CODED as V_CODED
from actloom.plans.coverage_queries import _NOISE as V_NOISE
from actloom.plans.coverage_queries import _ROWS as V_ROWS
from actloom.plans.coverage_queries import _SIGNS as V_SIGNS
from actloom.plans.item_queries import items
from actloom.plans.registry import WS, query, sanchorless, sclean, sfirst, steps, sunquoted, swords, table
from actloom.runtime import scratch, written

COLOR = "E67800"


def _unit(kind: str, name: Column) -> Column:
    return F.concat_ws(":", F.col("act_id").cast("string"), F.lit(kind), F.lower(name))


def _items(spark: SparkSession, d: str) -> DataFrame:
    """Identified items by the article or annex they amend, so a layer is applied unit by unit; items of neither meet no lines."""
    got = A.identify(items(spark, d)).withColumn("act_id", F.col("doc_id"))
    some = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    unit = F.when(some("target_annex_number"), _unit("annex", F.col("target_annex_number"))).when(some("target_article_number"), _unit("article", F.col("target_article_number"))).otherwise(_unit("none", F.lit("")))
    return got.withColumn("doc_id", unit).drop("act_id")


def _unit_lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, ord, text): every article and annex of an act behind its heading; ord follows the block number."""
    found = lambda n: F.regexp_extract("provision_id", r"^(article|annex)_([a-z0-9]+)_block_(\d+)$", n)
    rows = table(spark, d, "text_blocks").where("text is not null").withColumns({"kind": found(1), "name": found(2), "n": found(3)}).where("kind <> ''")
    doc = F.concat_ws(":", F.col("act_id").cast("string"), "kind", "name").alias("doc_id")
    heading = F.when(F.col("kind") == "annex", F.concat(F.lit("ANNEX "), F.upper("name"))).otherwise(F.concat(F.lit("Article "), "name"))
    lines = rows.select(doc, (F.col("n").cast("bigint") * 1_000_000_000 + F.col("block_id")).alias("ord"), "text")
    return lines.unionByName(rows.select(doc, F.lit(-1).cast("bigint").alias("ord"), heading.alias("text")).distinct())


def applied(spark: SparkSession, d: str, matches: bool = True) -> DataFrame:
    """The layer of every unit; ``matches``: with the best match of each item, which only some queries show."""
    todo = written(_items(spark, d), "todo")
    base = _unit_lines(spark, d).join(todo.select("doc_id").distinct(), "doc_id", "left_semi")
    return P.apply_layer(base, todo.drop("amending_text", "applied_mode", "article_heading"), COLOR, matches)


@query()
def applied_items(spark: SparkSession, d: str) -> DataFrame:
    return applied(spark, d).where("part = 'item'").drop("part", "ord", "text", "runs")


@query()
def applied_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return applied(spark, d, False).where("part = 'paragraph'").select("doc_id", "ord", "text", F.size("runs").alias("runs"), C.effective_text(F.col("runs")).alias("effective"))


@query()
def applied_modes(spark: SparkSession, d: str) -> DataFrame:
    return applied(spark, d).where("part = 'item'").groupBy("applied_mode").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg("best_match_score"), 6).alias("mean_score"))


@query()
def applied_reports(spark: SparkSession, d: str) -> DataFrame:
    """The audit of the layer, each unit held against what it was before."""
    from actloom.plans.pipeline import report

    source = _unit_lines(spark, d).groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), "\n").alias("text"))
    got = report(written(applied(spark, d, False), "layer"), source, COLOR)
    return got.select("doc_id", "passed", "issues", "notes", F.col("comparison.strict_coverage").alias("strict_coverage"), F.col("comparison.characters.method").alias("method"), F.col("formatting.inserted_runs_current").alias("inserted_runs"), F.col("application_examples.examples").alias("missing_items"))


@query()
def consolidated_acts(spark: SparkSession, d: str) -> DataFrame:
    """Acts through the whole layer: title, recitals, closing lines, annexes and items of one amending page each."""
    from actloom.plans.act_queries import _fronts, act_lines
    from actloom.plans.pipeline import consolidate

    got = consolidate(act_lines(spark, d), _fronts(spark, d), COLOR, matches=False)
    lines = got["paragraphs"]
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(C.has_inserted_style(F.col("runs")).cast("bigint")).alias("inserted"), F.sum(F.exists("runs", lambda r: r["kind"] == "delete").cast("bigint")).alias("struck"))


@query()
def revision_formatting(spark: SparkSession, d: str) -> DataFrame:
    return H.revision_formatting(P.next_layer(applied(spark, d, False)), COLOR)


@query()
def applied_proofs(spark: SparkSession, d: str) -> DataFrame:
    return H.operation_proofs(applied(spark, d, False).where("part = 'item'"))


@query()
def inserted_article_placement(spark: SparkSession, d: str) -> DataFrame:
    """Of every item as if it inserted its target article into its act: where headings and texts stand."""
    from actloom.plans.act_queries import act_lines

    todo = A.identify(items(spark, d)).select("doc_id", "item_idx", "text", F.col("target_article_number").alias("inserted_article_marker"), F.col("article_number").alias("target_article_number"))
    return H.placement(todo, act_lines(spark, d))


_A, _B = swords(sclean("best_match_text")), swords(sclean("amending_text"))


def _revised(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "amendment_analysis").where("best_match_text is not null and amending_text is not null")
    return rows.select("analysis_id", "best_match_text", "amending_text", V.revision_runs(COLOR)("best_match_text", "amending_text").alias("runs"))


@query(f"SELECT analysis_id, {sclean('amending_text')} AS effective FROM amendment_analysis WHERE best_match_text IS NOT NULL AND amending_text IS NOT NULL")
def effective_text(spark: SparkSession, d: str) -> DataFrame:
    """The text that stands after revision is the amendment, whatever the runs look like."""
    return _revised(spark, d).select("analysis_id", C.effective_text(F.col("runs")).alias("effective"))


_BARE = lambda c: rf"regexp_replace(coalesce({c}, ''), '(?:{WS}|[\x{{27}}\x{{22}}“”‘’`´])+', '', 'g')"
_QUOTED = "translate(amending_text, chr(8216) || chr(8217) || chr(8220) || chr(8221) || chr(39), repeat(chr(34), 5))"


@query(f"SELECT analysis_id, coalesce(best_match_text, '') <> '' AND coalesce(amending_text, '') <> '' AND {_BARE('best_match_text')} = {_BARE('amending_text')} AS same, coalesce(amending_text, '') <> '' AND {_BARE('amending_text')} = {_BARE(_QUOTED)} AS requoted FROM amendment_analysis")
def quote_changes(spark: SparkSession, d: str) -> DataFrame:
    """Whether match and amendment, and the amendment and itself in other quotes, differ in quotes and spaces only."""
    a, b = F.col("best_match_text"), F.col("amending_text")
    return table(spark, d, "amendment_analysis").select("analysis_id", X.is_quote_change(a, b).alias("same"), X.is_quote_change(b, F.translate(b, "‘’“”'", '"' * 5)).alias("requoted"))


_LINE = "CASE WHEN analysis_id % 3 = 0 THEN amending_text ELSE best_match_text END"


@query(f"SELECT CAST(act_id AS VARCHAR) AS doc_id, analysis_id AS ord FROM (SELECT act_id, analysis_id, {sclean(_LINE)} t FROM amendment_analysis) a WHERE t <> '' AND EXISTS (SELECT 1 FROM amendment_analysis b WHERE b.act_id = a.act_id AND {sclean('b.amending_text')} = t)")
def retrofitted(spark: SparkSession, d: str) -> DataFrame:
    """Matched texts of an act that an amendment of the act inserts as they are."""
    a = table(spark, d, "amendment_analysis").withColumn("doc_id", F.col("act_id").cast("string"))
    # a third of the lines are amendments themselves, as they stand in an act that has been amended
    line = F.when(F.col("analysis_id") % 3 == 0, F.concat(F.lit(" "), "amending_text")).otherwise(F.col("best_match_text"))
    lines = a.select("doc_id", F.col("analysis_id").alias("ord"), line.alias("text")).where("text is not null")
    return H.retrofit(lines, a.select("doc_id", "amending_text")).select("doc_id", "ord")


_LABEL = "target_annex_number || CASE WHEN act_id % 2 = 0 THEN 'A' ELSE '' END"


@query(f"""WITH w AS (SELECT DISTINCT act_id, upper({_LABEL}) AS label FROM amendment_analysis WHERE target_annex_number IS NOT NULL), h AS (SELECT DISTINCT act_id, upper(regexp_extract(provision_id, '^annex_([a-z]+)_block', 1)) AS label FROM text_blocks WHERE text IS NOT NULL AND regexp_matches(provision_id, '^annex_[a-z]+_block'))
  SELECT CAST(w.act_id AS VARCHAR) AS doc_id, w.label, h.label IS NOT NULL AS present, true AS in_order FROM w LEFT JOIN h ON h.act_id = w.act_id AND h.label = w.label""")
def annex_checks(spark: SparkSession, d: str) -> DataFrame:
    """Whether the annexes that items aim at stand in their act, those of every other act with a letter behind the numeral."""
    from actloom.plans.act_queries import act_lines

    label = F.concat("target_annex_number", F.when(F.col("act_id") % 2 == 0, "A").otherwise(""))
    todo = table(spark, d, "amendment_analysis").where("target_annex_number is not null").select(F.col("act_id").cast("string").alias("doc_id"), F.concat(F.lit("The text is inserted as Annex "), label).alias("source_instruction"))
    return H.annex_checks(todo, act_lines(spark, d))


@query()
def revision_runs(spark: SparkSession, d: str) -> DataFrame:
    kind = lambda k: F.size(F.filter("runs", lambda r: r["kind"] == k))
    return _revised(spark, d).select("analysis_id", kind("equal").alias("equal"), kind("delete").alias("deleted"), kind("insert").alias("inserted"), K.inserted_words(F.col("runs")).alias("new_words"))


@query(f"SELECT analysis_id, len(list_filter({_B}, lambda x: NOT list_contains({_A}, x))) > 0 AS adds_words FROM amendment_analysis WHERE best_match_text IS NOT NULL AND amending_text IS NOT NULL")
def added_words(spark: SparkSession, d: str) -> DataFrame:
    from actloom.functions import tokens as T

    rows = table(spark, d, "amendment_analysis").where("best_match_text is not null and amending_text is not null")
    new = F.array_except(T.words(X.clean(F.col("amending_text"))), T.words(X.clean(F.col("best_match_text"))))
    return rows.select("analysis_id", (F.size(new) > 0).alias("adds_words"))


def _annex_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "text_blocks").where("text is not null and provision_id like 'annex_%'")
    n = F.regexp_extract("provision_id", r"_block_(\d+)$", 1).cast("bigint")
    return rows.select(F.concat_ws(":", "act_id", F.regexp_extract("provision_id", r"^annex_([a-z]+)_", 1)).alias("doc_id"), (n * 1_000_000_000 + F.col("block_id")).alias("ord"), "text", "lang")


_ANNEX = "SELECT act_id || ':' || regexp_extract(provision_id, '^annex_([a-z]+)_', 1) AS doc_id, CAST(regexp_extract(provision_id, '_block_([0-9]+)$', 1) AS BIGINT) * 1000000000 + block_id AS ord, text FROM text_blocks WHERE text IS NOT NULL AND starts_with(provision_id, 'annex_')"
_KINDS = steps(
    _ANNEX, ("t", sanchorless("text")), ("label", f"upper({sfirst(sunquoted('t'), r'(?i)^ANNEX\s+([IVXLC]+[A-Za-z]?)\b')})"), ("roman", sfirst("t", r"(?i)^([IVXLC]+)\.(?:\s|$)")), ("num", sfirst("t", r"(?i)^(\d+[A-Za-z]?)[.)](?:\s|$)")),
    ("alpha", sfirst("t", r"^([A-Z])\.(?:\s|$)")), ("point", sfirst("t", r"(?i)^\(([a-z]+)\)(?:\s|$)")),
    ("kind", "CASE WHEN t = '' THEN 'empty' WHEN label IS NOT NULL THEN 'annex_heading' WHEN roman IS NOT NULL THEN 'roman_heading' WHEN num IS NOT NULL THEN 'numeric_heading' WHEN alpha IS NOT NULL THEN 'alpha_heading' WHEN point IS NOT NULL THEN 'point' ELSE 'body' END"),
    ("v", "CASE kind WHEN 'empty' THEN '' WHEN 'annex_heading' THEN label WHEN 'roman_heading' THEN upper(roman) WHEN 'numeric_heading' THEN lower(num) WHEN 'alpha_heading' THEN alpha WHEN 'point' THEN lower(point) ELSE lower(trim(regexp_replace(t, '[^A-Za-z0-9]+', ' ', 'g'))) END"),
    ("r", "last_value(CASE WHEN kind = 'roman_heading' THEN v END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    ("isle", "sum(CASE WHEN kind = 'roman_heading' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY ord)"),
    ("n", "last_value(CASE WHEN kind = 'numeric_heading' THEN v END IGNORE NULLS) OVER (PARTITION BY doc_id, isle ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
)


@query(f"SELECT doc_id, ord, text, kind, CASE WHEN kind = 'numeric_heading' THEN concat_ws('>', r, v) WHEN kind IN ('alpha_heading', 'point', 'body') THEN concat_ws('>', r, n, v) ELSE v END AS value FROM ({_KINDS})")
def annex_keys(spark: SparkSession, d: str) -> DataFrame:
    return V.contextual_keys(_annex_lines(spark, d).select("doc_id", "ord", "text"))


@query()
def annex_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Each annex of an act against the same annex of the act before it, as if that were its earlier version."""
    lines = _annex_lines(spark, d).select("doc_id", "ord", "text")
    act, name = F.substring_index("doc_id", ":", 1).cast("bigint"), F.substring_index("doc_id", ":", -1)
    return V.align_annexes(lines.withColumn("doc_id", F.concat_ws(":", act + 1, name)), lines)


@query(
    """WITH f AS (SELECT act_id, pos, fn_id, text FROM footnotes UNION ALL SELECT act_id, NULL, fn_id, line FROM footnote_lines)
  SELECT CAST(act_id AS VARCHAR) AS doc_id, fn_id AS number, row_number() OVER (PARTITION BY act_id ORDER BY pos NULLS LAST, fn_id) AS new_id, coalesce(nullif(text, ''), '[Missing footnote text ' || fn_id || ']') AS body FROM f"""
)
def footnote_ids(spark: SparkSession, d: str) -> DataFrame:
    """Footnotes of each act renumbered by first appearance, those of the raw lines, which are never referred to, behind them."""
    f, lines = table(spark, d, "footnotes"), table(spark, d, "footnote_lines")
    one = lambda df, text: df.select(F.col("act_id").cast("string").alias("doc_id"), F.col("fn_id").cast("string").alias("number"), F.col(text).alias("body"))
    refs = f.select(F.col("act_id").cast("string").alias("doc_id"), "pos", F.col("fn_id").cast("string").alias("number"))
    got = H.footnote_ids(refs, one(f, "text").unionByName(one(lines, "line")))
    return got.select("doc_id", F.col("number").cast("bigint").alias("number"), "new_id", "body")


def _amending_pages(spark: SparkSession, d: str) -> DataFrame:
    """One amending page for each amending article of an act: each item's instruction and payload as two of its lines."""
    from actloom.plans.act_queries import escaped

    a = table(spark, d, "amendment_analysis").where("source_instruction is not null and amending_text is not null and article_number is not null")
    line = F.concat(F.lit('<p class="oj-normal">'), escaped(F.col("source_instruction")), F.lit('</p><p class="oj-normal">'), escaped(F.col("amending_text")), F.lit("</p>"))
    # the same article number may come up in any act, so the page is made per act and article
    body = a.groupBy("act_id", "article_number").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("analysis_id", line.alias("l")))), lambda x: x["l"]), "").alias("body"))
    page = F.concat(F.lit('<html><body><div class="eli-container"><div class="eli-subdivision" id="art_'), "article_number", F.lit('"><p class="oj-ti-art">Article '), "article_number", F.lit("</p>"), "body", F.lit("</div></div></body></html>"))
    return body.select(F.concat_ws(":", "act_id", "article_number").alias("doc_id"), page.alias("html"))


@query()
def collected_items(spark: SparkSession, d: str) -> DataFrame:
    """Items read back from amending pages."""
    from actloom.operators import collect
    from actloom.plans.pipeline import amending_lines
    from actloom.sources import html

    return collect.items(amending_lines(html.elements(_amending_pages(spark, d))))


_BOTH = "SELECT analysis_id, amending_text, best_match_text FROM amendment_analysis WHERE best_match_text IS NOT NULL AND amending_text IS NOT NULL"
_KEPT = f"FILTER (NOT ({V_NOISE}))"


@query(
    f"""WITH RECURSIVE v AS ({_BOTH}), p AS (SELECT analysis_id, {_B} a, {_A} b FROM v), {V_ROWS},
  x AS (SELECT analysis_id, token, count(*) FILTER (k = 's') s, count(*) FILTER (k = 'd') d FROM (SELECT analysis_id, 's' k, unnest(b) token FROM p UNION ALL SELECT analysis_id, 'd', unnest(a) FROM p) GROUP BY ALL),
  c AS (SELECT analysis_id, CASE WHEN sum(s) = 0 THEN 1.0 ELSE sum(least(s, d)) / sum(s) END strict, CASE WHEN coalesce(sum(s) {_KEPT}, 0) = 0 THEN 1.0 ELSE sum(least(s, d)) {_KEPT} / sum(s) {_KEPT} END practical FROM x GROUP BY analysis_id),
  l AS (SELECT analysis_id, CASE WHEN a = '' OR b = '' THEN length(a || b) ELSE levenshtein({V_SIGNS.format(c='a')}, {V_SIGNS.format(c='b')}) END n FROM ({V_CODED.replace('FROM amendment_analysis', f'FROM ({_BOTH})')}))
  SELECT p.analysis_id AS doc_id, coalesce(strict, 1.0) AS strict_coverage, coalesce(practical, 1.0) AS practical_coverage, l.n AS char_distance, cells[len(b) + 1] AS token_distance, coalesce(strict, 1.0) >= 0.995 OR coalesce(practical, 1.0) >= 0.985 AS passed
  FROM p JOIN r ON r.analysis_id = p.analysis_id AND i = len(a) JOIN l ON l.analysis_id = p.analysis_id LEFT JOIN c ON c.analysis_id = p.analysis_id"""
)
def verify_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every item's amendment checked against what it was matched with."""
    from actloom.plans.pipeline import verify

    a = table(spark, d, "amendment_analysis").where("best_match_text is not null and amending_text is not null")
    one = lambda c: a.select(F.col("analysis_id").alias("doc_id"), F.col(c).alias("text"))
    got = verify(one("amending_text"), one("best_match_text"))
    return got.select("doc_id", "strict_coverage", "practical_coverage", F.col("characters.distance").alias("char_distance"), F.col("tokens.distance").alias("token_distance"), "passed")


_BY_ARTICLE = "SELECT CAST(act_id AS VARCHAR) || ':' || article_number AS doc_id, row_number() OVER (PARTITION BY act_id, article_number ORDER BY analysis_id) - 1 AS ord, amending_text AS text FROM amendment_analysis WHERE article_number IS NOT NULL AND amending_text IS NOT NULL"
_FIT = "replace(replace(regexp_replace(text, '[\\x{00}-\\x{08}\\x{0b}\\x{0c}\\x{0e}-\\x{1f}\\x{fffe}\\x{ffff}]', '', 'g'), E'\\r\\n', E'\\n'), E'\\r', E'\\n')"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Word files of the amending articles, every item a paragraph."""
    from actloom.sources import docx

    a = table(spark, d, "amendment_analysis").where("article_number is not null and amending_text is not null")
    run = F.struct(F.col("amending_text").alias("text"), F.lit("insert").alias("kind"), F.lit(False).alias("strike"), F.lit(True).alias("double_underline"), F.lit(COLOR).alias("color"))
    return docx.to_files(a.select(F.concat_ws(":", "act_id", "article_number").alias("doc_id"), F.col("analysis_id").alias("ord"), F.array(run).alias("runs")))


@query(f"SELECT doc_id, ord, {_FIT} AS text, 1 AS inserted_runs FROM ({_BY_ARTICLE})")
def docx_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs that come back from documents written and read again."""
    from actloom.sources import docx

    return docx.read_paragraphs(_documents(spark, d)).select("doc_id", F.col("ord").cast("bigint").alias("ord"), "text", F.size(F.filter("runs", lambda r: (r["color"] == COLOR) & r["double_underline"])).alias("inserted_runs"))


@query(f"SELECT doc_id, string_agg(nullif(array_to_string({swords(_FIT)}, ' '), ''), ' ' ORDER BY ord) AS words FROM ({_BY_ARTICLE}) GROUP BY doc_id")
def docx_text(spark: SparkSession, d: str) -> DataFrame:
    """Words of the text of documents written and read again."""
    from actloom.functions import tokens as T
    from actloom.sources import docx

    return docx.read_text(_documents(spark, d)).select("doc_id", F.array_join(T.words(F.col("text")), " ").alias("words"))


@query("SELECT CAST(act_id AS VARCHAR) AS doc_id, row_number() OVER (PARTITION BY act_id ORDER BY fn_id) AS id, coalesce(nullif(trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), ''), 'Missing footnote text ' || fn_id) AS body FROM footnotes")
def docx_footnotes(spark: SparkSession, d: str) -> DataFrame:
    """Footnotes written into a document of each act, referred to in order of their ids, and read again."""
    from actloom.sources import docx

    f = table(spark, d, "footnotes").select(F.col("act_id").cast("string").alias("doc_id"), "fn_id", F.trim(F.regexp_replace("text", "[^A-Za-z0-9]+", " ")).alias("body"))
    run = F.struct(F.concat(F.lit("See [[FN:"), "fn_id", F.lit("]]")).alias("text"), F.lit("equal").alias("kind"), F.lit(False).alias("strike"), F.lit(False).alias("double_underline"), F.lit(None).cast("string").alias("color"))
    got = docx.read_footnotes(docx.to_files(f.select("doc_id", F.col("fn_id").alias("ord"), F.array(run).alias("runs")), f.select("doc_id", F.col("fn_id").alias("number"), "body")))
    return got.select("doc_id", F.col("id").cast("bigint").alias("id"), F.regexp_replace("body", r"[\[\]]", "").alias("body"))


@query()
def analysis_documents(spark: SparkSession, d: str) -> DataFrame:
    """The analysis document of each act: a summary line, the closest text and the amendment with its changes marked."""
    from actloom.sources import docx

    a = table(spark, d, "amendment_analysis").where("amending_text is not null")
    score = F.format_string("%.3f", F.coalesce("best_match_score", F.lit(0.0)))
    n = lambda c: F.coalesce(F.col(f"diff.{c}"), F.lit(0)).cast("string")
    summary = F.concat(F.lit("Article "), F.coalesce("article_number", F.lit("?")), F.lit(" | match="), score, F.lit(" | +"), n("inserted_words"), F.lit(" -"), n("deleted_words"), F.lit(" ~"), n("replaced_from_words"), F.lit("->"), n("replaced_to_words"))
    plain = lambda t: F.array(F.struct(t.alias("text"), F.lit("equal").alias("kind"), F.lit(False).alias("strike"), F.lit(False).alias("double_underline"), F.lit(None).cast("string").alias("color")))
    marked = F.transform(V.highlighted(COLOR)("best_match_text", "amending_text"), lambda r: F.struct(F.concat(r["text"], F.lit(" ")).alias("text"), F.when(r["changed"], "insert").otherwise("equal").alias("kind"), F.lit(False).alias("strike"), r["changed"].alias("double_underline"), r["color"].alias("color")))
    lines = a.select(F.col("act_id").cast("string").alias("doc_id"), "analysis_id", F.posexplode(F.array(plain(summary), plain(F.coalesce("best_match_text", F.lit(""))), marked)).alias("k", "runs"))
    files = docx.to_files(lines.select("doc_id", (F.col("analysis_id") * 3 + F.col("k")).alias("ord"), "runs"))
    return docx.read_paragraphs(files).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.size("runs")).alias("runs"), F.sum(F.startswith("text", F.lit("Article ")).cast("bigint")).alias("summaries"))


_FIELDS = ("analysis_id", "article_number", "amending_text", "source_instruction", "best_match_index", "best_match_score", "applied_mode")


@query(f"SELECT {', '.join(_FIELDS)} FROM amendment_analysis")
def json_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Items written as JSON lines and read again."""
    from actloom.sources import files

    rows = table(spark, d, "amendment_analysis").select(*_FIELDS)
    path = scratch(spark, "json")
    files.write_json(rows, path)
    return spark.read.json(path, schema=rows.schema)


@query("SELECT fn_id, nullif(marker, '') AS marker, regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g') AS text FROM footnotes")
def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as CSV and read again."""
    from actloom.sources import files

    rows = table(spark, d, "footnotes").select("fn_id", F.nullif("marker", F.lit("")).alias("marker"), F.regexp_replace("text", "[^A-Za-z0-9]+", " ").alias("text"))
    path = scratch(spark, "csv")
    files.write_csv(rows, path)
    return spark.read.csv(path, schema=rows.schema, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="")


@query("SELECT block_id AS id, CASE WHEN block_id % 2 = 0 THEN text ELSE regexp_replace(text, '[^ -~]', '?', 'g') END AS html FROM text_blocks WHERE text <> ''")
def encodings(spark: SparkSession, d: str) -> DataFrame:
    """Texts as the bytes of two encodings, read back by the cascade: UTF-8 as it is, the others as ASCII with signs for the rest."""
    from actloom.sources import html

    t = table(spark, d, "text_blocks").where("text <> ''")
    raw = F.when(F.col("block_id") % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode(F.regexp_replace("text", "[^ -~]", "?"), "ISO-8859-1"))
    return html.decoded(t.select(F.col("block_id").cast("string").alias("doc_id"), raw.alias("content"))).select(F.col("doc_id").cast("bigint").alias("id"), "html")


@query(f"SELECT strftime(date_trunc('day', loaded_at), '%Y-%m-%d') AS day, {L._KIND} AS kind, count(*) AS n FROM (SELECT loaded_at, lower({sclean('source_instruction')}) i, {sclean('amending_text')} t FROM amendment_analysis WHERE loaded_at IS NOT NULL) GROUP BY ALL")
def arrivals(spark: SparkSession, d: str) -> DataFrame:
    """Items by day of arrival and kind, as the stream's aggregate gives them over a table at rest."""
    from actloom.streaming import layers

    a = table(spark, d, "amendment_analysis").withColumn("text", F.col("amending_text"))
    return layers.arrivals(a).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "kind", "n")

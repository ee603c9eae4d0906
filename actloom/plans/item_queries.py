"""The chain from raw items to resolved ones, and the audits of applied items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.operators import amendments as A
from actloom.operators import checks as H
from actloom.plans.registry import query, sclean, sfirst, steps, swords, table
from actloom.plans import line_queries as L

TARGETS = A.TARGETS
SHOWN = ("item_idx", "text", "source_instruction", "amendment_kind", *TARGETS)


def items(spark: SparkSession, d: str) -> DataFrame:
    """Amendment items of every act in order of analysis."""
    a = table(spark, d, "amendment_analysis")
    return a.select(F.col("act_id").cast("string").alias("doc_id"), F.col("analysis_id").alias("item_idx"), "article_number", "article_heading", F.col("amending_text").alias("text"), "amending_text", "source_instruction", *TARGETS, "applied_mode", F.lit(None).cast("string").alias("amendment_kind"))


_ITEMS = f"SELECT CAST(act_id AS VARCHAR) doc_id, analysis_id item_idx, article_heading, amending_text text, source_instruction, {', '.join(TARGETS)} FROM amendment_analysis"
_I = sclean("source_instruction")


_NUMBER = r"\b(\d{4}/\d{1,4})\b"


@query(f"SELECT i.doc_id, i.item_idx FROM ({_ITEMS}) i JOIN (SELECT CAST(act_id AS VARCHAR) doc_id, {sfirst('arg_min(article_heading, analysis_id)', _NUMBER)} r FROM amendment_analysis GROUP BY act_id) t USING (doc_id) WHERE contains(lower({sclean('article_heading')}), r) OR contains(lower({_I}), r)")
def items_relevant(spark: SparkSession, d: str) -> DataFrame:
    """Items that amend the regulation which their act's first item names."""
    own = items(spark, d)
    first = own.groupBy("doc_id").agg(F.nullif(F.regexp_extract(F.min_by("article_heading", "item_idx"), _NUMBER, 1), F.lit("")).alias("r"))
    return A.relevant(own.join(first, "doc_id").where("r is not null"), F.col("r")).select("doc_id", "item_idx")


@query(
    f"""WITH i AS ({_ITEMS}), m AS (SELECT *, {sclean('text')} c, regexp_full_match({sclean('text')}, '(?i)\\([a-z]+\\)') lone FROM i),
  n AS (SELECT *, lead(c) OVER w nc, lead(lone) OVER w nl, lead(source_instruction) OVER w ni FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY item_idx)),
  j AS (SELECT *, lone AND coalesce(nc <> '' AND NOT nl, false) joins FROM n), k AS (SELECT *, coalesce(lag(joins) OVER (PARTITION BY doc_id ORDER BY item_idx), false) taken FROM j)
  SELECT doc_id, item_idx, CASE WHEN joins THEN c || E'\\t' || nc ELSE text END AS text, CASE WHEN joins AND coalesce(ni, '') <> '' THEN ni ELSE source_instruction END AS source_instruction FROM k WHERE NOT taken"""
)
def items_coalesced(spark: SparkSession, d: str) -> DataFrame:
    return A.coalesce_markers(items(spark, d)).select("doc_id", "item_idx", "text", "source_instruction")


def _normalized(source: str) -> str:
    """Kind and payload of the items of ``source``."""
    given = steps(source, ("i0", sclean("source_instruction")), ("i", "lower(i0)"), ("t", sclean("text")), ("pm", sclean("target_point_marker")), ("amendment_kind", L._KIND))
    made = L.spayload(given, "text")
    named = r"list_contains(list_transform(regexp_extract_all(i0, '(?i)\bpoint\s*\(([a-z]+)\)', 1), lambda x: lower(x)), lower(pm))"
    return steps(
        made, ("deletes", "amendment_kind = 'deletion'"), ("n1", f"CASE WHEN deletes THEN CASE WHEN coalesce(text, '') <> '' THEN t ELSE i0 END ELSE payload END"),
        ("n2", r"CASE WHEN regexp_full_match(n1, '(?i)[IVXLC]+\.') AND regexp_matches(i0, '(?i)\bin\s+Annex\b') AND regexp_matches(i0, '(?i)\breplaced by the following\b') THEN '' ELSE n1 END"),
        ("n3", rf"CASE WHEN pm <> '' AND n2 <> '' AND NOT deletes AND ({named} OR regexp_matches(i0, '(?i)\bthe following points?\s+(?:is|are)\s+(?:added|inserted)\b')) AND {sfirst(sclean('n2'), r'(?i)^\(([a-z]+)\)')} IS NULL THEN '(' || pm || E')\t' || n2 ELSE n2 END"),
    )


_NORMAL = f"SELECT doc_id, item_idx, n3 AS text, source_instruction, amendment_kind, {', '.join(TARGETS)} FROM ({{}}) WHERE n3 <> '' OR deletes"


@query(_NORMAL.format(_normalized(_ITEMS)))
def items_normalized(spark: SparkSession, d: str) -> DataFrame:
    return A.normalize(items(spark, d)).select("doc_id", *SHOWN)


_ART, _PAR = f"coalesce({L._ARTS})", rf"coalesce({sfirst('i', r'(?i)\bparagraph\s+(\d+[A-Za-z]?)\b')}, {sfirst('i', r'(?i)\bArticle\s+\d+[A-Za-z]?\s*\((\d+[A-Za-z]?)\)')})"
_PT, _AN, _AP = f"lower({sfirst('i', r'(?i)\bpoint\s*\(([a-z]+)\)')})", f"upper({sfirst('i', r'(?i)\bin\s+Annex\s+([IVXLC]+)\b')})", f"lower({sfirst('i', r'(?i)\bpoint\s+([IVXLC]+)\b')})"
def _backfill(source: str, also: str = "") -> str:
    return f"""
  WITH i AS ({source}), x AS (SELECT *, {_I} i FROM i), y AS (SELECT *, {_ART} art, {_PAR} par, {_PT} pt, {_AN} an, {_AP} ap, i <> '' AND coalesce(target_annex_number, '') = '' AND {_AN} IS NOT NULL takes FROM x),
  b AS (SELECT *, CASE WHEN takes THEN NULL ELSE coalesce(art, nullif(target_article_number, '')) END base FROM y),
  c AS (SELECT *, last_value(base IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY item_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) carry FROM b),
  z AS (SELECT doc_id, item_idx, i, {also} CASE WHEN takes THEN NULL ELSE coalesce(base, CASE WHEN i <> '' AND regexp_matches(i, '(?i)\\b(?:paragraph|subparagraph|point|points|introductory wording)\\b') THEN carry END, target_article_number) END target_article_number,
    CASE WHEN takes THEN NULL WHEN i <> '' AND coalesce(target_paragraph_number, '') = '' THEN coalesce(par, target_paragraph_number) ELSE target_paragraph_number END target_paragraph_number,
    CASE WHEN takes THEN NULL WHEN i <> '' AND coalesce(target_point_marker, '') = '' THEN coalesce(pt, target_point_marker) ELSE target_point_marker END target_point_marker,
    CASE WHEN takes THEN an ELSE target_annex_number END target_annex_number, CASE WHEN i <> '' AND coalesce(target_annex_point_marker, '') = '' THEN coalesce(ap, target_annex_point_marker) ELSE target_annex_point_marker END target_annex_point_marker FROM c)"""


_BACKFILL = _backfill(_ITEMS)


@query(f"{_BACKFILL} SELECT doc_id, item_idx, {', '.join(TARGETS)} FROM z")
def items_backfilled(spark: SparkSession, d: str) -> DataFrame:
    return A.backfill(items(spark, d)).select("doc_id", "item_idx", *TARGETS)


_REPLACED = f""", r AS (SELECT *, regexp_matches(i, '(?i)\\breplaced by the following\\b') on_ FROM z), s AS (SELECT *, CASE WHEN on_ THEN {_AN} END an, CASE WHEN on_ THEN {_PT} END pt, CASE WHEN on_ THEN {_AP} END ap FROM r)
  SELECT doc_id, item_idx, {{}} CASE WHEN an IS NULL THEN target_article_number END target_article_number, CASE WHEN an IS NULL THEN target_paragraph_number END target_paragraph_number,
  CASE WHEN an IS NULL THEN coalesce(pt, target_point_marker) END target_point_marker, coalesce(an, target_annex_number) target_annex_number, coalesce(ap, target_annex_point_marker) target_annex_point_marker FROM s"""


@query(_BACKFILL + _REPLACED.format(""))
def items_replacement_targets(spark: SparkSession, d: str) -> DataFrame:
    return A.replacement_targets(A.backfill(items(spark, d))).select("doc_id", "item_idx", *TARGETS)


_COALESCED = f"""SELECT doc_id, item_idx, CASE WHEN joins THEN c || E'\\t' || nc ELSE text END AS text, CASE WHEN joins AND coalesce(ni, '') <> '' THEN ni ELSE source_instruction END AS source_instruction,
    CASE WHEN joins AND coalesce(target_article_number, '') = '' THEN coalesce(na, target_article_number) ELSE target_article_number END AS target_article_number,
    CASE WHEN joins AND coalesce(target_paragraph_number, '') = '' THEN coalesce(np, target_paragraph_number) ELSE target_paragraph_number END AS target_paragraph_number,
    CASE WHEN joins THEN lower(regexp_extract(c, '(?i)^\\(([a-z]+)\\)$', 1)) ELSE target_point_marker END AS target_point_marker, target_annex_number, target_annex_point_marker
  FROM (SELECT *, coalesce(lag(joins) OVER (PARTITION BY doc_id ORDER BY item_idx), false) taken FROM (SELECT *, lone AND coalesce(nc <> '' AND NOT nl, false) joins FROM
    (SELECT *, lead(c) OVER w nc, lead(lone) OVER w nl, lead(source_instruction) OVER w ni, lead(target_article_number) OVER w na, lead(target_paragraph_number) OVER w np FROM
      (SELECT *, {sclean('text')} c, regexp_full_match({sclean('text')}, '(?i)\\([a-z]+\\)') lone FROM ({_ITEMS})) WINDOW w AS (PARTITION BY doc_id ORDER BY item_idx)))) WHERE NOT taken"""
_SHOWN = "text, source_instruction, amendment_kind, "
_IDENTIFIED = _backfill(_NORMAL.format(_normalized(_COALESCED)), _SHOWN) + _REPLACED.format(_SHOWN)


@query(_IDENTIFIED)
def items_identified(spark: SparkSession, d: str) -> DataFrame:
    return A.identify(items(spark, d)).select("doc_id", *SHOWN)


_AFTER = "'the following subparagraph is inserted'"


def _article_runs(spark: SparkSession, d: str) -> DataFrame:
    """Items whose inserted subparagraphs are taken for inserted articles without target; each text names a lettered article twice behind its own."""
    i = F.replace("source_instruction", F.lit(_AFTER[1:-1]), F.lit("the following articles are inserted"))
    named = F.concat(F.lit("Article "), "article_number", F.lit("a"))
    rows = items(spark, d).withColumn("source_instruction", i)
    return rows.withColumns({"target_article_number": F.when(~F.coalesce(F.contains("source_instruction", F.lit("articles are inserted")), F.lit(False)), F.col("target_article_number")), "text": F.concat_ws(" ", "text", named, named)})


@query(
    rf"""WITH i AS (SELECT CAST(act_id AS VARCHAR) doc_id, analysis_id item_idx, concat_ws(' ', amending_text, 'Article ' || article_number || 'a', 'Article ' || article_number || 'a') t,
    coalesce(contains(source_instruction, {_AFTER}), false) on_ FROM amendment_analysis),
  r AS (SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY item_idx) run FROM (SELECT *, CASE WHEN on_ AND NOT coalesce(lag(on_) OVER (PARTITION BY doc_id ORDER BY item_idx), false) THEN 1 ELSE 0 END turn FROM i)),
  o AS (SELECT * FROM r WHERE on_), g AS (SELECT doc_id, run, min(item_idx) first_idx, count(*) n FROM o GROUP BY ALL),
  l AS (SELECT doc_id, run, item_idx, list_transform(regexp_extract_all({sclean('t')}, '(?i)\bArticle\s+(\d+[A-Za-z])\b', 1), lambda x: lower(x)) ms FROM o),
  m AS (SELECT doc_id, run, item_idx, unnest(ms) marker, generate_subscripts(ms, 1) p FROM l), c AS (SELECT doc_id, run, marker, count(*) mentions, min(item_idx * 1000000 + p) at_ FROM m GROUP BY ALL),
  b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY mentions DESC, at_) k FROM c)
  SELECT g.doc_id, CAST(g.run AS BIGINT) run, first_idx, n, marker, mentions FROM g LEFT JOIN (SELECT * FROM b WHERE k = 1 AND mentions >= 2) b ON g.doc_id = b.doc_id AND g.run = b.run"""
)
def items_insertion_runs(spark: SparkSession, d: str) -> DataFrame:
    return A.insertion_runs(_article_runs(spark, d))


@query()
def items_insert_after(spark: SparkSession, d: str) -> DataFrame:
    """Runs whose lettered article an act lacks although it has the base article."""
    from actloom.operators import ranges
    from actloom.plans.act_queries import act_lines

    return A.insert_after(A.insertion_runs(_article_runs(spark, d)), ranges.article_sections(act_lines(spark, d)))


_KEYS = ", ".join(f"{sclean(c)} k{n}" for n, c in enumerate(("article_number", *TARGETS, "source_instruction")))
_OP = L._OPERATION
_ORDINAL = r"regexp_matches(i, '\b(?:first|second|third|fourth|fifth)\s+(?:sub)?paragraph\b')"
_PROOFS = f"""SELECT doc_id, 'op_' || CASE WHEN n < 10000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END operation_id, op operation_type, p target_path, x has_amending_text, y has_scope_target, z has_required_paragraph_scope, x AND y AND z preconditions_passed, m mutation_proven,
  CASE WHEN x AND y AND z AND m THEN 'proven' ELSE 'unresolved' END status FROM (SELECT doc_id, n, op, p, m, x, op NOT IN ('replace', 'delete') OR ta <> '' OR tn <> '' y, NOT (op IN ('replace', 'delete') AND {_ORDINAL}) OR tp <> '' z FROM
  (SELECT *, {_OP} op FROM (SELECT CAST(act_id AS VARCHAR) doc_id, row_number() OVER (PARTITION BY act_id ORDER BY analysis_id) n, lower({_I}) i, {L._PATH} p, {sclean('amending_text')} <> '' x, {sclean('target_article_number')} ta,
  {sclean('target_annex_number')} tn, {sclean('target_paragraph_number')} tp, {sclean('applied_mode')} IN ('replaced', 'inserted', 'already_applied') m FROM amendment_analysis)))"""


@query(_PROOFS)
def operation_proofs(spark: SparkSession, d: str) -> DataFrame:
    return H.operation_proofs(items(spark, d).drop("amendment_kind"))


@query(f"SELECT doc_id, count(*) operations_total, count(*) FILTER (NOT preconditions_passed) precondition_failures, count(*) FILTER (status <> 'proven') unresolved_operations, count(*) FILTER (status <> 'proven') = 0 all_operations_proven FROM ({_PROOFS}) GROUP BY doc_id")
def operation_summary(spark: SparkSession, d: str) -> DataFrame:
    return H.proof_summary(H.operation_proofs(items(spark, d).drop("amendment_kind")))


def _output(spark: SparkSession, d: str) -> DataFrame:
    """Visible text of an act: the texts its items were matched with."""
    a = table(spark, d, "amendment_analysis").where("best_match_text is not null")
    return a.select(F.col("act_id").cast("string").alias("doc_id"), F.col("analysis_id").alias("ord"), F.col("best_match_text").alias("text"))


_w = swords
_OUT = f"SELECT CAST(act_id AS VARCHAR) doc_id, ' ' || string_agg(nullif(array_to_string({_w(sclean('best_match_text'))}, ' '), ''), ' ' ORDER BY analysis_id) || ' ' h FROM amendment_analysis WHERE best_match_text IS NOT NULL GROUP BY act_id"
_FN = r"regexp_replace(coalesce(amending_text, ''), '\[\[FN:\d+\]\]', ' ', 'g')"


def _has(p: str, *lengths: int) -> str:
    run = lambda n: f"contains(h, ' ' || array_to_string(list_slice({p}, 1, {n}), ' ') || ' ')"
    return f"(len({p}) > 0 AND coalesce({' OR '.join(f'(len({p}) > {n} AND {run(n)})' if k else run(n) for k, n in enumerate(lengths))}, false))"


_APP = f"""WITH o AS ({_OUT}), i AS (SELECT CAST(act_id AS VARCHAR) doc_id, analysis_id, {sclean('applied_mode')} mode, {_I} i, lower({sclean('target_point_marker')}) p, {', '.join(f'{sclean(c)} {c}' for c in TARGETS)}, list_slice({_w(sclean(_FN))}, 1, 24) p24, list_slice({_w(sclean(_FN))}, 1, 16) p16 FROM amendment_analysis),
  f AS (SELECT i.*, {_has('p24', 24, 18, 12, 8)} f24, {_has('p16', 16, 12, 8, 6)} f16, regexp_matches(i, '(?i)\\breplaced by the following\\b') rep FROM i LEFT JOIN o USING (doc_id)),
  g AS (SELECT doc_id, bool_or(mode IN ('replaced', 'already_applied') OR f16) ok, arg_min(mode, analysis_id) m, arg_min(p, analysis_id) pm, i FROM f WHERE rep GROUP BY doc_id, i, {', '.join(TARGETS)}),
  b AS (SELECT doc_id, count(*) n FROM g WHERE NOT ok AND NOT (m = 'analysis_only' AND ((pm <> '' AND regexp_full_match(pm, 'm{{0,4}}(cm|cd|d?c{{0,3}})(xc|xl|l?x{{0,3}})(ix|iv|v?i{{0,3}})')) OR regexp_matches(i, '(?i)\\bintroductory\\s+(?:wording|sentence)\\b'))) GROUP BY doc_id)
  SELECT f.doc_id, count(*) FILTER (mode = 'inserted') inserted_items_checked, count(*) FILTER (mode = 'inserted' AND len(p24) > 0 AND NOT f24) inserted_items_missing_from_output, count(*) FILTER (mode = 'replaced') replaced_items_checked,
  count(*) FILTER (mode = 'replaced' AND f16) replaced_items_with_new_text_detected, count(*) FILTER (rep) replacement_instruction_items_checked, coalesce(max(b.n), 0) replacement_instruction_items_not_properly_applied FROM f LEFT JOIN b USING (doc_id) GROUP BY f.doc_id"""


@query(_APP)
def application_check(spark: SparkSession, d: str) -> DataFrame:
    return H.application(items(spark, d), _output(spark, d))


_ONEGO = f"""WITH o AS ({_OUT}), i AS (SELECT CAST(act_id AS VARCHAR) doc_id, analysis_id, {sclean('applied_mode')} mode, {_KEYS}, list_slice({_w(sclean('amending_text'))}, 1, 24) p FROM amendment_analysis),
  f AS (SELECT i.*, mode <> 'analysis_only' OR {_has('p', 8)} OR (len(p) >= 8 AND coalesce(regexp_matches(h, ' ' || array_to_string(list_slice(p, 1, 8), ' (?:[^ ]+ )*') || ' '), false)) ok FROM i LEFT JOIN o USING (doc_id) WHERE len(p) > 0),
  g AS (SELECT *, bool_or(ok) OVER (PARTITION BY doc_id, {', '.join(f'k{n}' for n in range(7))}) okay FROM f)
  SELECT doc_id, bool_and(okay) passed, count(*) substantive_items_total, count(*) FILTER (NOT okay) substantive_items_not_fully_applied, list_slice(coalesce(list(analysis_id ORDER BY analysis_id) FILTER (NOT okay), []), 1, 25) examples FROM g GROUP BY doc_id"""


@query(_ONEGO)
def one_go_check(spark: SparkSession, d: str) -> DataFrame:
    return H.one_go(items(spark, d), _output(spark, d))

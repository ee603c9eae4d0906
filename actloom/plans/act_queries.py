"""Sections, blocks and order of acts; pages parsed back into the parts they were made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.operators import annexes as N
from actloom.operators import checks as H
from actloom.operators import preamble as P
from actloom.operators import ranges as R
from actloom.operators import structure as S
from actloom.plans import line_queries as L
from actloom.plans.registry import query, sclean, sfirst, steps, table
from actloom.runtime import spread, written
from actloom.sources import html


_KEPT = r"text is not null and regexp_like(provision_id, '^article_[a-z0-9]+_block_[0-9]+$')"


def paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, ord, text): the blocks of every article of an act behind a heading; ord follows the block number."""
    rows = table(spark, d, "text_blocks").where(_KEPT).withColumn("a", F.regexp_extract("provision_id", r"^article_([a-z0-9]+)_block_(\d+)$", 1))
    n = F.regexp_extract("provision_id", r"_block_(\d+)$", 1).cast("bigint")
    doc = F.concat_ws(":", "act_id", "a")
    lines = rows.select(doc.alias("doc_id"), (n * 1_000_000_000 + F.col("block_id")).alias("ord"), "text")
    heads = rows.select(doc.alias("doc_id"), F.lit(0).cast("bigint").alias("ord"), F.concat(F.lit("Article "), "a").alias("text")).distinct()
    return lines.unionByName(heads)


def act_lines(spark: SparkSession, d: str, numbered: bool = False) -> DataFrame:
    """(doc_id, ord, text): all blocks of an act, each article and annex behind a heading, in the order of their numbers; ``numbered``: behind a roman numeral."""
    rows = table(spark, d, "text_blocks").where("text is not null")
    if numbered:
        rows = rows.withColumn("text", F.concat(G.roman(F.regexp_extract("provision_id", r"_block_(\d+)$", 1).try_cast("bigint") % 399 + 1), F.lit(". "), "text"))
    rows = rows.withColumns({"kind": F.regexp_extract("provision_id", r"^(article|annex)_([a-z0-9]+)_block_(\d+)$", 1), "name": F.regexp_extract("provision_id", r"^(article|annex)_([a-z0-9]+)_block_(\d+)$", 2)})
    rows = rows.where("kind <> ''").withColumn("no", F.coalesce(F.regexp_extract("name", r"^\d+", 0).try_cast("int"), G.roman_value(F.col("name"))) + F.when(F.col("kind") == "annex", 100_000).otherwise(0))
    doc = F.col("act_id").cast("string").alias("doc_id")
    lines = rows.select(doc, "no", "name", F.regexp_extract("provision_id", r"_block_(\d+)$", 1).cast("bigint").alias("n"), "block_id", "text")
    head = F.when(F.col("kind") == "annex", F.concat(F.lit("ANNEX "), F.upper("name"))).otherwise(F.concat(F.lit("Article "), "name"))
    heads = rows.select(doc, "no", "name", F.lit(-1).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("block_id"), head.alias("text")).distinct()
    ord_ = F.row_number().over(Window.partitionBy("doc_id").orderBy("no", "name", "n", "block_id")) - 1
    return lines.unionByName(heads).select("doc_id", ord_.cast("bigint").alias("ord"), "text")


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, ord, text): the lines of every document."""
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))


_L = "SELECT doc_id, generate_subscripts(string_split(text, E'\\n'), 1) - 1 ord, unnest(string_split(text, E'\\n')) text FROM documents WHERE text IS NOT NULL"
_A = "regexp_extract(provision_id, '^article_([a-z0-9]+)_block', 1)"
_B = "FROM text_blocks WHERE text IS NOT NULL AND regexp_matches(provision_id, '^article_[a-z0-9]+_block_[0-9]+$')"
_P = f"""SELECT act_id || ':' || {_A} doc_id, CAST(regexp_extract(provision_id, '_block_([0-9]+)$', 1) AS BIGINT) * 1000000000 + block_id ord, text {_B} UNION ALL SELECT DISTINCT act_id || ':' || {_A}, 0, 'Article ' || {_A} {_B}"""
_M = f"""WITH p AS ({_P}), m AS (SELECT doc_id, ord, {sclean('text')} c FROM p), h AS (SELECT doc_id, ord, c, lower({sfirst('c', r'(?i)^Article\s+(\d+[A-Za-z]?)\b')}) article, regexp_matches(c, '(?i)^(?:CHAPTER|ANNEX)\\b') hard,
  upper({sfirst('c', r'(?i)^ANNEX\s+([IVXLC]+)\b')}) annex FROM m), z AS (SELECT doc_id, max(ord) + 1 size FROM m GROUP BY doc_id),
  s AS (SELECT doc_id, article, ord lo, coalesce(nxt, size) hi FROM (SELECT *, lead(ord) OVER (PARTITION BY doc_id ORDER BY ord) nxt FROM h WHERE article IS NOT NULL OR hard) JOIN z USING (doc_id) WHERE article IS NOT NULL)"""
_ML = _M.replace(_P, _L)
_QUOTED = "^[‘'\"]?"
_MARK = sfirst("c", _QUOTED + r"(\d+[A-Za-z]?)\.")
_SPACED = "lower(" + sfirst("c", _QUOTED + r"(\d+[A-Za-z]?)\.(?:\s|$)") + ")"
_IN = ", i AS (SELECT m.doc_id, m.ord, m.c, s.article, s.lo, s.hi FROM m JOIN s ON m.doc_id = s.doc_id AND m.ord >= s.lo AND m.ord < s.hi)"
_BLOCKS = f"{_IN}, b AS (SELECT doc_id, article, marker, ord start, coalesce(lead(ord) OVER (PARTITION BY doc_id, lo ORDER BY ord), hi) stop, lo section FROM (SELECT *, {_MARK} marker FROM i) WHERE marker IS NOT NULL)"


@query(f"{_ML} SELECT doc_id, article, row_number() OVER (PARTITION BY doc_id, article ORDER BY lo) nth, lo AS start, hi AS stop FROM s")
def article_bounds(spark: SparkSession, d: str) -> DataFrame:
    return R.article_sections(document_lines(spark, d))


@query(f"{_ML} SELECT doc_id, annex, row_number() OVER (PARTITION BY doc_id, annex ORDER BY ord) nth, ord AS start, coalesce(lead(ord) OVER (PARTITION BY doc_id ORDER BY ord), size) AS stop FROM h JOIN z USING (doc_id) WHERE annex IS NOT NULL")
def annex_bounds(spark: SparkSession, d: str) -> DataFrame:
    return R.annex_sections(document_lines(spark, d))


@query(f"{_M}{_BLOCKS} SELECT doc_id, article, marker, start, stop, section FROM b")
def paragraph_blocks(spark: SparkSession, d: str) -> DataFrame:
    return R.paragraph_blocks(paragraphs(spark, d))


_SMALL = "('" + "', '".join(C.SMALL_ROMANS) + "')"
_PTS = f"""{_IN}, u AS (SELECT *, {_MARK} para, lower({sfirst('c', r"(?i)^\(([a-z]+)\)")}) point FROM i), v AS (SELECT *, coalesce(point IN {_SMALL}, false) roman FROM u),
  x AS (SELECT *, coalesce(roman AND last_value(CASE WHEN point IS NOT NULL AND NOT roman THEN true WHEN para IS NOT NULL THEN false END IGNORE NULLS) OVER w, false) nested, last_value(para IGNORE NULLS) OVER w paragraph,
    max(ord) OVER (PARTITION BY doc_id, lo) + 1 fin FROM v WINDOW w AS (PARTITION BY doc_id, lo ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
  y AS (SELECT *, para IS NOT NULL OR (point IS NOT NULL AND NOT nested) OR (para IS NULL AND point IS NULL AND regexp_matches(c, '^[A-Z]') AND NOT regexp_matches(c, '^(?:and|or)\\b')) stops FROM x),
  q AS (SELECT doc_id, article, paragraph, point AS marker, ord AS start, coalesce(nxt, fin) AS stop FROM (SELECT *, min(CASE WHEN stops THEN ord END) OVER (PARTITION BY doc_id, lo ORDER BY ord ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) nxt FROM y) WHERE point IS NOT NULL AND NOT nested)"""


@query(f"{_M}{_PTS} SELECT * FROM q")
def point_blocks(spark: SparkSession, d: str) -> DataFrame:
    return R.point_blocks(paragraphs(spark, d))


_NUM = lambda c: f"CASE WHEN regexp_full_match({c}, '\\d+[A-Za-z]*') THEN CAST(regexp_extract({c}, '^\\d+') AS BIGINT) ELSE 1000000000 END"
_SUF = lambda c: f"CASE WHEN regexp_full_match({c}, '\\d+[A-Za-z]*') THEN lower(regexp_extract({c}, '[A-Za-z]*$')) ELSE lower({c}) END"
_LESS = lambda a, b: f"({_NUM(a)} < {_NUM(b)} OR ({_NUM(a)} = {_NUM(b)} AND {_SUF(a)} < {_SUF(b)}))"


@query(f"""{_M}{_BLOCKS}, e AS (SELECT doc_id, article, max(stop) fin FROM b GROUP BY ALL), w AS (SELECT DISTINCT doc_id, article, '2a' marker FROM b)
  SELECT w.doc_id, w.article, w.marker, coalesce(min(b.start) FILTER ({_LESS('w.marker', 'b.marker')}), any_value(e.fin)) "at" FROM w LEFT JOIN b USING (doc_id, article) JOIN e USING (doc_id, article) GROUP BY ALL""")
def insertion_index(spark: SparkSession, d: str) -> DataFrame:
    """Where a paragraph 2a would be inserted into each article section."""
    blocks = R.paragraph_blocks(paragraphs(spark, d))
    return R.insertion_index(blocks, blocks.select("doc_id", "article").distinct().withColumn("marker", F.lit("2a")))


_POINTC = sfirst("c", r"(?i)^\(([a-z]+)\)")


@query(f"""{_M}{_BLOCKS}, l AS (SELECT b.doc_id, b.article, b.marker, m.ord, row_number() OVER (PARTITION BY b.doc_id, b.start ORDER BY m.ord) k FROM b JOIN m ON m.doc_id = b.doc_id AND m.ord >= b.start AND m.ord < b.stop WHERE c <> '' AND {_POINTC} IS NULL)
  SELECT doc_id, article, marker, ord FROM l WHERE k = 2""")
def second_subparagraph(spark: SparkSession, d: str) -> DataFrame:
    p = paragraphs(spark, d)
    return R.subparagraph(p, R.paragraph_blocks(p), 2)


@query(f"""{_M}{_IN}, k AS (SELECT * FROM (SELECT *, {_SPACED} marker FROM i) WHERE marker IS NOT NULL AND ord > lo),
  l AS (SELECT *, lag(marker) OVER w previous_marker, lag(ord) OVER w previous_ord FROM k WINDOW w AS (PARTITION BY doc_id, lo ORDER BY ord)) SELECT doc_id, article, previous_marker, previous_ord, marker, ord FROM l WHERE previous_marker IS NOT NULL AND {_LESS('marker', 'previous_marker')}""")
def marker_inversions(spark: SparkSession, d: str) -> DataFrame:
    return R.marker_inversions(paragraphs(spark, d))


@query(f"""{_M}{_IN}, k AS (SELECT * FROM (SELECT *, {_SPACED} marker FROM i) WHERE marker IS NOT NULL AND ord > lo),
  l AS (SELECT *, lag(marker) OVER w previous_marker FROM k WINDOW w AS (PARTITION BY doc_id, lo ORDER BY ord))
  SELECT doc_id, count(DISTINCT lo) article_sections_checked, count(*) paragraph_markers_checked, count(*) FILTER (previous_marker IS NOT NULL AND {_LESS('marker', 'previous_marker')}) marker_order_inversions,
  list_slice(coalesce(list(ord ORDER BY ord) FILTER (previous_marker IS NOT NULL AND {_LESS('marker', 'previous_marker')}), []), 1, 20) examples FROM l GROUP BY doc_id""")
def paragraph_order(spark: SparkSession, d: str) -> DataFrame:
    return H.order(paragraphs(spark, d))


@query(f"""{_M}{_PTS}, k AS (SELECT DISTINCT doc_id, article, paragraph, marker FROM q WHERE paragraph IS NOT NULL), n AS (SELECT doc_id, article, paragraph, count(*) need FROM k GROUP BY ALL),
  f AS (SELECT a.doc_id, a.article, a.paragraph item, b.paragraph, count(*) have FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.article = b.article AND a.marker = b.marker GROUP BY ALL)
  SELECT doc_id, article, item, min(paragraph) paragraph FROM (SELECT f.* FROM f JOIN n ON f.doc_id = n.doc_id AND f.article = n.article AND item = n.paragraph WHERE have = need) GROUP BY ALL HAVING count(*) = 1""")
def paragraphs_with_all_points(spark: SparkSession, d: str) -> DataFrame:
    """For each paragraph with points, the paragraph of its article that alone holds all of them."""
    p = R.point_blocks(paragraphs(spark, d))
    return R.paragraphs_with_all_points(p, p.where("paragraph is not null").select("doc_id", "article", F.col("paragraph").alias("item"), "marker").distinct())


_HANG = "takes OR kind IS NOT NULL"


@query(f"""WITH p AS ({_P}), m AS (SELECT *, {sclean('text')} c FROM p), a AS (SELECT *, regexp_full_match(c, '(?i)\\([ivxlcdm]+\\)|\\([a-z]\\)|[a-z]\\.|[ivxlcdm]+\\.|—|–') alone, {L._TYPE} kind FROM m WHERE c <> ''),
  t AS (SELECT *, CASE WHEN alone = lag(alone) OVER w THEN 0 ELSE 1 END turn FROM a WINDOW w AS (PARTITION BY doc_id ORDER BY ord)), r AS (SELECT *, sum(turn) OVER (PARTITION BY doc_id ORDER BY ord) run FROM t),
  n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY ord) nth FROM r), k AS (SELECT *, alone AND nth % 2 = 1 AND lead(ord) OVER w IS NOT NULL takes, lead(text) OVER w body, max(CASE WHEN kind = 'digit' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) o FROM n WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
  l AS (SELECT *, coalesce(lag(takes) OVER (PARTITION BY doc_id ORDER BY ord), false) taken FROM k), j AS (SELECT *, CASE WHEN takes THEN text || E'\\t' || body ELSE text END b FROM l WHERE NOT taken)
  SELECT doc_id, ord, {L._spaced('b', *L._SPACING)} AS text, CASE WHEN {_HANG} THEN greatest(o, 1) ELSE o END AS left_cm, CASE WHEN {_HANG} THEN -1 ELSE 0 END AS first_line_cm FROM j""")
def numbered_layout(spark: SparkSession, d: str) -> DataFrame:
    return S.numbered_layout(paragraphs(spark, d).withColumn("table_depth", F.lit(0)))


def _roman(n: int) -> str:
    return "x" * (n // 10) + ("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix")[n % 10]


_ROMANS = "[" + ", ".join(f"'{_roman(n)}'" for n in range(1, 40)) + "]"
_PARTS = f"""SELECT act_id, block_id, text, kind, name, n, coalesce(try_cast(regexp_extract(name, '^[0-9]+') AS BIGINT), list_position({_ROMANS}, name)) + CASE WHEN kind = 'annex' THEN 100000 ELSE 0 END no FROM
  (SELECT act_id, block_id, text, regexp_extract(provision_id, '^(article|annex)_([a-z0-9]+)_block_([0-9]+)$', 1) kind, regexp_extract(provision_id, '^(article|annex)_([a-z0-9]+)_block_([0-9]+)$', 2) name, try_cast(regexp_extract(provision_id, '_block_([0-9]+)$', 1) AS BIGINT) n FROM text_blocks WHERE text IS NOT NULL) WHERE kind <> ''"""
_ALL = f"""SELECT CAST(act_id AS VARCHAR) doc_id, row_number() OVER (PARTITION BY act_id ORDER BY no, name, n, block_id) - 1 ord, text FROM (SELECT act_id, no, name, n, block_id, text FROM ({_PARTS})
  UNION ALL SELECT DISTINCT act_id, no, name, -1, 0, CASE WHEN kind = 'annex' THEN 'ANNEX ' || upper(name) ELSE 'Article ' || name END FROM ({_PARTS}))"""
_AM = _M.replace(_P, _ALL)


@query(f"""{_AM.replace(_ALL, _ALL.replace('SELECT act_id, no, name, n, block_id, text FROM', f"SELECT act_id, no, name, n, block_id, {L._ROMAN('(n % 399 + 1)')} || '. ' || text AS text FROM"))}, k AS (SELECT *, last_value(CASE WHEN annex IS NOT NULL THEN ord END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) lo, last_value(annex IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) box,
  upper({sfirst('c', "(?i)^[‘'" + '"' + r"]?([IVXLC]+)\.(?:\s|$)")}) point FROM h), e AS (SELECT *, max(ord) OVER (PARTITION BY doc_id, lo) + 1 fin FROM k WHERE lo IS NOT NULL)
  SELECT doc_id, box AS annex, point, ord AS start, coalesce(lead(ord) OVER (PARTITION BY doc_id, lo ORDER BY ord), fin) AS stop FROM e WHERE point IS NOT NULL""")
def annex_points(spark: SparkSession, d: str) -> DataFrame:
    """Roman sections of the annexes of acts whose blocks are numbered by their place."""
    return R.annex_points(act_lines(spark, d, numbered=True))


@query(f"""{_AM}{_BLOCKS}, l AS (SELECT b.doc_id, b.article, b.marker, b.start, b.stop, m.ord, c <> '' AS filled, {_POINTC} IS NOT NULL AS point FROM b JOIN m ON m.doc_id = b.doc_id AND m.ord >= b.start AND m.ord < b.stop),
  o AS (SELECT *, bool_or(point) OVER (PARTITION BY doc_id, start ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) seen FROM l)
  SELECT doc_id, article, marker, coalesce(min(ord) FILTER (seen AND filled AND NOT point), stop) AS "at" FROM o GROUP BY doc_id, article, marker, start, stop""")
def first_subparagraph_ends(spark: SparkSession, d: str) -> DataFrame:
    p = act_lines(spark, d)
    return R.first_subparagraph_end(p, R.paragraph_blocks(p))


@query(f"""{_AM}{_PTS}, k AS (SELECT * FROM q WHERE paragraph IS NOT NULL AND marker NOT IN {_SMALL}), w AS (SELECT DISTINCT doc_id, article, paragraph FROM k)
  SELECT w.doc_id, w.article, w.paragraph, 'd' AS marker, coalesce(min(start) FILTER (k.marker > 'd'), max(stop)) AS "at" FROM w JOIN k ON w.doc_id = k.doc_id AND w.article = k.article AND w.paragraph = k.paragraph GROUP BY ALL""")
def point_insertion_index(spark: SparkSession, d: str) -> DataFrame:
    """Where a point (d) would be inserted into each paragraph that has lettered points."""
    points = R.point_blocks(act_lines(spark, d)).where("paragraph is not null")
    return R.point_insertion_index(points, points.select("doc_id", "article", "paragraph").distinct().withColumn("marker", F.lit("d")))


@query(f"""WITH o AS (SELECT act_id, CAST(unnest([0, 1, 2, 3, 4]) AS BIGINT) k, unnest([title, '(1) Reason.', '(2) Reason of ' || celex, 'HAVE ADOPTED THIS REGULATION:', NULL]) text FROM acts),
  m AS (SELECT CAST(act_id AS VARCHAR) doc_id, k - 5 ord, {sclean('text')} c FROM o UNION ALL SELECT doc_id, ord, {sclean('text')} FROM ({_ALL}) UNION ALL SELECT CAST(act_id AS VARCHAR), 1000000000, 'This act shall be binding in its entirety.' FROM acts WHERE act_id % 2 = 0),
  h AS (SELECT *, regexp_matches(c, '(?i)^Article\\s+\\d+[A-Za-z]?\\b') art, regexp_matches(c, '(?i)^ANNEX\\s+[IVXLC]+\\b') annex FROM m), f AS (SELECT *, coalesce(min(CASE WHEN art THEN ord END) OVER (PARTITION BY doc_id), 10000000000) stop FROM h), r AS (SELECT *, ord < stop AND regexp_matches(c, '^\\(\\d+\\)') rec FROM f)
  SELECT doc_id, coalesce(min(ord) FILTER (rec) - 1, min(ord)) AS title_end, max(ord) FILTER (rec) AS last_recital, min(ord) FILTER (regexp_matches(c, '(?i)have adopted this')) AS formula, min(ord) FILTER (regexp_matches(c, '(?i)shall be binding in its entirety')) AS binding,
  min(ord) FILTER (art) AS first_article, min(ord) FILTER (annex) AS first_annex, max(ord) + 1 AS size FROM r GROUP BY doc_id""")
def landmarks(spark: SparkSession, d: str) -> DataFrame:
    """Landmarks of acts with a front of title, recitals and formula before their blocks, and a closing line for every other."""
    acts = table(spark, d, "acts")
    doc = F.col("act_id").cast("string").alias("doc_id")
    front = acts.select(doc, F.posexplode(F.array("title", F.lit("(1) Reason."), F.concat(F.lit("(2) Reason of "), "celex"), F.lit("HAVE ADOPTED THIS REGULATION:"), F.lit(None).cast("string"))).alias("k", "text"))
    end = acts.where("act_id % 2 = 0").select(doc, F.lit(1_000_000_000).cast("bigint").alias("ord"), F.lit("This act shall be binding in its entirety.").alias("text"))
    return R.landmarks(front.select("doc_id", (F.col("k") - 5).cast("bigint").alias("ord"), "text").unionByName(act_lines(spark, d)).unionByName(end))


@query(r"SELECT CAST(act_id AS VARCHAR) AS doc_id, regexp_extract(title, '\b(\d{4}/\d{1,4})\b', 1) AS target FROM acts WHERE regexp_matches(title, '\b\d{4}/\d{1,4}\b')")
def target_regulations(spark: SparkSession, d: str) -> DataFrame:
    from actloom.operators import amendments

    return amendments.target_regulation(table(spark, d, "acts").select(F.col("act_id").cast("string").alias("doc_id"), F.posexplode(F.array(F.lit("Text"), "title", F.lit("Regulation (EU) 1999/1"))).alias("ord", "text")).where("ord < 2"))


# pages ---------------------------------------------------------------------------------------------------------------


def escaped(c: Column) -> Column:
    """Text as it stands in a page."""
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def _html(*pieces: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in pieces])


def pages(spark: SparkSession, d: str) -> DataFrame:
    """One page (doc_id, html) for each act in the layout of the official journal: a small container before the real one,
    title (in one of three classes), journal line, recitals with a repeated number, a gap and a late one, a chapter heading,
    articles with all their blocks and a captioned table, footnotes, annexes."""
    acts, blocks, notes = table(spark, d, "acts"), table(spark, d, "text_blocks").where("text is not null"), table(spark, d, "footnotes")
    piece = lambda df, part, no, name, n, i, html: df.select("act_id", F.struct(F.lit(part).alias("part"), no.cast("bigint").alias("no"), name.alias("name"), n.cast("bigint").alias("n"), i.cast("bigint").alias("i"), html.alias("html")).alias("p"))
    zero, none = F.lit(0), F.lit("")
    title, kind = escaped(F.col("title")), F.element_at(F.array(*map(F.lit, ("eli-main-title", "oj-hd-ti", "oj-doc-ti"))), (F.col("act_id") % 3).cast("int") + 1)
    head = _html('<html><head><title>Page</title><script>var p = "</p>";</script><style>p {}</style></head><body><div class="nav">menu</div><div class="eli-container"><p class="oj-normal">Notice</p></div><div class="eli-container"><p class="', kind, '">', title, '</p><p class="oj-hd-oj">', F.col("celex"), '</p><p class="oj-hd-lg">EN')
    n = F.col("act_id") % 4
    reasons = F.transform(F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>")), lambda i: _html("(", i.cast("string"), ") Reason ", i.cast("string"), " of ", F.col("celex"), "."))
    odd = F.array(F.lit("(1) Again."), _html("(", (n + 2).cast("string"), ") Gap."), _html("(", (n + 1).cast("string"), ") Late."))
    recital = acts.select("act_id", F.posexplode(F.concat(reasons, odd)).alias("at", "t"))
    rows = blocks.withColumns({"kind": F.regexp_extract("provision_id", r"^(article|annex)_([a-z0-9]+)_block_(\d+)$", 1), "name": F.regexp_extract("provision_id", r"^(article|annex)_([a-z0-9]+)_block_(\d+)$", 2), "n": F.regexp_extract("provision_id", r"_block_(\d+)$", 1)})
    rows = written(rows.withColumn("no", F.coalesce(F.regexp_extract("name", r"^\d+", 0).try_cast("int"), G.roman_value(F.col("name")))).select("act_id", "block_id", "text", "classes", "kind", "name", "n", "no"), "blocks")
    line = _html('<p class="', F.array_join(F.array_union(F.array(F.lit("oj-normal")), F.coalesce("classes", F.array().cast("array<string>"))), " "), '" id="b', F.col("block_id").cast("string"), '">', escaped(F.col("text")), "</p>\n")
    parts = {k: rows.where(F.col("kind") == k) for k in ("article", "annex")}
    one = {k: v.select("act_id", "no", "name").distinct() for k, v in parts.items()}
    sub = F.when(F.col("no") % 2 == 0, _html('<p class="oj-sti-art">First</p><p class="oj-sti-art">Subject of ', F.col("name"), "</p>"))
    opens = _html('<div class="eli-subdivision" id="art_', F.col("name"), '"><p class="oj-ti-art">Article ', F.col("name"), "</p>", sub)
    closes = _html('<p class="oj-ti-tbl">Table of ', F.col("name"), '</p><table class="oj-table"><tr><th>a<td rowspan="2">', F.col("name"), '<tr><td colspan="3">c</table></div>')
    tag = F.when(F.col("marker").isNotNull(), _html('<span class="oj-note-tag">', escaped(F.col("marker")), "</span> "))
    note = _html('<p class="oj-note"', F.when(F.col("note_id").isNotNull(), _html(' id="', escaped(F.col("note_id")), '"')), ">", tag, escaped(F.col("text")), "</p>")
    all_ = [
        piece(acts, 0, zero, none, zero, zero, head), piece(recital, 1, F.col("at"), none, zero, zero, _html('<p class="oj-normal">', F.col("t"))), piece(acts, 2, zero, none, zero, zero, F.lit('<p class="oj-ti-section-1">CHAPTER I')),
        piece(one["article"], 3, F.col("no"), F.col("name"), F.lit(-1), zero, opens), piece(parts["article"], 3, F.col("no"), F.col("name"), F.col("n"), F.col("block_id"), line), piece(one["article"], 3, F.col("no"), F.col("name"), F.lit(10**12), zero, closes),
        piece(notes, 4, F.coalesce("pos", zero), none, zero, F.col("fn_id"), note),
        piece(one["annex"], 5, F.col("no"), F.col("name"), F.lit(-1), zero, _html('<div id="anx_', F.upper("name"), '"><p class="oj-doc-ti">ANNEX ', F.upper("name"), "</p>")), piece(parts["annex"], 5, F.col("no"), F.col("name"), F.col("n"), F.col("block_id"), line), piece(one["annex"], 5, F.col("no"), F.col("name"), F.lit(10**12), zero, F.lit("</div>")),
    ]
    both = all_[0]
    for x in all_[1:]:
        both = both.unionByName(x)
    whole = both.join(acts.select("act_id"), "act_id", "left_semi").groupBy("act_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["html"]), "").alias("html"))
    return whole.select(F.col("act_id").cast("string").alias("doc_id"), _html(F.col("html"), "</div></body></html>").alias("html"))


def _parsed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = spread(written(html.elements(spread(written(pages(spark, d), "pages"))), "elements"))
    root = S.legal_root(e)
    return e, root, S.legal_stream(e, root)


_OF = lambda kind: f"SELECT CAST(act_id AS VARCHAR) doc_id, block_id, text, classes, regexp_extract(provision_id, '^{kind}_([a-z0-9]+)_block_([0-9]+)$', 1) name, CAST(regexp_extract(provision_id, '_block_([0-9]+)$', 1) AS BIGINT) n FROM text_blocks WHERE text IS NOT NULL AND regexp_matches(provision_id, '^{kind}_[a-z0-9]+_block_[0-9]+$') AND act_id IN (SELECT act_id FROM acts)"
_NO = "CAST(regexp_extract(name, '^[0-9]+') AS BIGINT)"
_TEXTS = lambda kind: steps(_OF(kind), ("m", L._MARKUP), ("nth", "CASE WHEN m <> '' THEN row_number() OVER (PARTITION BY doc_id, name, m <> '' ORDER BY n, block_id) END"))
_TITLED = L._MARKUP.replace("coalesce(text, '')", "coalesce(title, '')")
_SLUG = f"coalesce(nullif(trim(regexp_replace(lower({_TITLED}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown')"


@query(f"SELECT DISTINCT doc_id, 'article_' || name AS provision_id, name AS number, 'Article ' || name AS heading, CASE WHEN {_NO} % 2 = 0 THEN 'Subject of ' || name END AS subtitle FROM ({_OF('article')})")
def articles(spark: SparkSession, d: str) -> DataFrame:
    return S.articles(_parsed(spark, d)[2]).select("doc_id", "provision_id", "number", "heading", "subtitle")


@query(f"SELECT doc_id, 'article_' || name || '_block_' || nth AS provision_id, 'b' || block_id AS source_id, m AS text, {L._ROLE} AS role FROM ({_TEXTS('article')}) WHERE m <> ''")
def article_text_blocks(spark: SparkSession, d: str) -> DataFrame:
    return S.article_blocks(_parsed(spark, d)[2]).where("block_type = 'text'").select("doc_id", "provision_id", "source_id", "text", "role")


_REASONS = """SELECT act_id, i n, '(' || i || ') Reason ' || i || ' of ' || celex || '.' AS text FROM (SELECT act_id, celex, unnest(range(1, act_id % 4 + 1)) i FROM acts)
  UNION ALL SELECT act_id, unnest([1, 2]), unnest(['(1) Again.', '(2) Gap.']) FROM acts WHERE act_id % 4 = 0"""


@query(f"SELECT CAST(act_id AS VARCHAR) AS doc_id, 'recital_' || n AS provision_id, CAST(n AS VARCHAR) AS number, text FROM ({_REASONS}) WHERE act_id IN (SELECT CAST(doc_id AS BIGINT) FROM ({_OF('article')}))")
def recitals(spark: SparkSession, d: str) -> DataFrame:
    """Recitals stand before a first article, so an act without any gives none."""
    return S.recitals(_parsed(spark, d)[2]).select("doc_id", "provision_id", "number", "text")


_MARKER = L._MARKUP.replace("coalesce(text, '')", "coalesce(marker, '')")
_NOTES = steps(
    "SELECT act_id, pos, fn_id, nullif(note_id, '') sid, marker, text FROM footnotes WHERE act_id IN (SELECT act_id FROM acts)", ("idx", "row_number() OVER (PARTITION BY act_id ORDER BY coalesce(pos, 0), fn_id)"), ("m", f"CASE WHEN marker IS NULL THEN CAST(idx AS VARCHAR) ELSE {_MARKER} END"),
    ("body", L._MARKUP), ("name", "coalesce(sid, 'note_' || CASE WHEN m <> '' THEN m ELSE CAST(idx AS VARCHAR) END)"), ("nth", "row_number() OVER (PARTITION BY act_id, name, m, body ORDER BY idx)"),
)


@query(f"SELECT CAST(act_id AS VARCHAR) AS doc_id, row_number() OVER (PARTITION BY act_id ORDER BY idx) AS ord, name AS note_id, m AS marker, body AS text FROM ({_NOTES}) WHERE nth = 1")
def footnotes(spark: SparkSession, d: str) -> DataFrame:
    e, root, _ = _parsed(spark, d)
    return S.footnotes(e, root)


_BODIES = steps(
    "SELECT act_id, coalesce(pos, 0) pos, fn_id, marker, text FROM footnotes WHERE act_id IN (SELECT act_id FROM acts)", ("c", sclean("concat_ws(' ', marker, text)")), ("number", sfirst("c", r"^\(?\s*(\d+)")),
    ("rest", sclean(r"regexp_replace(c, '^\(?\s*\d+\s*\)?\s*', '')")), ("body", r"regexp_replace(regexp_replace(rest, '(\d) ([)\].,;:!?])', '\1\2', 'g'), '\( (OJ\b)', '(\1', 'g')"),
)


@query(f"SELECT CAST(act_id AS VARCHAR) AS doc_id, number, arg_max(body, struct_pack(p := pos, f := fn_id)) AS body FROM ({_BODIES}) WHERE number IS NOT NULL GROUP BY act_id, number")
def footnote_bodies(spark: SparkSession, d: str) -> DataFrame:
    return S.footnote_bodies(_parsed(spark, d)[0])


@query(f"SELECT doc_id, 'annex_' || name || '_block_' || nth AS provision_id, 'ANNEX ' || upper(name) AS heading, m AS text FROM ({_TEXTS('annex')}) WHERE m <> ''")
def annexes(spark: SparkSession, d: str) -> DataFrame:
    e, _, _ = _parsed(spark, d)
    heads = S.annexes(e)
    return S.annex_blocks(e, heads).select("doc_id", "k", "provision_id", "text").join(heads.select("doc_id", "k", "heading"), ["doc_id", "k"]).drop("k")


@query(f"SELECT DISTINCT doc_id, 'Table of ' || name AS caption, 2 AS n_rows, ['a', name, 'c'] AS cells, [true, false, false] AS headers, 3 AS widest, 2 AS tallest FROM ({_OF('article')})")
def tables(spark: SparkSession, d: str) -> DataFrame:
    cells, most = F.flatten("rows"), lambda c: F.array_max(F.transform(F.flatten("rows"), lambda x: x[c]))
    return S.tables(_parsed(spark, d)[0]).select("doc_id", "caption", F.size("rows").alias("n_rows"), F.transform(cells, lambda c: c["text"]).alias("cells"), F.transform(cells, lambda c: c["is_header"]).alias("headers"), most("colspan").alias("widest"), most("rowspan").alias("tallest"))


_PER = lambda what, source: f"(SELECT doc_id, {what} FROM ({source}) GROUP BY doc_id)"


@query(
    f"""SELECT CAST(a.act_id AS VARCHAR) AS doc_id, CASE WHEN x.n IS NULL THEN 0 WHEN a.act_id % 4 = 0 THEN 2 ELSE a.act_id % 4 END AS recitals, coalesce(x.n, 0) AS articles, coalesce(x.ids, []) AS articles_ids, coalesce(z.n, 0) AS annexes, coalesce(z.ids, []) AS annexes_ids, coalesce(f.n, 0) AS footnotes, coalesce(b.n, 0) AS blocks,
    list_filter([CASE WHEN x.n IS NULL THEN 'No recitals detected.' END, CASE WHEN x.n IS NULL THEN 'No articles detected.' END, CASE WHEN z.n IS NULL THEN 'No annexes detected.' END, CASE WHEN f.n IS NULL THEN 'No footnotes detected.' END], lambda w: w IS NOT NULL) AS warnings
    FROM acts a LEFT JOIN {_PER("count(DISTINCT name) n, list_sort(list(DISTINCT 'article_' || name)) ids", _OF('article'))} x ON x.doc_id = CAST(a.act_id AS VARCHAR) LEFT JOIN {_PER("count(DISTINCT name) n, list_sort(list(DISTINCT 'annex_' || name)) ids", _OF('annex'))} z ON z.doc_id = CAST(a.act_id AS VARCHAR)
    LEFT JOIN (SELECT act_id, count(*) n FROM ({_NOTES}) WHERE nth = 1 GROUP BY act_id) f ON f.act_id = a.act_id LEFT JOIN {_PER('count(*) n', _TEXTS('article') + " WHERE m <> ''")} b ON b.doc_id = CAST(a.act_id AS VARCHAR)"""
)
def structure_summary(spark: SparkSession, d: str) -> DataFrame:
    e, root, stream = _parsed(spark, d)
    return S.summary(root, recitals=S.recitals(stream), articles=S.articles(stream), annexes=S.annexes(e), footnotes=S.footnotes(e, root), blocks=S.article_blocks(stream).where("block_type = 'text'")).drop("recitals_ids", "footnotes_ids")


@query(f"SELECT CAST(act_id AS VARCHAR) AS doc_id, coalesce(nullif({_TITLED}, ''), 'Page') AS title FROM acts")
def page_titles(spark: SparkSession, d: str) -> DataFrame:
    e, root, _ = _parsed(spark, d)
    return S.titles(e, root)


@query("SELECT CAST(act_id AS VARCHAR) AS doc_id, celex AS official_journal, 'EN' AS language FROM acts")
def page_metadata(spark: SparkSession, d: str) -> DataFrame:
    e, root, _ = _parsed(spark, d)
    return S.metadata(e, root).select("doc_id", F.col("metadata.official_journal").alias("official_journal"), F.col("metadata.language").alias("language"))


@query()
def page_text(spark: SparkSession, d: str) -> DataFrame:
    """Visible text of each page, and whether the element table says the same."""
    p = written(pages(spark, d), "pages")
    body = html.elements(p).where("tag = 'body'").select("doc_id", F.trim(F.regexp_replace("text", r"(?U)\s+", " ")).alias("body"))
    own = p.select("doc_id", html.page_text(F.col("html")).alias("text")).join(body, "doc_id")
    return own.select("doc_id", "text", F.endswith("text", F.col("body")).alias("same"))


@query(
    f"""SELECT CAST(act_id AS VARCHAR) AS doc_id, 'section_1_' || left({_SLUG}, 40) AS provision_id, split_part({_TITLED}, ' ', 1) AS label, 1 AS level, {_TITLED} AS text, ['oj-doc-ti'] AS classes, CAST(NULL AS VARCHAR) AS source_id FROM acts WHERE act_id % 3 = 2 AND {_TITLED} <> ''
    UNION ALL SELECT CAST(act_id AS VARCHAR), 'section_' || (act_id % 4 + 6 + CASE WHEN {_TITLED} <> '' THEN 1 ELSE 0 END) || '_chapter_i', 'CHAPTER', 2, 'CHAPTER I', ['oj-ti-section-1'], NULL FROM acts"""
)
def page_sections(spark: SparkSession, d: str) -> DataFrame:
    return S.sections(_parsed(spark, d)[2])


@query(
    f"""SELECT doc_id, diagnostic, n FROM (SELECT CAST(act_id AS VARCHAR) doc_id, 'recital_candidates' diagnostic, act_id % 4 + 3 n FROM acts UNION ALL SELECT CAST(act_id AS VARCHAR), 'footnotes', count(*) FROM footnotes WHERE act_id IN (SELECT act_id FROM acts) GROUP BY act_id
    UNION ALL SELECT doc_id, 'articles', count(DISTINCT name) FROM ({_OF('article')}) GROUP BY doc_id UNION ALL SELECT doc_id, 'tables', count(DISTINCT name) FROM ({_OF('article')}) GROUP BY doc_id UNION ALL SELECT doc_id, 'subdivisions', count(DISTINCT name) FROM ({_OF('article')}) GROUP BY doc_id)"""
)
def page_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the diagnostic tables by page: recital candidates outside blocks and notes, notes, article headings, tables, subdivisions."""
    parts = S.diagnostics(_parsed(spark, d)[0])
    kinds = {"recital_candidates": parts["recital_candidates"].where("id is null and tag = 'p' and classes = 'oj-normal'"), "footnotes": parts["footnotes"], "articles": parts["structure"].where("class = 'oj-ti-art'"), "tables": parts["structure"].where("class = 'oj-table'"), "subdivisions": parts["structure"].where("class = 'eli-subdivision'")}
    out = None
    for name, df in kinds.items():
        one = df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).withColumn("diagnostic", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query()
def page_diagnostic_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each diagnostic table by page."""
    out = None
    for name, df in S.diagnostics(_parsed(spark, d)[0]).items():
        one = df.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).withColumn("diagnostic", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"SELECT doc_id, 'anx_' || upper(name) AS box, row_number() OVER (PARTITION BY doc_id, name ORDER BY n, block_id) AS ord, {sclean('text')} AS text, 0 AS left_cm, 0 AS first_line_cm FROM ({_OF('annex')}) WHERE {sclean('text')} <> ''")
def annex_layout(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the annexes as they are laid out; spaces of amounts as in the source."""
    got = N.emitted(_parsed(spark, d)[0])
    return got.withColumn("text", X.clean(F.translate("text", " ", " ")))


@query()
def annex_tables(spark: SparkSession, d: str) -> DataFrame:
    """Containers of the articles taken for annexes: their titled tables as two columns, with the size of the largest one."""
    e = written(_parsed(spark, d)[0].withColumn("id", F.regexp_replace("id", "^art_", "anx_")), "elements")
    return N.structured_tables(e).join(N.largest_tables(e).select("doc_id", "box", "rows", "cells"), ["doc_id", "box"])


@query(f"SELECT DISTINCT doc_id, 'Article ' || name AS heading, true AS inside FROM ({_OF('article')})")
def nearest_containers(spark: SparkSession, d: str) -> DataFrame:
    """The closest subdivision around each article heading."""
    e, _, _ = _parsed(spark, d)
    heads = e.where(S.has("oj-ti-art")).select("doc_id", "pos", F.col("text").alias("heading"))
    box = e.where(S.has("eli-subdivision")).select("doc_id", F.col("pos").alias("container"), "id")
    got = N.nearest_containers(e, heads).join(heads, ["doc_id", "pos"]).join(box, ["doc_id", "container"])
    return got.select("doc_id", "heading", (F.col("id") == F.concat(F.lit("art_"), F.substring_index("heading", " ", -1))).alias("inside"))


@query("SELECT regexp_replace(role, '_', ' ') AS role, count(*) AS n FROM text_blocks GROUP BY role")
def block_role_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_blocks").groupBy("role").agg(F.count(F.lit(1)).alias("n")).select(F.regexp_replace("role", "_", " ").alias("role"), "n")




def _fronts(spark: SparkSession, d: str) -> DataFrame:
    """A page of each act with preamble, chapter, closing part and annex changes; its title and number fill the parts, and how many of each there are depends on the act."""
    act, celex = F.col("act_id").cast("string"), F.col("celex")
    upto = lambda n, f: F.array_join(F.transform(F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>")), f), "")
    cites = upto(F.col("act_id") % 3, lambda i: _html('<div class="eli-subdivision" id="cit_', i.cast("string"), '"><p class="oj-normal">Having regard to ', celex, " no ", i.cast("string"), ",</p></div>"))
    reasons = upto(F.col("act_id") % 4, lambda i: _html('<div class="eli-subdivision" id="rct_', i.cast("string"), '"><p class="oj-normal">(', i.cast("string"), ')</p><p class="oj-normal">Act ', act, ".</p></div>"))
    second = _html('<div class="eli-subdivision" id="art_2"><p class="oj-ti-art">Article 2</p><p class="oj-sti-art">Scope</p><p class="oj-normal">1. Text.</p></div>')
    boxed = F.col("act_id") % 2 == 0
    page = _html(
        '<html><body><div class="eli-container"><div class="eli-main-title">', escaped(F.col("title")), '</div><div class="eli-subdivision" id="pbl_1"><p class="oj-normal">THE ASSEMBLY,</p>', cites, '<p class="oj-normal">Whereas:</p>', reasons, '<p class="oj-normal">HAVE ADOPTED THIS REGULATION:</p></div>',
        F.when(boxed, _html('<div id="cpt_I"><p class="oj-ti-section-2">General</p>', second, "</div>")).otherwise(second),
        '<div class="eli-subdivision" id="art_1"><p class="oj-ti-art">Article 1</p><p class="oj-sti-art">Entry into force</p><p class="oj-normal">Act ', act, ' enters into force.</p></div><div class="oj-final"><p class="oj-normal">Done.</p><div class="oj-signatory"><p class="oj-signatory"><span class="oj-italic">For ', celex, "</span></p></div></div>",
        '<div id="anx_1"><p>Annexes I and II are replaced by the following:</p><p>ANNEX I</p><p>Line of ', act, "</p>", F.when(boxed, "<p>ANNEX II</p><p>I. First</p><p>(a)</p><p>point</p>"), F.when(F.col("act_id") % 3 == 0, "<p>The following annexes are added:</p><p>ANNEX IIa</p><p>NEW THINGS OF NOTE</p>"), "</div></div></body></html>",
    )
    return table(spark, d, "acts").select(act.alias("doc_id"), page.alias("html"))


_ACT = "CAST(act_id AS VARCHAR) AS doc_id"


@query(
    f"""SELECT {_ACT}, 'entity' AS part, 'THE ASSEMBLY,' AS text FROM acts UNION ALL SELECT {_ACT}, 'citation', 'Having regard to ' || celex || ' no ' || i || ',' FROM (SELECT *, unnest(range(1, act_id % 3 + 1)) i FROM acts)
    UNION ALL SELECT {_ACT}, 'entity', unnest(['Whereas:', 'HAVE ADOPTED THIS REGULATION:']) FROM acts WHERE act_id % 3 = 0 UNION ALL SELECT {_ACT}, 'bridge', 'Whereas:' FROM acts WHERE act_id % 3 > 0 AND act_id % 4 > 0 UNION ALL SELECT {_ACT}, 'formula', 'HAVE ADOPTED THIS REGULATION:' FROM acts"""
)
def preamble_parts(spark: SparkSession, d: str) -> DataFrame:
    return P.preamble(html.elements(_fronts(spark, d))).select("doc_id", "part", "text")


@query(f"SELECT {_ACT}, CAST(i AS VARCHAR) AS number, '(' || i || ') Act ' || act_id || '.' AS text FROM (SELECT *, unnest(range(1, act_id % 4 + 1)) i FROM acts)")
def container_recitals(spark: SparkSession, d: str) -> DataFrame:
    return P.recitals(html.elements(_fronts(spark, d))).select("doc_id", "number", "text")


@query(f"SELECT {_ACT}, ord, CASE WHEN act_id % 2 = 0 THEN chapter END AS chapter, number, v.title FROM acts, (VALUES (1, 'cpt_I', '2', 'Scope'), (2, NULL, '1', 'Entry into force')) v(ord, chapter, number, title)")
def operatives(spark: SparkSession, d: str) -> DataFrame:
    return P.operatives(html.elements(_fronts(spark, d)))


@query(f"SELECT {_ACT}, 'Article 1' AS article_heading_line, 'Entry into force' AS article_subheading_line, ['Act ' || act_id || ' enters into force.'] AS article_body, ['Done.'] AS final_lines FROM acts")
def entry_into_force(spark: SparkSession, d: str) -> DataFrame:
    return P.entry_into_force(html.elements(_fronts(spark, d)))


@query(f"SELECT {_ACT}, 'For ' || celex AS text, true AS italic FROM acts")
def signatories(spark: SparkSession, d: str) -> DataFrame:
    return P.signatories(html.elements(_fronts(spark, d))).select("doc_id", "text", "italic")


@query(
    f"""SELECT {_ACT}, 'I' AS annex_label, 'replace' AS mode, ord, text FROM acts, LATERAL (VALUES (1, 'ANNEX I'), (2, 'Line of ' || act_id)) v(ord, text)
    UNION ALL SELECT {_ACT}, 'II', 'replace', ord, text FROM acts, (VALUES (1, 'ANNEX II'), (2, 'I. First'), (3, '(a)'), (4, 'point')) v(ord, text) WHERE act_id % 2 = 0 UNION ALL SELECT {_ACT}, 'IIA', 'add', ord, text FROM acts, (VALUES (1, 'ANNEX IIA'), (2, 'NEW THINGS OF NOTE')) v(ord, text) WHERE act_id % 3 = 0"""
)
def annex_changes(spark: SparkSession, d: str) -> DataFrame:
    return P.annex_changes(html.elements(_fronts(spark, d)))


@query(f"SELECT {_ACT}, coalesce(nullif({_TITLED}, ''), 'Untitled EUR-Lex document') AS title FROM acts")
def act_titles(spark: SparkSession, d: str) -> DataFrame:
    e = html.elements(_fronts(spark, d))
    return S.titles(e, S.legal_root(e))


@query(
    f"""WITH o AS (SELECT act_id, CAST(unnest([0, 1, 2]) AS DOUBLE) at_, 0 k, unnest([title, '(1) Old reason.', 'Article 1']) text, false added FROM acts),
  h AS (SELECT b.act_id, 0.25 at_, unnest([0, 1]) k, unnest(['as amended by', array_to_string(list_filter(list_transform(string_split({L._TITLE.replace('title', 'a.title')}, E'\\n'), lambda x: trim(x)), lambda x: x <> ''), E'\\n')]) text, true added
    FROM acts a JOIN acts b ON b.act_id = a.act_id + 1 WHERE {sclean('a.title')} NOT IN ('', {sclean('b.title')}, '(1) Old reason.', 'Article 1')),
  r AS (SELECT act_id, 1.5 at_, 0 k, E'(1)\\tAct ' || act_id || '.' text, true added FROM acts)
  SELECT CAST(act_id AS VARCHAR) doc_id, row_number() OVER (PARTITION BY act_id ORDER BY at_, k) - 1 AS ord, text, added FROM (SELECT * FROM o UNION ALL SELECT * FROM h UNION ALL SELECT * FROM r)"""
)
def acts_with_title_and_recitals(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each act once its own page's recital and another act's title are added."""
    acts = table(spark, d, "acts")
    base = acts.select(F.col("act_id").cast("string").alias("doc_id"), F.posexplode(F.array("title", F.lit("(1) Old reason."), F.lit("Article 1"))).alias("ord", "text"))
    title = acts.select((F.col("act_id") + 1).cast("string").alias("doc_id"), F.col("title").alias("text"))
    new = acts.select(F.col("act_id").cast("string").alias("doc_id"), F.lit(0).alias("pos"), F.concat(F.lit("(1) Act "), "act_id", F.lit(".")).alias("text"))
    return P.with_title_and_recitals(base, title, new)

"""Normalisers, tokenisers, classifiers and target extraction over whole tables of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.functions import tokens as T
from actloom.plans.registry import WS, query, sanchorless, sclean, sdistinct, sfirst, stab, steps, sunquoted, swords, table

Q = "[‘''" + '"]'
CLEAN = sclean("text")


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_blocks")


@query(f"SELECT block_id, {CLEAN} AS clean, lower({CLEAN}) AS normal FROM text_blocks")
def norm_clean(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.clean(F.col("text")).alias("clean"), X.normalized(F.col("text")).alias("normal"))


_MARKUP = (
    rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(coalesce(text, ''), chr(160), ' '), chr(8209), '-'), '[\t\r\f\v ]+', ' ', 'g'), "
    rf"'{WS}+([,.;:])', '\1', 'g'), '\n{{3,}}', E'\n\n', 'g'), '^{WS}+|{WS}+$', '', 'g')"
)


@query(f"SELECT block_id, {_MARKUP} AS markup FROM text_blocks")
def norm_markup(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.clean_markup(F.col("text")).alias("markup"))


@query(f"SELECT block_id, coalesce(nullif(trim(regexp_replace(lower({_MARKUP}), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown') AS slug FROM text_blocks")
def norm_slug(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.slug(F.col("text")).alias("slug"))


_HARD = r"regexp_replace({}, '(\d) (\d{{3}})\b', '\1' || chr(160) || '\2', 'g')"
_HARD = _HARD.format(_HARD.format("coalesce(text, '')"))  # neighbouring groups share a digit, so twice
for _p, _b in ((rf"\bEUR{WS}+(\p{{Nd}})", r"'EUR' || chr(160) || '\1'"), (rf"€{WS}+(\p{{Nd}})", r"'€' || chr(160) || '\1'"), (rf"(\p{{Nd}}){WS}+%", r"'\1' || chr(160) || '%'")):
    _HARD = f"regexp_replace({_HARD}, '{_p}', {_b}, 'g')"


@query(f"SELECT block_id, {_HARD} AS text FROM text_blocks")
def norm_hard_spaces(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.hard_spaces(F.col("text")).alias("text"))


@query(
    rf"""SELECT block_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '(?i){WS}*\[\[SRC:[^\]]+\]\]', '', 'g'), '(?i)\bSRC:[A-Za-z0-9_.-]+\b', '', 'g'),
    '(?i)\bsrc{WS}+art{WS}+\d+[A-Za-z]?(?:{WS}+\d+[A-Za-z]?)?\b', '', 'g'), '{WS}+', ' ', 'g')) AS text, regexp_replace({CLEAN}, '(?i)^\([ivxlcdm]+\) ', '') AS inner_text FROM text_blocks"""
)
def norm_anchors_and_romans(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.without_anchors(F.col("text")).alias("text"), X.without_roman(F.col("text")).alias("inner_text"))


_TAB = stab("text")


@query(f"SELECT block_id, {_TAB} AS tabbed FROM text_blocks")
def norm_marker_tabs(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", X.marker_tab(F.col("text")).alias("tabbed"))


def _spaced(c: str, *markers: str) -> str:
    for m in markers:
        c = f"regexp_replace({c}, '^({m}){WS}+', '\\1' || chr(9))"
    return c


_SPACING = (r"\d+\.", r"\([a-z]\)", r"(?i:\([ivxlcdm]+\))")
_ANNEX_MARKS = (r"(?i:[a-z]\.|[ivxlcdm]+\.)", *_SPACING, r"(?i:\([a-z]+\))", r"(?i:[ivxlcdm]+\.)", r"[A-Z]\.", r"\d+[A-Za-z]?\)", r"\d+[A-Za-z]?\.")


@query(f"""SELECT block_id, array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: CASE WHEN {sclean('x')} = '' THEN '' ELSE {stab('x')} END), chr(10)) AS lines,
  {_spaced("coalesce(text, '')", *_SPACING)} AS spaced, {_spaced(CLEAN, *_ANNEX_MARKS)} AS annex_line, CASE WHEN length(m) > 60 THEN substring(m, 1, 59) || '…' ELSE m END AS short FROM (SELECT *, {_MARKUP} m FROM text_blocks)""")
def norm_marker_lines(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return _blocks(spark, d).select("block_id", X.marker_tab_lines(t).alias("lines"), X.marker_spacing(t).alias("spaced"), X.annex_line(t).alias("annex_line"), X.truncated(t, 60).alias("short"))


@query(f"SELECT analysis_id, {sunquoted('amending_text')} AS unquoted FROM amendment_analysis")
def norm_unquoted(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "amendment_analysis").select("analysis_id", X.unquoted(F.col("amending_text")).alias("unquoted"))


_INSTRUCTS = C.INSTRUCTION.replace("'", "''")


def spayload(source: str, c: str) -> str:
    """``source`` with the payload form of a text as column ``payload``."""
    scaffold = r"(?i)^\([ivxlcdm]+\) +(\([a-z]+\)|in\s+the\b|the\s+following\b|paragraph\b|point\b|Article\b)"
    return steps(
        source, ("p1", f"regexp_replace({sanchorless(c)}, '^{Q}(\\d+[A-Za-z]?\\.|\\([a-z]+\\))', '\\1')"), ("p2", sunquoted("p1")), ("p3", f"regexp_replace(p2, '{scaffold}', '\\1')"),
        ("p4", f"regexp_replace({sclean('p3')}, '(?i)^\\([ivxlcdm]+\\) ', '')"),
        ("payload", rf"CASE WHEN p3 = '' OR regexp_full_match(p4, '\(\d+\)') OR regexp_matches(lower(p4), '{_INSTRUCTS}') OR regexp_full_match({sclean('p3')}, '(?i)\([a-z]+\)|\d+[a-z]?\.') OR regexp_matches(p3, '(?i)^\([a-z]+\)\s*;\s*$') OR regexp_matches(p3, '^;\s*$') THEN '' ELSE {stab('p3')} END"),
    )


_FIRSTWORD = lambda c: rf"lower(regexp_extract(coalesce({c}, ''), '^\s*([A-Za-z0-9]+)\b', 1))"
_RESTED = steps(spayload("SELECT analysis_id, amending_text, best_match_text FROM amendment_analysis", "amending_text"), ("rest", rf"regexp_replace(amending_text, '^{WS}*[A-Za-z0-9]+\b{WS}*', '')"))


@query(
    f"""SELECT analysis_id, payload, regexp_replace({sclean("regexp_replace(" + sunquoted('amending_text') + ", '[[][[]FN:[0-9]+[]][]]', '', 'g')")}, ' +([,.;:])', '\\1', 'g') AS quoted,
    regexp_replace(coalesce(amending_text, ''), '(?:{WS}|[''"“”‘’`´])+', '', 'g') AS bare,
    CASE WHEN {_FIRSTWORD('best_match_text')} <> '' AND {_FIRSTWORD('best_match_text')} = {_FIRSTWORD('amending_text')} AND trim(rest) <> '' THEN rest ELSE amending_text END AS trimmed FROM ({_RESTED})"""
)
def norm_payload(spark: SparkSession, d: str) -> DataFrame:
    from actloom.operators.amendments import item_text

    t = F.col("amending_text")
    return table(spark, d, "amendment_analysis").select("analysis_id", item_text(t).alias("payload"), X.unquoted_payload(t).alias("quoted"), X.quote_noise(t).alias("bare"), X.without_repeated_word(F.col("best_match_text"), t).alias("trimmed"))


_TITLE = rf"regexp_replace(regexp_replace({sclean('title')}, '(?i) (of \d{{1,2}} [a-z]+ \d{{4}}) ', E'\n\\1\n', 'g'), '(?i) (\(Text with EEA relevance\))', E'\n\\1', 'g')"


@query(rf"SELECT act_id, list_filter(list_transform(string_split({_TITLE}, E'\n'), lambda x: trim(x)), lambda x: x <> '') AS lines FROM acts")
def title_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "acts").select("act_id", X.title_lines(F.col("title")).alias("lines"))


@query(rf"SELECT fn_id, regexp_replace(regexp_replace({CLEAN}, '(\d) ([)\].,;:!?])', '\1\2', 'g'), '\( (OJ\b)', '(\1', 'g') AS body FROM footnotes")
def footnote_body(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "footnotes").select("fn_id", X.footnote_body(F.col("text")).alias("body"))


@query(f"SELECT doc_id, len({swords('text')}) AS n, len(list_distinct({swords('text')})) AS n_distinct FROM documents")
def tokens_count(spark: SparkSession, d: str) -> DataFrame:
    w = T.words(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(w).cast("bigint").alias("n"), F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"))


_WORDLIKE = r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}\x{24b6}-\x{24e9}"
_PIECE = rf"\[\[FN:\d+\]\]|\[\[SRC:[^\]]+\]\]|\([A-Za-z0-9]+\)|[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)?|{WS}+|[^{_WORDLIKE}{WS[1:-1]}]"


@query(f"SELECT doc_id, list_slice({swords('text')}, 1, 30) AS tokens FROM documents")
def tokens_first(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.first_tokens(F.col("text")).alias("tokens"))


@query(rf"""SELECT block_id, len(p) AS n, list_transform(p, lambda x: CASE WHEN regexp_full_match(x, '[A-Za-z0-9]+(?:[''-][A-Za-z0-9]+)?') THEN lower(x) ELSE x END) AS keys, array_to_string(p, '') = t AS lossless
  FROM (SELECT block_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{_PIECE}') p FROM text_blocks)""")
def tokens_with_punctuation(spark: SparkSession, d: str) -> DataFrame:
    p = T.pieces(F.col("text"))
    return _blocks(spark, d).select("block_id", F.size(p).alias("n"), F.transform(p, T.match_key).alias("keys"), (F.array_join(p, "") == F.coalesce("text", F.lit(""))).alias("lossless"))


_NOISE = "lambda x: x IN (" + ", ".join(f"'{n}'" for n in T.NOISE) + rf") OR regexp_full_match(x, 'm?\d+|[a-z]|{T.ROMAN}')"


@query(f"WITH w AS (SELECT doc_id, {swords('text')} w FROM documents) SELECT doc_id, len(list_filter(w, lambda x: NOT coalesce(({_NOISE.split(': ', 1)[1]}), false))) AS kept, len(list_filter(w, {_NOISE})) AS excluded FROM w")
def practical_noise_counts(spark: SparkSession, d: str) -> DataFrame:
    w = T.words(F.col("text"))
    kept = F.size(T.practical(w)).cast("bigint")
    return table(spark, d, "documents").select("doc_id", kept.alias("kept"), (F.size(w) - kept).alias("excluded"))


_FN = r"regexp_replace(coalesce(text, ''), '\[\[FN:\d+\]\]', ' ', 'g')"


@query(f"SELECT doc_id, list_slice({swords(sclean(_FN))}, 1, 24) AS probe FROM documents")
def probe_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.probe(F.col("text"), 24).alias("probe"))


_ROLE = rf"""CASE WHEN regexp_matches(m, '^{WS}*\d+\.{WS}+') THEN 'article_paragraph' WHEN regexp_matches(m, '(?i)^{WS}*\(?[a-z]\){WS}+') THEN 'point' WHEN regexp_matches(m, '(?i)^{WS}*\(?[ivxlcdm]+\){WS}+') THEN 'subpoint'
  WHEN list_contains(classes, 'oj-enumeration-spacing') THEN 'enumeration' WHEN list_contains(classes, 'oj-final') THEN 'final' WHEN list_contains(classes, 'oj-signatory') THEN 'signatory' ELSE 'paragraph' END"""


@query(f"SELECT block_id, {_ROLE} AS role FROM (SELECT block_id, classes, {_MARKUP} m FROM text_blocks)")
def block_roles(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", C.block_role(F.col("text"), F.col("classes")).alias("role"))


_TYPE = r"""CASE WHEN regexp_matches(c, '^\d+\.') THEN 'digit' WHEN regexp_matches(c, '^\([a-z]\)') THEN 'letter' WHEN regexp_matches(c, '(?i)^\([ivxlcdm]+\)') THEN 'roman' WHEN regexp_matches(c, '^[—–]') THEN 'dash'
  WHEN regexp_matches(c, '^[A-Z]\.') THEN 'annex-letter' WHEN regexp_matches(c, '(?i)^[ivxlcdm]+\.') THEN 'annex-roman' END"""


@query(f"SELECT block_id, k AS marker_type, CASE WHEN k IN ('digit', 'annex-letter', 'annex-roman') THEN 1 WHEN k = 'letter' THEN 2 WHEN k IN ('roman', 'dash') THEN 3 ELSE 0 END AS level FROM (SELECT block_id, {_TYPE} k FROM (SELECT block_id, {CLEAN} c FROM text_blocks))")
def marker_types(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).select("block_id", C.marker_type(F.col("text")).alias("marker_type"), C.paragraph_level(F.col("text")).alias("level"))


@query(
    rf"""SELECT block_id, regexp_full_match(c, '(?i)\([a-z]+\)|\d+[a-z]?\.') AS bare, regexp_full_match(c, '(?i)\([a-z]+\)') AS list_marker, regexp_full_match(c, '(?i)\([ivxlcdm]+\)|\([a-z]\)|[a-z]\.|[ivxlcdm]+\.|—|–') AS alone,
    {sfirst('c', "^" + Q.replace("''", "'") + r"?(\d+[A-Za-z]?)\.")} AS paragraph, lower({sfirst('c', r"(?i)^\(([a-z]+)\)")}) AS point, upper({sfirst('c', "(?i)^" + Q.replace("''", "'") + r"?([IVXLC]+)\.(?:\s|$)")}) AS annex_point
    FROM (SELECT block_id, {CLEAN} c FROM text_blocks)"""
)
def standalone_markers(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return _blocks(spark, d).select("block_id", X.is_bare_marker(t).alias("bare"), X.is_list_marker(t).alias("list_marker"), C.is_standalone_marker(t).alias("alone"), C.paragraph_marker(t).alias("paragraph"), C.point_marker(t).alias("point"), C.annex_point(t).alias("annex_point"))


_LINES = "SELECT doc_id, unnest(string_split(text, E'\n')) line FROM documents WHERE text IS NOT NULL"
_LC = sclean("line")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


@query(
    f"""WITH l AS (SELECT doc_id, {_LC} c FROM ({_LINES})) SELECT doc_id, c AS line, {sfirst('c', r'(?i)^Article\s+(\d+[A-Za-z]?)\b')} AS article, upper({sfirst('c', r'(?i)^ANNEX\s+([IVXLC]+)\b')}) AS annex,
    upper({sfirst('c', r'(?i)^CHAPTER\s+([IVXLC]+)\b')}) AS chapter, regexp_matches(c, '(?i)^(?:CHAPTER|ANNEX)\\b') AS hard FROM l WHERE regexp_matches(c, '(?i)^(?:Article|ANNEX|CHAPTER)\\b')"""
)
def headings(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c")
    rows = _lines(spark, d).select("doc_id", X.clean(F.col("line")).alias("c")).where(c.rlike(r"(?i)^(?:Article|ANNEX|CHAPTER)\b"))
    return rows.select("doc_id", c.alias("line"), C.article_number(c).alias("article"), C.annex_number(c).alias("annex"), C.chapter_number(c).alias("chapter"), C.is_hard_boundary(c).alias("hard"))


@query(
    f"""SELECT doc_id, line, upper({sfirst(sunquoted(_LC), r'(?i)^ANNEX\s+([IVXLC]+[A-Za-z]?)\b')}) AS label, {sfirst(_LC, '(?i)^(ANNEX [IVXLC]+[A-Za-z]?) .+$')} AS heading, {sfirst(_LC, '(?i)^ANNEX [IVXLC]+[A-Za-z]? (.+)$')} AS title
    FROM ({_LINES}) WHERE regexp_matches({_LC}, '(?i)^(?:CHAPTER|ANNEX)\\b')"""
)
def annex_headings(spark: SparkSession, d: str) -> DataFrame:
    rows = _lines(spark, d).where(C.is_hard_boundary(F.col("line")))
    s = C.annex_heading_and_title(F.col("line"))
    return rows.select("doc_id", "line", C.annex_label(F.col("line")).alias("label"), s["heading"].alias("heading"), s["title"].alias("title"))


@query(
    rf"""SELECT DISTINCT target_article_number AS marker, CASE WHEN regexp_full_match(target_article_number, '\d+[A-Za-z]*') THEN CAST(regexp_extract(target_article_number, '^\d+') AS BIGINT) ELSE 1000000000 END AS n,
    CASE WHEN regexp_full_match(target_article_number, '\d+[A-Za-z]*') THEN lower(regexp_extract(target_article_number, '[A-Za-z]*$')) ELSE lower(target_article_number) END AS suffix FROM amendment_analysis WHERE target_article_number IS NOT NULL"""
)
def sort_keys(spark: SparkSession, d: str) -> DataFrame:
    k = C.sort_key(F.col("target_article_number"))
    return table(spark, d, "amendment_analysis").where("target_article_number is not null").select("target_article_number").distinct().select(F.col("target_article_number").alias("marker"), k["n"].alias("n"), k["s"].alias("suffix"))


@query(
    r"""SELECT analysis_id, CASE WHEN regexp_full_match(article_number, '\d+[A-Za-z]*') THEN regexp_extract(article_number, '^\d+') ELSE article_number END AS number, CASE WHEN regexp_full_match(article_number, '\d+[A-Za-z]*') THEN regexp_extract(article_number, '[A-Za-z]*$') ELSE '' END AS suffix,
    coalesce(lower(target_point_marker) IN ('i', 'ii', 'iii', 'iv', 'v', 'vi', 'vii', 'viii', 'ix', 'x', 'xi', 'xii', 'xiii', 'xiv', 'xv'), false) AS small_roman FROM amendment_analysis"""
)
def split_numbers(spark: SparkSession, d: str) -> DataFrame:
    s = C.split_number(F.col("article_number"))
    return table(spark, d, "amendment_analysis").select("analysis_id", s["number"].alias("number"), s["suffix"].alias("suffix"), C.is_small_roman(F.col("target_point_marker")).alias("small_roman"))


_INSTRUCTION = sclean("source_instruction")
_ARTS = ", ".join(sfirst("i", "(?i)" + p) for p in G.ARTICLE)


@query(
    f"""SELECT analysis_id, coalesce({_ARTS}) AS article, coalesce({sfirst('i', r'(?i)\bparagraph\s+(\d+[A-Za-z]?)\b')}, {sfirst('i', r'(?i)\bArticle\s+\d+[A-Za-z]?\s*\((\d+[A-Za-z]?)\)')}) AS paragraph,
    lower({sfirst('i', r'(?i)\bpoint\s*\(([a-z]+)\)')}) AS point, upper({sfirst('i', r'(?i)\bin\s+Annex\s+([IVXLC]+)\b')}) AS annex, lower({sfirst('i', r'(?i)\bpoint\s+([IVXLC]+)\b')}) AS annex_point,
    {sfirst('i', r'(?i)\b(\d{4}/\d{1,4})\b')} AS regulation, CAST(nullif(list_position(['first', 'second', 'third', 'fourth', 'fifth'], lower({sfirst('i', r'(?i)\b(first|second|third|fourth|fifth)\s+subparagraph\b')})), 0) AS INT) AS subparagraph
    FROM (SELECT analysis_id, {_INSTRUCTION} i FROM amendment_analysis)"""
)
def instruction_targets(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("source_instruction")
    return table(spark, d, "amendment_analysis").select("analysis_id", G.article(i).alias("article"), G.paragraph(i).alias("paragraph"), G.point(i).alias("point"), G.annex(i).alias("annex"), G.annex_point(i).alias("annex_point"), G.regulation(i).alias("regulation"), G.subparagraph_ordinal(i).alias("subparagraph"))


_POINTS = f"list_transform(regexp_extract_all({_INSTRUCTION}, '(?i)\\(([a-z]+)\\)', 1), lambda x: lower(x))"


@query(f"SELECT analysis_id, {sdistinct('p')} AS points FROM (SELECT analysis_id, {_POINTS} p FROM amendment_analysis)")
def instruction_points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "amendment_analysis").select("analysis_id", G.all_points(F.col("source_instruction")).alias("points"))


_ORDINALS = "['first', 'second', 'third', 'fourth', 'fifth']"


@query(
    rf"""SELECT analysis_id, {sdistinct('p')} AS points, CAST(nullif(list_position({_ORDINALS}, lower({sfirst('i', r'(?i)\b(first|second|third|fourth|fifth)\s+(?:sub)?paragraph\b')})), 0) AS INT) AS ordinal,
    upper({sfirst('i', r'(?i)\b(?:is|are)\s+inserted\s+as\s+annex\s+([A-Za-z0-9]+)\b')}) AS inserted_annex, lower({sfirst('i', r'(?i)\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\s*:\s*' + "[‘'" + '"' + r'(\[]*\s*article\s+(\d+[A-Za-z])\b')}) AS inserted_article
    FROM (SELECT analysis_id, {_POINTS} p, {_INSTRUCTION} i FROM amendment_analysis UNION ALL SELECT -analysis_id, {_POINTS}, i || ' the following article is inserted: ‘Article ' || article_number || 'a and is inserted as annex ' || target_annex_number FROM (SELECT *, {_INSTRUCTION} i FROM amendment_analysis))"""
)
def instruction_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """Of every instruction, and of the same with an inserted article and annex behind it (negative ids)."""
    a = table(spark, d, "amendment_analysis")
    more = F.concat(X.clean(F.col("source_instruction")), F.lit(" the following article is inserted: ‘Article "), "article_number", F.lit("a and is inserted as annex "), "target_annex_number")
    both = a.select("analysis_id", F.col("source_instruction").alias("i"), F.col("source_instruction").alias("own")).unionByName(a.select((-F.col("analysis_id")).alias("analysis_id"), more.alias("i"), F.col("source_instruction").alias("own")))
    i = F.col("i")
    return both.select("analysis_id", G.all_points(F.col("own")).alias("points"), G.inner_ordinal(i).alias("ordinal"), G.inserted_annex(i).alias("inserted_annex"), G.inserted_article(i).alias("inserted_article"))


_THING = "(?:paragraph|point|article|subparagraph)s?"
_KIND = rf"""CASE WHEN i = '' THEN 'insertion' WHEN regexp_matches(i, '\breplaced\s+by\s+the\s+following\b|\b(?:is|are)\s+replaced\b') THEN 'replacement' WHEN regexp_matches(i, '\bdeleted\b') THEN 'deletion'
  WHEN regexp_matches(i, '\b(?:is|are)\s+inserted\s+as\s+annex\b') THEN 'insertion' WHEN regexp_matches(i, '\bthe following {_THING}\s+(?:is|are)\s+(?:inserted|added)\b|\bthe following sentence is added\b') THEN 'insertion'
  WHEN regexp_full_match(t, '(?i)\([a-z]+\)|\d+[a-z]?\.') THEN 'structural' ELSE 'insertion' END"""
_OPERATION = r"CASE WHEN regexp_matches(i, '\breplaced\b') THEN 'replace' WHEN regexp_matches(i, '\bdeleted\b') THEN 'delete' WHEN regexp_matches(i, '\b(?:added|inserted)\b') THEN 'insert' ELSE 'unknown' END"
_PART = lambda n, c: f"'{n}/' || nullif({sclean(c)}, '')"
_PATH = f"""CASE WHEN {sclean('target_annex_number')} <> '' THEN concat_ws('/', {_PART('annex', 'target_annex_number')}, {_PART('point', 'target_annex_point_marker')})
  WHEN {sclean('target_article_number')} <> '' THEN concat_ws('/', {_PART('article', 'target_article_number')}, {_PART('paragraph', 'target_paragraph_number')}, {_PART('point', 'target_point_marker')}) ELSE 'unresolved' END"""


@query(f"SELECT analysis_id, {_KIND} AS kind, {_OPERATION} AS operation, p AS path FROM (SELECT analysis_id, lower({_INSTRUCTION}) i, {sclean('amending_text')} t, {_PATH} p FROM amendment_analysis)")
def amendment_kinds(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("source_instruction")
    path = G.target_path(*[F.col(c) for c in ("target_article_number", "target_paragraph_number", "target_point_marker", "target_annex_number", "target_annex_point_marker")])
    return table(spark, d, "amendment_analysis").select("analysis_id", C.amendment_kind(i, F.col("amending_text")).alias("kind"), G.operation_type(i).alias("operation"), path.alias("path"))


@query(
    rf"""SELECT id, regexp_full_match(t, '\(\d+\)') OR regexp_matches(lower(t), '{_INSTRUCTS}') AS instructs FROM (SELECT id, regexp_replace({sclean('x')}, '(?i)^\([ivxlcdm]+\) ', '') t FROM
    (SELECT 2 * analysis_id id, source_instruction x FROM amendment_analysis UNION ALL SELECT 2 * analysis_id + 1, amending_text FROM amendment_analysis))"""
)
def instruction_lines(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "amendment_analysis")
    rows = a.selectExpr("2 * analysis_id id", "source_instruction x").unionByName(a.selectExpr("2 * analysis_id + 1 id", "amending_text x"))
    return rows.select("id", C.is_instruction(F.col("x")).alias("instructs"))


@query(rf"""SELECT analysis_id, c <> '' AND (regexp_matches(c, '(?i)"(?:missing_unique_tokens|missing_tokens|coverage_ratio|comparison_type|report_type|source_docx|source_html|token_coverage)"\s*:')
    OR starts_with(lower(c), '"missing_unique_tokens"') OR (regexp_matches(c, '^[\[{{]') AND regexp_matches(c, '"[^"\\n]+"\s*:\s*')) OR (regexp_matches(c, '[{{\[]') AND len(string_split(c, '":')) > 2)) AS fragment
    FROM (SELECT analysis_id, {sclean('amending_text')} c FROM amendment_analysis)""")
def report_fragments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "amendment_analysis").select("analysis_id", C.is_report_fragment(F.col("amending_text")).alias("fragment"))


_DIGITS = lambda one, five, ten: "['', " + ", ".join(f"'{x}'" for x in (one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten)) + "]"
_ROMAN = lambda n: f"repeat('C', ({n}) // 100) || {_DIGITS('X', 'L', 'C')}[({n}) // 10 % 10 + 1] || {_DIGITS('I', 'V', 'X')}[({n}) % 10 + 1]"


@query(f"SELECT n, {_ROMAN('n')} AS numeral, n AS value, {_ROMAN('n + 1')} AS next FROM (SELECT DISTINCT o_orderkey % 399 n FROM orders) WHERE n > 0")
def roman_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "orders").select((F.col("o_orderkey") % 399).alias("n")).distinct().where("n > 0")
    r = G.roman(F.col("n"))
    return n.select("n", r.alias("numeral"), G.roman_value(r).cast("bigint").alias("value"), G.next_roman(r).alias("next"))


@query("SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'C00000' WHEN n_nationkey % 3 = 1 THEN '0066CC' ELSE upper(lpad(to_hex(n_nationkey), 6, '0')) END AS color FROM nation")
def color_parse(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    raw = F.when(k % 3 == 0, F.lit(" Red ")).when(k % 3 == 1, "blue").otherwise(F.concat(F.lit("#"), F.lpad(F.lower(F.hex(k)), 6, "0")))
    return table(spark, d, "nation").select("n_name", G.color(raw).alias("color"))

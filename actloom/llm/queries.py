"""The named queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.llm import format_dups, lookalike, mixing, near_dups, packing, reading, shared_spans, term_counts, tokens
from actloom.runtime import written

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# 1 -------------------------------------------------------------------------------------------------------------------


NOTE = ["note_id", "marker", "text"]


def _notes(spark: SparkSession, d: str) -> DataFrame:
    parsed = format_dups.as_records(_t(spark, d, "footnotes"), "fn_id", NOTE)
    lines = format_dups.as_records(_t(spark, d, "footnote_lines").select("fn_id", *[F.lit(None).alias(f) for f in NOTE], "line"), "fn_id", NOTE, "line")
    return parsed.unionByName(lines)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return format_dups.format_duplicates(_notes(spark, d), NOTE)


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return format_dups.collapse(_notes(spark, d), NOTE).withColumnRenamed("id", "fn_id")


# 2 -------------------------------------------------------------------------------------------------------------------


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    blocks = _t(spark, d, "text_blocks").select(F.lit("text_blocks").alias("tbl"), F.col("block_id").alias("id"), "text")
    notes = _t(spark, d, "footnotes").select(F.lit("footnotes").alias("tbl"), F.col("fn_id").alias("id"), "text")
    return lookalike.lookalike_sets(blocks.unionByName(notes))


def p2_text_blocks(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.consistent_text(_t(spark, d, "text_blocks").select("block_id", "text"), "text", "consistent")


def p2_footnotes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.consistent_text(_t(spark, d, "footnotes").select("fn_id", "text"), "text", "consistent")


# 3 -------------------------------------------------------------------------------------------------------------------


def _item_texts(spark: SparkSession, d: str) -> DataFrame:
    items = _t(spark, d, "amendment_analysis")
    one = lambda c: items.select(F.lit(c).alias("grp"), F.col("analysis_id").alias("id"), F.col(c).alias("text"))
    return one("amending_text").unionByName(one("best_match_text"))


def _near(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return near_dups.near_links(_item_texts(spark, d), 0.70, 20)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return near_dups.expanded(*_near(spark, d)).withColumnRenamed("grp", "field")


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_dups.classes(*_near(spark, d)).withColumnsRenamed({"grp": "field", "id": "analysis_id"})


# 4 -------------------------------------------------------------------------------------------------------------------


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.item_pairs(*shared_spans.occurrences(_item_texts(spark, d)))


def p4_shares(spark: SparkSession, d: str) -> DataFrame:
    return shared_spans.shared_words(*shared_spans.occurrences(_item_texts(spark, d))).withColumnsRenamed({"grp": "field", "id": "analysis_id"})


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Classes of passages and their members: what p4_found expands into pairs."""
    return shared_spans.classes(*shared_spans.occurrences(_item_texts(spark, d))).withColumnsRenamed({"grp": "field", "id": "analysis_id"})


def p4_passages(spark: SparkSession, d: str) -> DataFrame:
    texts = _item_texts(spark, d)
    return shared_spans.passages(*shared_spans.occurrences(texts), texts).withColumnsRenamed({"grp": "field", "id": "analysis_id"})


# 5 -------------------------------------------------------------------------------------------------------------------


def _reports(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Each report once, the earliest delivery; only the rows of reports that came again are sorted by report."""
    t = _t(spark, d, name).where("report_id is not null")
    cols = [c for c in ("top_missing", "top_extra", "excluded_source_tokens") if c in t.columns]
    again = written(t.groupBy("report_id").count().where("count > 1").select("report_id"), "again")
    several = t.join(again, "report_id", "left_semi").groupBy("report_id").agg(F.min_by(F.struct(*cols), F.struct(F.col("loaded_at").isNull(), "loaded_at", F.xxhash64(*cols))).alias("r"))
    return t.join(again, "report_id", "left_anti").select("report_id", *cols).unionByName(several.select("report_id", "r.*"))


def _terms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    compared, practical = _reports(spark, d, "comparison_results"), _reports(spark, d, "practical_coverage")
    clean = lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))

    def listed(c: str) -> F.Column:
        real = F.filter(c, lambda e: e.isNotNull())
        return F.struct(F.lit(c).alias("field"), F.transform(real, lambda e: clean(F.get(e, 0))).alias("terms"), F.transform(real, lambda e: F.coalesce(F.get(e, 1).try_cast("bigint"), F.lit(0))).alias("weights"))

    lists = compared.select(F.col("report_id").alias("record"), F.explode(F.array(listed("top_missing"), listed("top_extra"))).alias("l")).select("l.field", "record", "l.terms", "l.weights")
    value = F.col("excluded_source_tokens").cast("bigint").cast("string")
    values = practical.select(F.lit("excluded_source_tokens").alias("field"), F.col("report_id").alias("record"), F.array(value).alias("terms"), F.array(F.lit(1).cast("bigint")).alias("weights"))
    seqs = written(lists.unionByName(values), "terms")
    return seqs, seqs.groupBy("field").agg(F.count(F.lit(1)).alias("n_records"))


def p5_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every term, as the prefixes of one term among the suffixes of two; the pairs are p5_phrases'."""
    seqs, sizes = _terms(spark, d)
    got = term_counts.marked(term_counts.term_counts(seqs, 2).where("n = 1"), sizes)
    return got.select("field", F.col("gram").alias("term"), "total", F.col("records").alias("reports"), F.coalesce("mark", F.lit("useful")).alias("mark"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_terms(spark, d).where("mark <> 'useful'").select("field", "term", "mark")


def p5_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Runs of up to three neighbouring terms of the lists."""
    seqs, _ = _terms(spark, d)
    got = term_counts.term_counts(seqs.where("field <> 'excluded_source_tokens'"), 3)
    return got.select("field", F.replace("gram", F.lit(term_counts.SEP), F.lit(" ")).alias("phrase"), "n", "total", F.col("records").alias("reports"))


# 6 and 7 -------------------------------------------------------------------------------------------------------------


def _packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = [(r.pack_name, r.capacity_tokens) for r in _t(spark, d, "pack_sizes").orderBy("capacity_tokens", "pack_name").collect()]
    return packing.pack(tokens.token_lengths(_t(spark, d, "documents"), "doc_id", "text"), sizes)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    largest = _t(spark, d, "pack_sizes").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return _packed(spark, d).join(F.broadcast(largest), "capacity_tokens").where("pieces > 1 and piece = 0").select(F.col("id").alias("doc_id")).distinct()


def p6_assigned(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).withColumnRenamed("id", "doc_id")


def p6_room(spark: SparkSession, d: str) -> DataFrame:
    """Containers, items and unused share of each capacity."""
    used = _packed(spark, d).groupBy("pack_name", "capacity_tokens", "container").agg(F.sum("n_tokens").alias("fill"), F.count(F.lit(1)).alias("items"))
    got = used.groupBy("pack_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"))
    return got.withColumn("unused_share", 1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lengths = written(tokens.token_lengths(_t(spark, d, "documents"), "doc_id", "text", ("source",)).withColumnRenamed("k0", "source"), "lengths")
    return mixing.mix(lengths, _t(spark, d, "mix_targets"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The chosen documents with their repeats, the slot of the schedule at which each first begins, and the shares they give."""
    chosen, _ = _mixed(spark, d)
    share = mixing.shares(chosen).select("mix_name", "source", "actual_share")
    rows = chosen.select("mix_name", "source", F.col("id").alias("doc_id"), "n_tokens", "repeats", "first_slot", "max_repeats", "target_share")
    return rows.join(F.broadcast(share), ["mix_name", "source"])


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(_mixed(spark, d)[0])


def p7_schedule(spark: SparkSession, d: str) -> DataFrame:
    return mixing.schedule(*_mixed(spark, d))


# 8 -------------------------------------------------------------------------------------------------------------------


def _levels(spark: SparkSession, d: str) -> tuple[DataFrame, reading.Model]:
    return reading.levels(_t(spark, d, "documents"), _t(spark, d, "reading_labels"), ("lang", "source"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose level may be an expert reader's (or is unknown), checked by the exact rule."""
    scored, _ = _levels(spark, d)
    expert = scored.where("k0 = 'en'").where(F.coalesce("level", F.lit(float(reading.GRADES))) >= reading.EXPERT_FROM)
    rule = "n_words > 0 and n_words >= 28 * greatest(n_sentences, 1) and n_letters >= 5.5 * n_words"
    return expert.where(rule).select(F.col("id").alias("doc_id"))


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    scored, _ = _levels(spark, d)
    return scored.select(F.col("id").alias("doc_id"), F.col("k0").alias("lang"), F.col("k1").alias("source"), "level", "n_words", (F.col("n_known") / F.nullif("n_words", F.lit(0))).alias("known_share"), "n_sentences", "n_letters")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source and language by whole level."""
    scored, _ = _levels(spark, d)
    band = F.rint("level").cast("int")
    return scored.groupBy(F.col("k1").alias("source"), F.col("k0").alias("lang"), band.alias("band")).agg(F.count(F.lit(1)).alias("documents"), F.avg("level").alias("mean_level"))


def queries() -> dict[str, Query]:
    own = (p1_found, p1_collapsed, p2_found, p2_text_blocks, p2_footnotes, p3_found, p3_groups, p4_found, p4_shares, p4_classes, p4_passages, p5_found, p5_terms, p5_phrases, p6_found, p6_assigned, p6_room, p7_mix, p7_shares, p7_schedule, p8_found, p8_levels, p8_profile)
    return {q.__name__: q for q in own}


_TERMS = r"""
  WITH c AS (SELECT DISTINCT ON (report_id) report_id, top_missing, top_extra FROM comparison_results ORDER BY report_id, loaded_at),
  p AS (SELECT DISTINCT ON (report_id) report_id, excluded_source_tokens e FROM practical_coverage ORDER BY report_id, loaded_at),
  t AS (SELECT 'top_missing' field, report_id, unnest(top_missing) x FROM c UNION ALL SELECT 'top_extra', report_id, unnest(top_extra) FROM c),
  w AS (SELECT field, report_id, lower(trim(x[1])) term, coalesce(try_cast(x[2] AS BIGINT), 0) n FROM t WHERE x[1] IS NOT NULL
    UNION ALL SELECT 'excluded_source_tokens', report_id, CAST(CAST(e AS BIGINT) AS VARCHAR), 1 FROM p WHERE e IS NOT NULL),
  g AS (SELECT field, term, CAST(sum(n) AS BIGINT) total, count(DISTINCT report_id) reports FROM w GROUP BY ALL),
  m AS (SELECT field, term, total, reports, CASE WHEN reports < 3 THEN 'rare'
    WHEN reports > 0.2 * (CASE WHEN field = 'excluded_source_tokens' THEN (SELECT count(*) FROM p) ELSE (SELECT count(*) FROM c) END) THEN 'common' ELSE 'useful' END mark FROM g)
"""

_ITEMS = """
  WITH i AS (SELECT 'amending_text' field, analysis_id id, amending_text t FROM amendment_analysis WHERE amending_text IS NOT NULL
    UNION ALL SELECT 'best_match_text', analysis_id, best_match_text FROM amendment_analysis WHERE best_match_text IS NOT NULL),
"""


_RUNS = lambda c: rf"array_to_string(list_transform(regexp_extract_all(coalesce({c}, ''), '[\p{{L}}\p{{N}}]+'), lambda x: lower(x)), ' ')"
#: fields of raw lines: JSON values, named fields, or what bars or tabs set apart; those beyond the third join it
_NAME = r"(?i)(?:^|[|\t])[ \x{a0}\r\n]*(?:note_id|marker|text)[ \x{a0}\r\n]*[=:]"
_RECORDS = rf"""
  WITH l AS (SELECT fn_id, line, length(line) - length(replace(line, '|', '')) bars, length(line) - length(replace(line, chr(9), '')) tabs FROM footnote_lines WHERE fn_id IS NOT NULL),
  v AS (SELECT fn_id, CASE WHEN starts_with(ltrim(line), '{{') AND json_valid(line) THEN json_extract_string(line, '$.*') WHEN regexp_matches(line, '{_NAME}') THEN string_split(regexp_replace(line, '{_NAME}', chr(1), 'g'), chr(1))[2:]
    WHEN tabs > 0 AND (bars = 0 OR (bars < tabs AND tabs < 3)) THEN string_split(line, chr(9)) ELSE string_split(line, '|') END f FROM l),
  r AS (SELECT fn_id, note_id a, marker b, text c FROM footnotes WHERE fn_id IS NOT NULL UNION ALL SELECT fn_id, f[1], f[2], array_to_string(f[3:], ' ') FROM v),
  k AS (SELECT fn_id, array_to_string(list_sort([{_RUNS('a')}, {_RUNS('b')}, {_RUNS('c')}]), '|') k FROM r), g AS (SELECT fn_id, min(fn_id) OVER (PARTITION BY k) first_id FROM k)
"""

_NEAR = _ITEMS + r"""
  w AS (SELECT field, id, lower(unnest(regexp_extract_all(t, '[\p{L}\p{N}]+'))) x FROM i), n AS (SELECT field, id, count(*) n, array_to_string(list_sort(list(x)), ' ') k FROM w GROUP BY ALL HAVING count(*) >= 20),
  c AS (SELECT field, id, x, count(*) k FROM w JOIN n USING (field, id) GROUP BY ALL),
  o AS (SELECT a.field, a.id a_id, b.id b_id, sum(least(a.k, b.k)) s FROM c a JOIN c b ON a.field = b.field AND a.x = b.x AND a.id <> b.id GROUP BY ALL),
  e AS (SELECT o.field, a_id, b_id, a.k ka, b.k kb FROM o JOIN n a ON a.field = o.field AND a.id = a_id JOIN n b ON b.field = o.field AND b.id = b_id WHERE s >= 0.7 * (a.n + b.n - s)),
  z(field, id, other) AS (SELECT field, id, id FROM n UNION SELECT z.field, z.id, e.b_id FROM z JOIN e ON e.field = z.field AND e.a_id = z.other)
"""

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SHARED = _ITEMS + rf"""
  w AS (SELECT field, id, string_split_regex(regexp_replace(t, '^{_SPACE}|{_SPACE}$', '', 'g'), '{_SPACE}') ws FROM i), l AS (SELECT * FROM w WHERE len(ws) >= 20),
  s AS (SELECT field, id, p, array_to_string(ws[p : p + 19], ' ') g FROM (SELECT field, id, ws, unnest(range(1, len(ws) - 18)) p FROM l)),
  h AS (SELECT g FROM s GROUP BY g HAVING count(DISTINCT id) > 1), c AS (SELECT DISTINCT field, id, p + d q FROM s JOIN h USING (g), (SELECT unnest(range(0, 20)) d))
"""

_PHRASES = r"""
  WITH c AS (SELECT DISTINCT ON (report_id) report_id, top_missing, top_extra FROM comparison_results ORDER BY report_id, loaded_at),
  t AS (SELECT 'top_missing' field, report_id, top_missing l FROM c UNION ALL SELECT 'top_extra', report_id, top_extra FROM c),
  k AS (SELECT field, report_id, list_filter(l, lambda x: x IS NOT NULL AND x[1] IS NOT NULL) l FROM t WHERE l IS NOT NULL),
  u AS (SELECT field, report_id, list_transform(l, lambda x: lower(trim(x[1]))) ts, list_transform(l, lambda x: coalesce(try_cast(x[2] AS BIGINT), 0)) ns FROM k),
  g AS (SELECT field, report_id, unnest(range(1, len(ts) + 1)) p, ts, ns FROM u), o AS (SELECT field, report_id, ns[p] w, n, array_to_string(ts[p : p + n - 1], ' ') phrase FROM g, (SELECT unnest([1, 2, 3]) n) WHERE p + n - 1 <= len(ts))
  SELECT field, phrase, n, CAST(sum(w) AS BIGINT) total, count(DISTINCT report_id) reports FROM o GROUP BY field, phrase, n"""


def _form_sql(c: str) -> str:
    """The consistent form in SQL: what maps to one sign or to none by one translation, the rest one by one, then composition and spaces."""
    start, length, flat, _, _ = lookalike.mappings(lookalike.CONFUSABLES)
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    one, gone, many = [], [], []
    for i in np.flatnonzero(start != np.arange(len(start))).tolist():
        t = unicodedata.normalize("NFC", "".join(map(chr, flat[start[i] : start[i] + length[i]])))
        if i and t != chr(i):
            (one if len(t) == 1 else many if t else gone).append((chr(i), t))
    text = f"translate({c}, {quoted(''.join(a for a, _ in one) + ''.join(a for a, _ in gone))}, {quoted(''.join(b for _, b in one))})"
    for a, b in many:
        text = f"replace({text}, {quoted(a)}, {quoted(b)})"
    return f"trim(regexp_replace(nfc_normalize({text}), ' +', ' ', 'g'))"


def oracle_sql() -> dict[str, str]:
    form = _form_sql("text")
    return {
        "p2_found": f"""WITH t AS (SELECT 'text_blocks' tbl, block_id id, text FROM text_blocks WHERE text <> '' UNION ALL SELECT 'footnotes', fn_id, text FROM footnotes WHERE text <> ''), k AS (SELECT tbl, id, text, {form} k FROM t),
  g AS (SELECT tbl, id, min(id) OVER w first_id, min(text) OVER w <> max(text) OVER w several FROM k WINDOW w AS (PARTITION BY tbl, k)) SELECT DISTINCT tbl, first_id, id other_id FROM g WHERE several AND id <> first_id""",
        "p2_text_blocks": f"SELECT block_id, text, {form} consistent FROM text_blocks",
        "p2_footnotes": f"SELECT fn_id, text, {form} consistent FROM footnotes",
        "p1_found": _RECORDS + " SELECT DISTINCT first_id, fn_id copy_id FROM g WHERE fn_id <> first_id",
        "p1_collapsed": _RECORDS + " SELECT first_id fn_id, count(DISTINCT fn_id) copies FROM g GROUP BY first_id",
        "p3_groups": _NEAR.replace("WITH i AS", "WITH RECURSIVE i AS") + """ SELECT n.field, n.id analysis_id, m.class_id, coalesce(d.n_links, 0) n_links FROM n JOIN (SELECT field, id, min(other) class_id FROM z GROUP BY ALL) m ON m.field = n.field AND m.id = n.id
    LEFT JOIN (SELECT field, a_id, count(DISTINCT kb) n_links FROM e WHERE ka <> kb GROUP BY ALL) d ON d.field = n.field AND d.a_id = n.id""",
        "p4_shares": _SHARED + " SELECT l.field, l.id analysis_id, len(ws) n_words, coalesce(k.n, 0) shared_words, coalesce(k.n, 0) / len(ws) share FROM l LEFT JOIN (SELECT field, id, count(*) n FROM c GROUP BY ALL) k ON k.field = l.field AND k.id = l.id",
        "p4_passages": _SHARED + """, j AS (SELECT *, q - row_number() OVER (PARTITION BY field, id ORDER BY q) isle FROM c), r AS (SELECT field, id, min(q) - 1 first_word, count(*) n_words FROM j GROUP BY field, id, isle)
  SELECT r.field, r.id analysis_id, first_word, n_words, array_to_string(ws[first_word + 1 : first_word + n_words], ' ') passage FROM r JOIN l ON l.field = r.field AND l.id = r.id""",
        "p5_phrases": _PHRASES,
        "p6_found": r"SELECT DISTINCT doc_id FROM documents WHERE len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^ A-Za-z0-9]+')) > (SELECT max(capacity_tokens) FROM pack_sizes)",
        "p3_found": _ITEMS + r"""
  w AS (SELECT field, id, lower(unnest(regexp_extract_all(t, '[\p{L}\p{N}]+'))) x FROM i),
  n AS (SELECT field, id, count(*) n FROM w GROUP BY ALL HAVING count(*) >= 20),
  c AS (SELECT field, id, x, count(*) k FROM w JOIN n USING (field, id) GROUP BY ALL),
  o AS (SELECT a.field, a.id a_id, b.id b_id, sum(least(a.k, b.k)) s FROM c a JOIN c b ON a.field = b.field AND a.x = b.x AND a.id < b.id GROUP BY ALL)
  SELECT o.field, a_id, b_id FROM o JOIN n a ON a.field = o.field AND a.id = a_id JOIN n b ON b.field = o.field AND b.id = b_id
  WHERE s >= 0.7 * (a.n + b.n - s)""",
        "p4_found": _ITEMS + r"""
  w AS (SELECT id, string_split_regex(trim(t, E' \t\n\r\f\v'), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+') ws FROM i),
  s AS (SELECT DISTINCT id, array_to_string(ws[p : p + 19], ' ') g FROM (SELECT id, ws, unnest(range(1, len(ws) - 18)) p FROM w WHERE len(ws) >= 20))
  SELECT DISTINCT a.id a_id, b.id b_id FROM s a JOIN s b ON a.g = b.g AND a.id < b.id""",
        "p5_terms": _TERMS + " SELECT * FROM m",
        "p5_found": _TERMS + " SELECT field, term, mark FROM m WHERE mark <> 'useful'",
        "p8_found": r"""
  WITH d AS (SELECT doc_id, text, regexp_extract_all(text, '\p{L}+') w,
      regexp_extract_all(regexp_replace(text, '(^|[^\p{L}])(Art|No|cf|p|para)\.', '\1', 'g'), '[.!?](?:\s|[\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]|$)') s
    FROM documents WHERE lang = 'en' AND text IS NOT NULL AND doc_id IS NOT NULL)
  SELECT doc_id FROM d WHERE len(w) > 0 AND len(w) >= 28 * greatest(len(s), 1) AND length(array_to_string(w, '')) >= 5.5 * len(w)""",
    }

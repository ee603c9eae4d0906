"""Audits of applied amendments: grouped flags, semi joins against the output's tokens, windows for order."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.functions import tokens as T
from actloom.operators import ordered, ranges
from actloom.runtime import partitions

APPLIED = ("replaced", "inserted", "already_applied")
TARGETS = ("target_article_number", "target_paragraph_number", "target_point_marker", "target_annex_number", "target_annex_point_marker")


def _key(*cols: str) -> list[Column]:
    return [X.clean(F.col(c)).alias(c) for c in cols]


#: cases a report shows of each finding (fixed values)
SHOWN, SHOWN_ORDER = 25, 20


def examples(cases: DataFrame, n: int = SHOWN, by: str = "item_idx") -> DataFrame:
    """(doc_id, examples): the first n cases of a document; ranked first, so that no list grows with the cases."""
    first = cases.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(by))).where(F.col("r") <= n)
    return first.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", F.col(by).alias("x")))), lambda e: e["x"]).alias("examples"))


def output_tokens(paragraphs: DataFrame) -> DataFrame:
    """(doc_id, tokens) of the visible text, struck text included, in order.  One document's text is one row."""
    lines = paragraphs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("ord", X.normalized(F.col("text")).alias("t")))).alias("l"))
    return lines.select("doc_id", T.words(F.array_join(F.transform("l", lambda x: x["t"]), " ")).alias("tokens"))


KEY = 6  # tokens by which a probe finds its places; shorter probes use all they have


def places(paragraphs: DataFrame, longest: int = 24) -> DataFrame:
    """(doc_id, window): for every token of a document (doc_id, ord, text) the ``longest`` tokens from it on.

    A line sees the first tokens of the lines after it, so a document is never one row.
    """
    lines = paragraphs.select("doc_id", "ord", T.words(X.normalized(F.col("text"))).alias("own")).where(F.size("own") > 0)
    after = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(1, longest)
    lines = lines.withColumn("line", F.concat("own", F.slice(F.flatten(F.collect_list(F.slice("own", 1, longest)).over(after)), 1, longest)))
    return lines.select("doc_id", "line", F.explode(F.sequence(F.lit(1), F.size("own"))).alias("i")).select("doc_id", F.slice("line", F.col("i"), longest).alias("window"))


def probe_matches(probes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, item_idx, matched): how many leading tokens of each probe stand together in its document's output, at most.

    ``probes``: doc_id, item_idx, probe.  An equi join on document and leading tokens, so neither a hot document nor a
    long output meets all of its items.  Most probes have ``KEY`` tokens or more and one key of the output; the few shorter
    ones meet the keys of their own length, of which the output gives only those that such probes have.
    """
    p = probes.where(F.size("probe") > 0).withColumn("k", F.least(F.lit(KEY), F.size("probe"))).withColumn("key", F.array_join(F.slice("probe", 1, F.col("k")), " ")).select("doc_id", "item_idx", "probe", "k", "key")
    at = places(paragraphs)
    full = at.where(F.size("window") >= KEY).select("doc_id", F.lit(KEY).alias("k"), F.array_join(F.slice("window", 1, KEY), " ").alias("key"), "window")
    lengths = p.where(F.col("k") < KEY).select("doc_id", "k").distinct()
    short = at.join(lengths, "doc_id").where(F.size("window") >= F.col("k")).select("doc_id", "k", F.array_join(F.slice("window", 1, F.col("k")), " ").alias("key"), F.slice("window", 1, F.col("k")).alias("window"))
    short = short.join(p.where(F.col("k") < KEY).select("doc_id", "k", "key").distinct(), ["doc_id", "k", "key"], "left_semi").distinct()
    same = F.aggregate(F.zip_with("probe", "window", lambda a, b: F.coalesce(a == b, F.lit(False))), F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, e: F.struct((s["n"] + (s["on"] & e).cast("int")).alias("n"), (s["on"] & e).alias("on")), lambda s: s["n"])
    hit = p.join(full.unionByName(short), ["doc_id", "k", "key"]).select("doc_id", "item_idx", same.alias("n"))
    return hit.groupBy("doc_id", "item_idx").agg(F.max("n").alias("matched"))


def _met(probes: DataFrame, lines: DataFrame, meet: Callable[[str, Iterator[dict], Iterator[dict]], Iterator[dict]], result: str, fields: dict[str, pa.DataType]) -> DataFrame:
    """What ``meet`` gives of the probes and then the lines of each document, both as they come from a sort.

    ``probes``: doc_id, item_idx, probe; ``lines``: doc_id, ord, words and optionally article and start.  Every line is sent
    once, however many probes its document has; a document's probes are held, its lines are not.
    """
    column = lambda df, c, t: (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
    kinds = {"item_idx": "bigint", "probe": "array<string>", "ord": "bigint", "article": "string", "start": "bigint", "words": "array<string>"}
    both = [df.select("doc_id", *[column(df, c, t) for c, t in kinds.items()]) for df in (probes, lines)]
    rows = both[0].unionByName(both[1]).repartition(4 * partitions(lines.sparkSession), "doc_id").sortWithinPartitions("doc_id", F.col("probe").isNull(), "ord")
    schema = pa.schema(list(fields.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for name, own in groupby((r for b in batches for r in b.to_pylist()), lambda r: r["doc_id"]):
            held, first = [], None
            for first in own:
                if first["probe"] is None:
                    break
                held.append(first)
                first = None
            if held and first:
                out += meet(name, iter(held), (r for part in ((first,), own) for r in part))
            if len(out) > SENT:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(run, result)


SENT = 4096  # rows of a result that are sent on together


def _in_order(name: str, probes: Iterator[dict], lines: Iterator[dict]) -> Iterator[dict]:
    """Probes whose words stand in the document in this order: each waits for its next word."""
    waiting: dict[str, list[tuple[list[str], int, int]]] = defaultdict(list)
    for r in probes:
        if r["probe"]:
            waiting[r["probe"][0]].append((r["probe"], 1, r["item_idx"]))
    for line in lines:
        for w in line["words"] or ():
            for probe, n, item in waiting.pop(w, ()):
                if n == len(probe):
                    yield {"doc_id": name, "item_idx": item}
                else:
                    waiting[probe[n]].append((probe, n + 1, item))


def in_order(probes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, item_idx) of the probes (doc_id, item_idx, probe) whose words stand in their document's text in this order, other words between them or not."""
    lines = paragraphs.select("doc_id", "ord", T.words(X.normalized(F.col("text"))).alias("words"))
    return _met(probes, lines, _in_order, "doc_id string, item_idx bigint", {"doc_id": pa.string(), "item_idx": pa.int64()})


def _in_sections(name: str, probes: Iterator[dict], lines: Iterator[dict]) -> Iterator[dict]:
    """How many leading words of each probe stand together in each section at most, where its first ``KEY`` do."""
    known: dict[int, dict[tuple[str, ...], list[tuple[list[str], int]]]] = defaultdict(lambda: defaultdict(list))
    for r in probes:
        if r["probe"]:
            k = min(KEY, len(r["probe"]))
            known[k][tuple(r["probe"][:k])].append((r["probe"], r["item_idx"]))
    for (article, start), own in groupby(lines, lambda r: (r["article"], r["start"])):
        words, best = [w for r in own for w in r["words"] or ()], {}
        for k, keys in known.items():
            for p in range(len(words) - k + 1):
                for probe, item in keys.get(tuple(words[p : p + k]), ()):
                    n, most = k, min(len(probe), len(words) - p)
                    while n < most and words[p + n] == probe[n]:
                        n += 1
                    best[item] = max(best.get(item, 0), n)
        for item, n in best.items():
            yield {"doc_id": name, "item_idx": item, "article": article, "start": start, "matched": n}


def section_matches(probes: DataFrame, sections: DataFrame) -> DataFrame:
    """(doc_id, item_idx, article, start, matched): how many leading words of each probe stand together in a section of its document.

    ``sections``: doc_id, ord, text with article and start, as :func:`ranges.sectioned` gives them.
    """
    lines = sections.select("doc_id", "ord", "article", "start", T.words(X.normalized(F.col("text"))).alias("words"))
    fields = {"doc_id": pa.string(), "item_idx": pa.int64(), "article": pa.string(), "start": pa.int64(), "matched": pa.int32()}
    return _met(probes, lines, _in_sections, "doc_id string, item_idx bigint, article string, start bigint, matched int", fields)


def _found(matched: Column, size: Column, shorter: tuple[int, ...]) -> Column:
    """Whether the whole probe or one of the shorter prefixes stands in the output."""
    return F.coalesce((size > 0) & (matched >= F.least(size, F.lit(min(shorter)))), F.lit(False))


def application(items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """One row a document: inserted items missing from the output, replaced items found, replacement groups not applied.

    ``items``: doc_id, item_idx, amending_text, source_instruction, applied_mode, targets; ``paragraphs``: doc_id, ord, text.
    """
    mode = X.clean(F.col("applied_mode"))
    rows = items.withColumns({"mode": mode, "probe": T.probe(F.col("amending_text"), 24), "replacing": X.clean(F.col("source_instruction")).rlike(r"(?i)\breplaced by the following\b")})
    rows = rows.join(probe_matches(rows, paragraphs), ["doc_id", "item_idx"], "left").withColumn("probed", F.size("probe") > 0)
    size16 = F.least(F.size("probe"), F.lit(16))
    rows = rows.withColumns({"found24": _found(F.col("matched"), F.size("probe"), (18, 12, 8)), "found16": _found(F.col("matched"), size16, (12, 8, 6))})
    first = F.struct("item_idx", "mode", X.clean(F.col("source_instruction")).alias("i"), F.lower(X.clean(F.col("target_point_marker"))).alias("p"))
    groups = rows.where("replacing").groupBy("doc_id", *_key("source_instruction", *TARGETS)).agg(F.bool_or(F.col("mode").isin("replaced", "already_applied") | F.col("found16")).alias("ok"), F.min(first).alias("f"))
    excused = (F.col("f.mode") == "analysis_only") & ((F.col("f.p").rlike(f"^{T.ROMAN}$") & (F.col("f.p") != "")) | F.col("f.i").rlike(r"(?i)\bintroductory\s+(?:wording|sentence)\b"))
    bad = groups.where(~F.col("ok") & ~excused).groupBy("doc_id").agg(F.count(F.lit(1)).alias("replacement_instruction_items_not_properly_applied"))
    n = lambda c: F.sum(c.cast("bigint"))
    got = rows.groupBy("doc_id").agg(
        n(F.col("mode") == "inserted").alias("inserted_items_checked"),
        n((F.col("mode") == "inserted") & F.col("probed") & ~F.col("found24")).alias("inserted_items_missing_from_output"),
        n(F.col("mode") == "replaced").alias("replaced_items_checked"),
        n((F.col("mode") == "replaced") & F.col("found16")).alias("replaced_items_with_new_text_detected"),
        n(F.col("replacing")).alias("replacement_instruction_items_checked"),
    )
    return got.join(bad, "doc_id", "left").fillna(0, ["replacement_instruction_items_not_properly_applied"])


def application_examples(items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, examples): the first items that are told as inserted and whose text the output lacks."""
    rows = items.where(X.clean(F.col("applied_mode")) == "inserted").withColumn("probe", T.probe(F.col("amending_text"), 24)).where(F.size("probe") > 0)
    rows = rows.join(probe_matches(rows, paragraphs), ["doc_id", "item_idx"], "left")
    return examples(rows.where(~_found(F.col("matched"), F.size("probe"), (18, 12, 8))))


def one_go(items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """One row a document: whether every group of substantive items was applied or stands in the output.

    Items that are still open after the joins take part in the ordered search, one pass over the output for all of them.
    """
    probe = F.slice(T.words(X.clean(F.col("amending_text"))), 1, 24)
    rows = items.withColumn("probe", probe).where(F.size("probe") > 0)
    rows = rows.join(probe_matches(rows, paragraphs), ["doc_id", "item_idx"], "left")
    rows = rows.withColumn("open", X.clean(F.col("applied_mode")) == "analysis_only").withColumn("ok", ~F.col("open") | _found(F.col("matched"), F.size("probe"), (18, 12, 8)))
    # eight in order follow from twelve in order
    left = rows.where("not ok").where(F.size("probe") >= 8).select("doc_id", "item_idx", F.slice("probe", 1, 8).alias("probe"))
    loose = in_order(left, paragraphs).select("doc_id", "item_idx", F.lit(True).alias("loose")).distinct()
    rows = rows.join(loose, ["doc_id", "item_idx"], "left").withColumn("ok", F.col("ok") | F.coalesce("loose", F.lit(False)))
    group = Window.partitionBy("doc_id", *_key("article_number", *TARGETS, "source_instruction"))
    rows = rows.withColumn("ok", F.max("ok").over(group)).select("doc_id", "item_idx", "ok")
    got = rows.groupBy("doc_id").agg(F.bool_and("ok").alias("passed"), F.count(F.lit(1)).alias("substantive_items_total"), F.sum((~F.col("ok")).cast("bigint")).alias("substantive_items_not_fully_applied"))
    return got.join(examples(rows.where("not ok")), "doc_id", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<bigint>")))


def operation_proofs(items: DataFrame) -> DataFrame:
    """One row an item: operation, target path, preconditions, status.  ``items`` as analysis rows with doc_id and item_idx."""
    kind = F.col("amendment_kind") if "amendment_kind" in items.columns else None
    op = G.operation_type(F.col("source_instruction"), kind)
    changes = op.isin("replace", "delete")
    ordinal = X.clean(F.col("source_instruction")).rlike(r"(?i)\b(?:first|second|third|fourth|fifth)\s+(?:sub)?paragraph\b")
    some = lambda c: X.clean(F.col(c)) != ""
    text, scope, para = some("amending_text"), ~changes | some(TARGETS[0]) | some(TARGETS[3]), ~(changes & ordinal) | some(TARGETS[1])
    passed, proven = text & scope & para, X.clean(F.col("applied_mode")).isin(*APPLIED)
    return ordered.numbered(items, "doc_id", "item_idx", "_nth").select(
        "doc_id", F.format_string("op_%04d", "_nth").alias("operation_id"), op.alias("operation_type"), G.target_path(*[F.col(c) for c in TARGETS]).alias("target_path"),
        text.alias("has_amending_text"), scope.alias("has_scope_target"), para.alias("has_required_paragraph_scope"), passed.alias("preconditions_passed"), proven.alias("mutation_proven"), F.when(passed & proven, "proven").otherwise("unresolved").alias("status"),
    )


def proof_summary(proofs: DataFrame) -> DataFrame:
    bad, left = (~F.col("preconditions_passed")).cast("bigint"), (F.col("status") != "proven").cast("bigint")
    return proofs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("operations_total"), F.sum(bad).alias("precondition_failures"), F.sum(left).alias("unresolved_operations"), (F.sum(left) == 0).alias("all_operations_proven"))


def order(paragraphs: DataFrame) -> DataFrame:
    """One row a document: sections with markers, markers, inversions."""
    inside = ranges.sectioned(paragraphs).where("article is not null and ord > start").where(C.spaced_paragraph_marker(F.col("text")).isNotNull())
    seen = inside.groupBy("doc_id").agg(F.countDistinct("start").alias("article_sections_checked"), F.count(F.lit(1)).alias("paragraph_markers_checked"))
    wrong = ranges.marker_inversions(paragraphs)
    bad = wrong.groupBy("doc_id").agg(F.count(F.lit(1)).alias("marker_order_inversions"))
    shown = examples(wrong.withColumn("ord", F.col("ord").cast("bigint")), SHOWN_ORDER, "ord")
    got = seen.join(bad, "doc_id", "left").fillna(0, ["marker_order_inversions"]).join(shown, "doc_id", "left")
    return got.withColumn("examples", F.coalesce("examples", F.array().cast("array<bigint>")))


def placement(items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """One row an inserted-article item: where its text stands.

    ``items``: doc_id, item_idx, text, inserted_article_marker, target_article_number; ``paragraphs``: doc_id, ord, text
    (effective text).  A section is read once for all items of its document.
    """
    marked = items.withColumn("marker", F.lower(X.clean(F.col("inserted_article_marker")))).where("marker <> ''").withColumn("probe", T.probe(F.col("text"), 24)).withColumn("target", F.lower(X.clean(F.col("target_article_number"))))
    exact = paragraphs.where(X.clean(F.col("text")).rlike(r"(?i)^Article\s+\S+$")).groupBy("doc_id", F.lower(C.article_number(F.col("text"))).alias("marker")).agg(F.count(F.lit(1)).alias("exact_headings"))
    sections = ranges.sectioned(paragraphs).where("article is not null")
    heads = sections.groupBy("doc_id", F.col("article").alias("marker")).agg(F.min("start").cast("bigint").alias("own"))
    at = section_matches(marked.select("doc_id", "item_idx", "probe"), sections)
    rows = marked.select("doc_id", "item_idx", "marker", "target", F.size("probe").alias("n")).join(heads, ["doc_id", "marker"], "left").join(at, ["doc_id", "item_idx"], "left")
    hit, other = F.coalesce(F.col("matched") == F.col("n"), F.lit(False)), F.col("article") != F.col("marker")
    near = _found(F.col("matched"), F.col("n"), (18, 12, 8)) & (F.col("start") == F.col("own")) & ~other
    got = rows.groupBy("doc_id", "item_idx", "marker").agg(
        F.bool_or(F.col("own").isNotNull()).alias("has_heading"), F.bool_or(F.coalesce(near, F.lit(False))).alias("in_section"), F.max("n").alias("probe_size"),
        F.size(F.collect_set(F.when(other & hit, F.col("article")))).alias("other_sections"),
        F.bool_or(F.coalesce(hit & other & (F.col("article") == F.col("target")), F.lit(False))).alias("in_target"),
    )
    got = got.join(exact, ["doc_id", "marker"], "left").fillna(0, ["exact_headings"])
    checked = F.col("has_heading") & (F.col("probe_size") >= 6)
    return got.select("doc_id", "item_idx", "marker", (~F.col("has_heading")).alias("missing_heading"), (F.col("exact_headings") == 0).alias("missing_exact_heading"), (F.col("exact_headings") > 1).alias("duplicate_heading"),
                      (checked & ~F.col("in_section")).alias("missing_in_section"), (checked & F.col("in_target")).alias("found_before"), (checked & (F.col("other_sections") >= 2)).alias("found_elsewhere"))


def revision_formatting(paragraphs: DataFrame, color: str) -> DataFrame:
    """One row a document: inserted and struck runs, in all and in the colour of the layer.  ``paragraphs``: doc_id, runs."""
    runs = paragraphs.select("doc_id", F.explode("runs").alias("r")).where(X.clean(F.col("r.text")) != "")
    ins, cut, own = F.coalesce(F.col("r.double_underline"), F.lit(False)), F.coalesce(F.col("r.strike"), F.lit(False)), F.coalesce(F.upper("r.color") == color, F.lit(False))
    n = lambda c: F.sum(c.cast("bigint"))
    got = runs.groupBy("doc_id").agg(n(ins).alias("inserted_runs_total"), n(cut).alias("deleted_runs_total"), n(ins & own).alias("inserted_runs_current"), n(cut & own).alias("deleted_runs_current"))
    return got.withColumns({"inserted_runs_other": F.col("inserted_runs_total") - F.col("inserted_runs_current"), "deleted_runs_other": F.col("deleted_runs_total") - F.col("deleted_runs_current")})


def annex_checks(items: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """(doc_id, label, present, in_order): annexes that instructions insert; a label with suffix A stands behind its base and before the next numeral."""
    want = items.select("doc_id", G.inserted_annex(F.col("source_instruction")).alias("label")).where("label is not null").distinct()
    head = C.found(X.clean(F.col("text")), r"(?i)^ANNEX\s+([A-Za-z0-9]+)\b")
    at = paragraphs.select("doc_id", F.upper(head).alias("label"), "ord").where("label is not null").groupBy("doc_id", "label").agg(F.min("ord").alias("at"))
    base = C.found(F.col("label"), r"^([IVXLC]+)A$")
    rows = want.withColumn("base", base).withColumn("next", G.next_roman(base)).join(at, ["doc_id", "label"], "left")
    for c in ("base", "next"):
        rows = rows.join(at.withColumnsRenamed({"label": c, "at": f"{c}_at"}), ["doc_id", c], "left")
    ok = F.coalesce(F.col("at") > F.col("base_at"), F.lit(True)) & F.coalesce(F.col("at") < F.col("next_at"), F.lit(True))
    return rows.select("doc_id", "label", F.col("at").isNotNull().alias("present"), ok.alias("in_order"))


def gate(proofs: DataFrame, check: DataFrame, allow_partial: bool = False) -> None:
    """Raise if an operation lacks a precondition or a document was not applied in one go, unless partial application is allowed."""
    if allow_partial:
        return
    if not proofs.where("not preconditions_passed").isEmpty():
        raise RuntimeError("operations without their preconditions")
    if not check.where("not passed").isEmpty():
        raise RuntimeError("amendments not applied in one go")


def retrofit(paragraphs: DataFrame, items: DataFrame) -> DataFrame:
    """Paragraphs whose text an amendment of their document inserts (semi join)."""
    new = items.select("doc_id", X.clean(F.col("amending_text")).alias("t")).where("t <> ''")
    return paragraphs.withColumn("t", X.clean(F.col("text"))).join(new, ["doc_id", "t"], "left_semi").drop("t")


def footnote_ids(references: DataFrame, bodies: DataFrame) -> DataFrame:
    """(doc_id, number, new_id, body): ids by first appearance, unreferenced numbers after them; a missing body is told.

    ``references``: doc_id, pos, number; ``bodies``: doc_id, number, body.
    """
    first = references.groupBy("doc_id", "number").agg(F.min("pos").alias("at"))
    both = first.join(bodies, ["doc_id", "number"], "full_outer")
    w = Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("at"), F.col("number").try_cast("bigint"), "number")
    missing = F.concat(F.lit("[Missing footnote text "), F.col("number"), F.lit("]"))
    return both.select("doc_id", "number", F.row_number().over(w).alias("new_id"), F.coalesce(F.nullif("body", F.lit("")), missing).alias("body"))

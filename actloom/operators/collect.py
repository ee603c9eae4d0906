"""Amendment items from the lines of amending articles.

Everything that depends on one line alone (what kind of line it is, what it points at) is a column computed in the JVM.
Only the context that lines leave to later ones is folded, per (doc_id, article), which is the unit of the context.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.operators.amendments import item_text
from actloom.runtime import partitions

ITEMS = (
    "doc_id string, article_number string, article_heading string, pos int, nth int, text string, amendment_kind string, target_article_number string, target_paragraph_number string, "
    "target_point_marker string, target_annex_number string, target_annex_point_marker string, inserted_article_marker string, source_instruction string"
)


@dataclass
class Context:
    """What an instruction leaves to the lines below it."""

    article: str | None = None
    paragraph: str | None = None
    point: str | None = None
    annex: str | None = None
    annex_point: str | None = None
    inserted: str | None = None
    instruction: tuple | None = None
    above_paragraph: str | None = None
    above_point: str | None = None

    def clear(self, keep: tuple[str, ...] = ()) -> None:
        for f in fields(self):
            if f.name not in keep:
                setattr(self, f.name, None)


def described(lines: DataFrame) -> DataFrame:
    """``lines`` (doc_id, article_number, article_heading, pos, text, in_table, near_article) with what each line says."""
    lines = lines.withColumn("text", X.once(X.clean(F.col("text")))).where(F.col("text") != "").withColumn("payload", X.once(item_text(F.col("text"))))
    t, payload = F.col("text"), F.col("payload")
    i = F.lower(t)
    return lines.where(~C.is_report_fragment(t)).select(
        "doc_id", "article_number", "article_heading", "pos", "in_table", t.alias("line"), C.is_instruction(t).alias("instructs"), t.rlike(r"^\(\d+\)$").alias("numbers"),
        i.rlike(r"\bthe following points?\s+(?:is|are)\s+(?:added|inserted)\b").alias("adds_point"), i.rlike(r"\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\b").alias("adds_article"),
        i.rlike(r"\bthe following articles?\s+(?:is|are)\s+inserted\b").alias("inserts_article"), i.rlike(r"\bannex\s+[ivxlc0-9]+\b").alias("names_annex"),
        i.rlike(r"\b(?:point|points|introductory wording|sentence|subparagraph)\b").alias("relative"), i.rlike(r"\b(?:is|are)\s+deleted\b").alias("deletes"), i.rlike(r"\breplaced by the following\b").alias("replaces"),
        G.article(t).alias("art"), G.paragraph(t).alias("par"), G.point(t).alias("pt"), G.all_points(t).alias("pts"), G.annex(t).alias("ann"), G.annex_point(t).alias("ann_pt"),
        F.coalesce(G.inserted_article(t), F.lower("near_article")).alias("new_article"), F.lower(C.found(X.without_marker_quote(X.unquoted(t)), r"(?i)^\(([a-z]+)\)$")).alias("lone"), "payload",
        C.paragraph_marker(payload).alias("p_marker"), C.point_marker(payload).alias("pt_marker"),
    )


def _opt(v: object) -> str | None:
    return None if v is None or v != v or v == "" else v  # type: ignore[return-value]


def _instruct(c: Context, r: tuple) -> list[str | None]:
    """Take an instruction into the context; the points it deletes, [None] for a deletion without point, [] for none."""
    if r.numbers:
        c.clear()
        c.instruction = r
        return []
    held = c.above_point
    c.instruction, c.point, c.above_point = r, None, None
    c.inserted = _opt(r.new_article) if r.adds_article else None
    art = _opt(r.art) or (c.inserted[:-1] if c.inserted else None)
    if art:
        if art != c.article:
            c.paragraph = None
        c.article, c.annex, c.annex_point = art, None, None
    elif r.names_annex:
        c.article = c.paragraph = None
        c.annex, c.annex_point = _opt(r.ann), _opt(r.ann_pt)
    if _opt(r.par):
        c.paragraph = r.par
    elif c.above_paragraph and r.relative:
        c.paragraph = c.above_paragraph
    gone: list[str | None] = []
    if r.deletes:
        gone = list(r.pts) or [c.point]
    if _opt(r.pt):
        c.point = r.pt
    elif r.adds_point and held and held not in C.SMALL_ROMANS and len(held) >= 2:
        c.point = held
    return gone


def fold(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Items of one amending article, whose lines come in their order."""
    c = Context()
    for r in rows:
        head = (r.doc_id, r.article_number, r.article_heading, r.pos)
        if r.instructs:
            gone = _instruct(c, r)
            for n, pt in enumerate(gone):
                yield (*head, n, r.line, "deletion", c.article, c.paragraph, pt, c.annex, c.annex_point, c.inserted, r.line)
            if r.deletes and not r.numbers:
                c.paragraph = None
            continue
        own = c.instruction
        replaces = own is not None and own.replaces
        if _opt(r.lone):
            c.above_point = r.lone
            if not replaces:
                c.point = r.lone
            continue
        if not r.payload:
            continue
        p_marker, pt_marker = _opt(r.p_marker), _opt(r.pt_marker)
        if not p_marker and not pt_marker and own is not None and own.inserts_article and not r.in_table:
            c.point = None
        if p_marker:
            c.above_paragraph, c.above_point, c.point = p_marker, None, None
        elif pt_marker:
            c.above_point = pt_marker
        paragraph = c.paragraph or (None if p_marker or c.annex else c.above_paragraph)
        point = (_opt(own.pt) or c.point) if replaces else c.point
        if point is None and not pt_marker and not c.annex and not (own is not None and own.adds_article):
            point = c.above_point
        annex_point = (_opt(own.ann_pt) or c.annex_point) if c.annex and replaces else c.annex_point
        yield (*head, 0, r.payload, None, c.article, paragraph, point, c.annex, annex_point, c.inserted, own.line if own is not None else None)


SENT = 4096  # items that are sent on together


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of many articles, one article behind the other, to their items."""
    schema = pa.schema([(name, pa.int32() if kind == "int" else pa.string()) for name, kind in (x.split() for x in ITEMS.split(", "))])
    batch = lambda out: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [()] * len(schema), schema, strict=True)], schema=schema)

    def rows() -> Iterator[tuple]:
        for b in batches:
            line = namedtuple("Line", b.schema.names)
            yield from map(line, *(c.to_pylist() for c in b.columns))

    out: list[tuple] = []
    for _, own in groupby(rows(), lambda r: (r.doc_id, r.article_number)):
        for got in fold(own):
            out.append(got)
            if len(out) >= SENT:
                yield batch(out)
                out = []
    yield batch(out)


def items(lines: DataFrame) -> DataFrame:
    """Items with item_idx in document order; lines of different articles fold in parallel.

    Lines are sorted by article and folded as they come: most articles are a few lines, for which a group each costs more
    than the work on it.
    """
    from pyspark.sql import Window

    unit = ("doc_id", "article_number")
    got = described(lines).repartition(4 * partitions(lines.sparkSession), *unit).sortWithinPartitions(*unit, "pos").mapInArrow(_folded, ITEMS)
    kind = F.coalesce("amendment_kind", C.amendment_kind(F.col("source_instruction"), F.col("text")))
    idx = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos", "nth")) - 1
    return got.withColumn("amendment_kind", kind).withColumn("item_idx", idx).drop("pos", "nth")

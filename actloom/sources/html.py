"""HTML pages as rows of elements in nested-set order, so that every tree test is a range test.

``elements``: doc_id, pos, end_pos, depth, parent_pos, tag, id, classes, text, text_fn, structural_id, table_depth, attrs.
Element a holds b if a.doc_id = b.doc_id and a.pos < b.pos <= a.end_pos.  One scan, Arrow batches, no shuffle.
The frames of a page (html, head, the outer legal container) have no text of their own and no operator asks for the text of
all that stands in them, so theirs is null, and the body has only its plain text: a page is not stored several times over.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.functions.text import hard_spaces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "noscript"))
#: what an opening tag closes first, up to the nearest of the second set
CLOSES = {
    "p": ({"p"}, {"div", "td", "th", "li", "body", "table"}),
    "li": ({"li", "p"}, {"ul", "ol"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
}
BLOCKS_END_P = frozenset("div table ul ol h1 h2 h3 h4 h5 h6 section article header footer blockquote pre form hr".split())
STRUCTURAL = re.compile(r"^(?:cit_\d+|rct_\d+|cpt_[A-Za-z0-9]+|art_[A-Za-z0-9]+|anx_[A-Za-z0-9]+)$")
SCHEMA = (
    "doc_id string, pos int, end_pos int, depth int, parent_pos int, tag string, id string, classes array<string>, "
    "text string, text_fn string, structural_id string, table_depth int, attrs map<string,string>"
)
ENCODINGS = ("utf-8", "utf-8-sig", "cp1252", "latin-1")


def decode(data: bytes | None) -> str:
    """The first encoding of the cascade that fits."""
    for e in ENCODINGS:
        try:
            return (data or b"").decode(e)
        except UnicodeDecodeError:
            continue
    return (data or b"").decode("utf-8", "replace")


class _Builder(HTMLParser):
    """Element rows and the text pieces between them, with the usual repairs of an untidy page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.pieces: list[tuple[int, str]] = []  # (pos of the element it stands in, text)
        self.hidden = 0

    def _close(self, row: int) -> None:
        while self.open:
            top = self.open.pop()
            self.rows[top]["end"] = len(self.rows) - 1
            self.rows[top]["stop"] = len(self.pieces)
            if top == row:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends, bound = CLOSES.get(tag, ({"p"}, {"td", "th", "li", "body", "div"}) if tag in BLOCKS_END_P else (set(), set()))
        for i in range(len(self.open) - 1, -1, -1):
            name = self.rows[self.open[i]]["tag"]
            if name in ends:
                outer = [j for j in self.open[: i + 1] if self.rows[j]["tag"] in ends]
                inner = [j for j in outer if not any(self.rows[k]["tag"] in bound for k in self.open[self.open.index(j) + 1 : i + 1])]
                self._close(inner[0])
                break
            if name in bound:
                break
        got = {k: v or "" for k, v in attrs}
        self.rows.append({"tag": tag, "attrs": got, "parent": self.open[-1] if self.open else -1, "depth": len(self.open), "end": len(self.rows), "start": len(self.pieces), "stop": len(self.pieces)})
        if tag in VOID:
            return
        self.open.append(len(self.rows) - 1)
        if tag in HIDDEN:
            self.hidden += 1

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[i]]["tag"] == tag:
                self._close(self.open[i])
                if tag in HIDDEN:
                    self.hidden = max(0, self.hidden - 1)
                return

    def handle_data(self, data: str) -> None:
        if self.hidden == 0 and data.strip():
            self.pieces.append((self.open[-1] if self.open else -1, data.strip()))

    def finish(self) -> list[dict]:
        self.close()
        if self.open:
            self._close(self.open[0])
        return self.rows


_NUMBER = re.compile(r"\d+")


def elements_of(page: str) -> list[tuple]:
    """Rows (pos, end_pos, depth, parent_pos, tag, id, classes, text, text_fn, structural_id, table_depth, attrs) of one page."""
    b = _Builder()
    b.feed(page or "")
    rows = b.finish()
    classes = [r["attrs"].get("class", "").split() for r in rows]
    parent = [r["parent"] for r in rows]
    note, ref, struct, tables, boxed = ([None] * len(rows) for _ in range(5))
    for i, r in enumerate(rows):
        up = parent[i]
        boxed[i] = (boxed[up] if up >= 0 else False) or "eli-container" in classes[i]
        note[i] = (note[up] if up >= 0 else False) or "oj-note" in classes[i]
        ref[i] = i if r["tag"] == "sup" or "oj-super" in classes[i] else (ref[up] if up >= 0 else None)
        own = r["attrs"].get("id", "")
        here = bool(STRUCTURAL.match(own))
        struct[i] = own if here else (struct[up] if up >= 0 else None)
        tables[i] = (0 if here else (tables[up] if up >= 0 else 0)) + (r["tag"] == "table")
    out = []
    for i, r in enumerate(rows):
        frame = r["tag"] in ("html", "head") or (boxed[i] and not (parent[i] >= 0 and boxed[parent[i]]))
        stretch = [] if frame else b.pieces[r["start"] : r["stop"]]
        text = None if frame else " ".join(t for _, t in stretch)
        parts, last = [], None
        for at, t in stretch if r["tag"] != "body" else ():
            if at >= 0 and note[at] and not note[i]:
                continue
            mark = ref[at] if at >= 0 else None
            if mark is not None and mark > i:
                n = _NUMBER.search(t)
                if mark != last and n:
                    parts.append(f"[[FN:{n[0]}]]")
                    last = mark
                continue
            parts.append(t)
        above = tables[parent[i]] if parent[i] >= 0 and not STRUCTURAL.match(r["attrs"].get("id", "")) else 0
        out.append((i, r["end"], r["depth"], parent[i], r["tag"], r["attrs"].get("id"), classes[i], text, None if text is None or r["tag"] == "body" else " ".join(parts), struct[i], above, list(r["attrs"].items())))
    return out


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.string(), *[pa.int32()] * 4, pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int32(), pa.map_(pa.string(), pa.string()))
    names = [x.split()[0] for x in SCHEMA.replace("map<string,string>", "map").split(", ")]
    for b in batches:
        for doc, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            rows = [(doc, *r) for r in elements_of(page)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def elements(pages: DataFrame) -> DataFrame:
    """Element rows of ``pages`` (doc_id, html)."""
    got = pages.selectExpr("cast(doc_id as string) doc_id", "cast(html as string) html").mapInArrow(_flatten, SCHEMA)
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace("text_fn", r"\s+(\[\[FN:)", "$1"), r"(?U)\s+", " "), r" ([,.;:])", "$1")
    return got.withColumn("text_fn", hard_spaces(F.trim(tidy)))


def _decoded(errors: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(x or b"").decode("utf-8", "replace") if errors == "replace" else decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "html"])

    return run


def decoded(files: DataFrame, errors: str = "cascade") -> DataFrame:
    """(doc_id, html) of ``files`` (doc_id, content): by the cascade of encodings, or as UTF-8 with signs for what does not fit (``replace``)."""
    return files.select(F.col("doc_id").cast("string"), "content").mapInArrow(_decoded(errors), "doc_id string, html string")


def read_pages(spark: SparkSession, path: str, errors: str = "cascade") -> DataFrame:
    """(doc_id, html) of HTML files; doc_id is the file's path."""
    return decoded(spark.read.format("binaryFile").load(path).select(F.col("path").alias("doc_id"), "content"), errors)


def page_text(html: Column) -> Column:
    """Visible text of a well-formed page without building elements: hidden parts, comments and tags off, spaces collapsed."""
    t = F.regexp_replace(html, r"(?is)<(script|style|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))

"""Word documents as rows: text parts, paragraphs with their runs, and a plain writer.  Standard library only."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
SKIPPED = frozenset(f"word/{n}.xml" for n in ("styles", "settings", "fontTable", "numbering"))
RUN = pa.struct([("text", pa.string()), ("kind", pa.string()), ("strike", pa.bool_()), ("double_underline", pa.bool_()), ("color", pa.string())])
PARAGRAPHS = "doc_id string, ord int, text string, runs array<struct<text:string,kind:string,strike:boolean,double_underline:boolean,color:string>>"


def text_of(data: bytes) -> str:
    """All text of a document's parts, pieces joined by a space (words may be cut where runs are); unreadable parts are skipped."""
    out: list[str] = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name in z.namelist():
            if name.startswith("word/") and name.endswith(".xml") and "/_rels/" not in name and name not in SKIPPED:
                try:
                    root = ET.fromstring(z.read(name))
                except ET.ParseError:
                    continue
                out += [t.text for t in root.iter(f"{W}t") if t.text]
    return " ".join(" ".join(out).split())


def _on(props: ET.Element | None, tag: str) -> bool:
    e = props.find(W + tag) if props is not None else None
    return e is not None and e.get(f"{W}val", "true") not in ("false", "0", "none")


def _runs(p: ET.Element) -> list[dict]:
    out = []
    for r in p.iter(f"{W}r"):
        props = r.find(f"{W}rPr")
        text = "".join((e.text or "") if e.tag == f"{W}t" else "\t" if e.tag == f"{W}tab" else "\n" if e.tag == f"{W}br" else f"[[FN:{e.get(f'{W}id')}]]" if e.tag == f"{W}footnoteReference" else "" for e in r)
        under, color = (props.find(W + t) if props is not None else None for t in ("u", "color"))
        strike, double = _on(props, "strike"), under is not None and under.get(f"{W}val") == "double"
        out.append({"text": text, "kind": "delete" if strike else "insert" if double else "equal", "strike": strike, "double_underline": double, "color": color.get(f"{W}val") if color is not None else None})
    return out


def paragraphs_of(data: bytes) -> list[list[dict]]:
    """Runs of every paragraph: those of the body first, then those in table cells, each cell once."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{W}body")
    if body is None:
        return []
    out = [_runs(p) for p in body.findall(f"{W}p")]
    for table in body.findall(f"{W}tbl"):
        out += [_runs(p) for p in table.iter(f"{W}p")]
    return out


#: signs that XML cannot hold
_UNFIT = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ud800-\udfff\ufffe\uffff]")


_NOTE = re.compile(r"\[\[FN:(\d+)\]\]")
_TYPES = "application/vnd.openxmlformats-officedocument.wordprocessingml."
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships/"
_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'
#: twentieths of a point in a centimetre
CM = 567


def _text(t: str) -> str:
    return "<w:tab/>".join(f'<w:t xml:space="preserve">{escape(x)}</w:t>' for x in _UNFIT.sub("", t).split("\t"))


def _run(r: dict, ids: dict[str, int]) -> str:
    """A run with its marks; footnote tokens with a body become references."""
    marks = "".join(f"<w:{m}/>" for m, k in (("b", "bold"), ("i", "italic"), ("strike", "strike")) if r.get(k)) + (f'<w:color w:val="{r["color"]}"/>' if r.get("color") else "") + ('<w:u w:val="double"/>' if r.get("double_underline") else "")
    props = f"<w:rPr>{marks}</w:rPr>" if marks else ""
    out = []
    for i, piece in enumerate(_NOTE.split(r.get("text") or "")):
        if i % 2 and piece in ids:
            out.append(f'<w:r><w:rPr><w:vertAlign w:val="superscript"/></w:rPr><w:footnoteReference w:id="{ids[piece]}"/></w:r>')
        elif i % 2 or piece or not r.get("text"):
            out.append(f"<w:r>{props}{_text(f'[[FN:{piece}]]' if i % 2 else piece)}</w:r>")
    return "".join(out)


def _paragraph(p: list[dict] | dict, ids: dict[str, int]) -> str:
    """A paragraph of runs, with its indents and alignment if they are given."""
    runs, layout = (p, {}) if isinstance(p, list) else (p["runs"], p)
    left, first = layout.get("left_cm"), layout.get("first_line_cm")
    ind = ""
    if left is not None or first is not None:
        turn = f' w:hanging="{round(-first * CM)}"' if first and first < 0 else f' w:firstLine="{round((first or 0) * CM)}"'
        ind = f'<w:ind w:left="{round((left or 0) * CM)}"{turn}/>'
    props = ind + (f'<w:jc w:val="{layout["align"]}"/>' if layout.get("align") else "")
    return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{''.join(_run(r, ids) for r in runs)}</w:p>"


def _table(rows: list[list[list[dict]]], ids: dict[str, int]) -> str:
    """A table of cells of runs: lines above, below and under the first row."""
    line = lambda edge: f'<w:{edge} w:val="single" w:sz="8"/>'
    cell = lambda c, first: f"<w:tc><w:tcPr>{f'<w:tcBorders>{line("bottom")}</w:tcBorders>' if first else ''}</w:tcPr>{_paragraph(c, ids)}</w:tc>"
    inner = "".join(f"<w:tr>{''.join(cell(c, n == 0) for c in r)}</w:tr>" for n, r in enumerate(rows))
    return f'<w:tbl><w:tblPr><w:jc w:val="center"/><w:tblBorders>{line("top")}{line("bottom")}</w:tblBorders></w:tblPr>{inner}</w:tbl>'


def write(blocks: list, footnotes: dict[str, str] | None = None) -> bytes:
    """A document of paragraphs (runs, or runs with layout) and tables ({"rows": cells of runs}).

    ``footnotes``: bodies by the number that tokens in the text name; ids go by first appearance, bodies that nothing refers
    to come behind, a token without a body stays text.
    """
    bodies = footnotes or {}
    held = [p["rows"] if isinstance(p, dict) and "rows" in p else [[p if isinstance(p, list) else p["runs"]]] for p in blocks]
    seen = [n for rows in held for r in rows for c in r for run in c for n in _NOTE.findall(run.get("text") or "") if n in bodies]
    ids = {n: i for i, n in enumerate(dict.fromkeys([*seen, *sorted(bodies, key=lambda n: (int(n), n))]), 1)}
    lines = [_table(p["rows"], ids) if isinstance(p, dict) and "rows" in p else _paragraph(p, ids) for p in blocks]
    notes = "".join(f'<w:footnote w:id="{i}"><w:p><w:r><w:rPr><w:vertAlign w:val="superscript"/></w:rPr><w:footnoteRef/></w:r><w:r>{_text(" " + (bodies[n] or f"[Missing footnote text {n}]"))}</w:r></w:p></w:footnote>' for n, i in ids.items())
    space = f'xmlns:w="{W[1:-1]}"'
    part = lambda name, kind: f'<Override PartName="/word/{name}.xml" ContentType="{_TYPES}{kind}+xml"/>'
    files = {
        "[Content_Types].xml": f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{part("document", "document.main")}{part("footnotes", "footnotes") if ids else ""}</Types>',
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{_REL}officeDocument" Target="word/document.xml"/></Relationships>',
        "word/document.xml": f"<w:document {space}><w:body>{''.join(lines)}</w:body></w:document>",
    }
    if ids:
        files["word/_rels/document.xml.rels"] = f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{_REL}footnotes" Target="footnotes.xml"/></Relationships>'
        ruled = "".join(f'<w:footnote w:type="{k}" w:id="{i}"><w:p><w:r><w:{k}/></w:r></w:p></w:footnote>' for i, k in ((-1, "separator"), (0, "continuationSeparator")))
        files["word/footnotes.xml"] = f"<w:footnotes {space}>{ruled}{notes}</w:footnotes>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, _HEAD + text)
    return out.getvalue()


def footnotes_of(data: bytes) -> list[tuple[int, str]]:
    """Ids and bodies of a document's footnotes."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        if "word/footnotes.xml" not in z.namelist():
            return []
        root = ET.fromstring(z.read("word/footnotes.xml"))
    notes = [n for n in root.iter(f"{W}footnote") if n.get(f"{W}type") is None]
    return [(int(n.get(f"{W}id")), "".join(r["text"] for p in n.iter(f"{W}p") for r in _runs(p)).strip()) for n in notes]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for doc, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ps = paragraphs_of(data)
            yield pa.RecordBatch.from_arrays([pa.array([doc] * len(ps), pa.string()), pa.array(range(len(ps)), pa.int32()), pa.array(["".join(r["text"] for r in rs) for rs in ps], pa.string()), pa.array(ps, pa.list_(RUN))], names=["doc_id", "ord", "text", "runs"])


def read_paragraphs(files: DataFrame) -> DataFrame:
    """(doc_id, ord, text, runs) of ``files`` (doc_id, content)."""
    return files.select(F.col("doc_id").cast("string"), "content").mapInArrow(_scan, PARAGRAPHS)


def _notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(doc, *n) for doc, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for n in footnotes_of(data)]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string()), strict=True)], names=["doc_id", "id", "body"])


def read_footnotes(files: DataFrame) -> DataFrame:
    """(doc_id, id, body) of ``files`` (doc_id, content)."""
    return files.select(F.col("doc_id").cast("string"), "content").mapInArrow(_notes, "doc_id string, id int, body string")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([text_of(x) for x in b.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])


def read_text(files: DataFrame) -> DataFrame:
    """(doc_id, text) of ``files`` (doc_id, content)."""
    return files.select(F.col("doc_id").cast("string"), "content").mapInArrow(_texts, "doc_id string, text string")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        files = [write(ps, {n["number"]: n["body"] for n in notes or ()}) for ps, notes in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(files, pa.binary())], names=["doc_id", "content"])


def to_files(paragraphs: DataFrame, footnotes: DataFrame | None = None) -> DataFrame:
    """(doc_id, content): one document for each doc_id of ``paragraphs`` (doc_id, ord, runs, and optionally left_cm and first_line_cm), with ``footnotes`` (doc_id, number, body)."""
    layout = [F.col(c).cast("double").alias(c) if c in paragraphs.columns else F.lit(None).cast("double").alias(c) for c in ("left_cm", "first_line_cm")]
    docs = paragraphs.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct("ord", "runs", *layout))).alias("ps"))
    note = F.struct(F.col("number").cast("string").alias("number"), "body") if footnotes is not None else None
    if footnotes is None:
        docs = docs.withColumn("notes", F.lit(None).cast("array<struct<number:string,body:string>>"))
    else:
        docs = docs.join(footnotes.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.sort_array(F.collect_list(note)).alias("notes")), "doc_id", "left")
    return docs.select("doc_id", "ps", "notes").mapInArrow(_pack, "doc_id string, content binary")


def binary_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("doc_id"), "content")

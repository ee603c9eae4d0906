"""Revision runs between a base text and its amendment, and the alignment of annex lines."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import text as X

RUN = "struct<text:string,kind:string,strike:boolean,double_underline:boolean,color:string>"
RUNS = f"array<{RUN}>"
#: below this word similarity a text is replaced whole; share of common keys below which annex lines are replaced whole (fixed values)
DIVERGED, ANNEX_OVERLAP = 0.34, 0.4
PIECE = re.compile(r"\[\[FN:\d+\]\]|\[\[SRC:[^\]]+\]\]|\([A-Za-z0-9]+\)|[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)?|\s+|[^\w\s]|\w")
WORD = re.compile(r"[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)?")
_PREFIX = re.compile(r"(\([A-Za-z0-9]+\)|\d+[A-Za-z]?\.|[IVXLCDM]+\.)(\s+)")
_GLUE = re.compile(r"[\s,;:.()\[\]{}'\"“”‘’/\\-]*|\s*(?:and|or)\s+", re.IGNORECASE)
_QUOTES = str.maketrans("", "", "'\"“”‘’`´ \t\n ")
_FIRST = re.compile(r"\s*([A-Za-z0-9]+)\b\s*")


def _words(s: str) -> list[str]:
    return [w.lower() for w in WORD.findall(s)]


def segments(base: str, amend: str) -> list[tuple[str, str]]:
    """(kind, text) with kind equal, delete or insert: markers stay, far texts change whole, glue joins changes around it."""
    out: list[tuple[str, str]] = []
    a, b = _PREFIX.match(base), _PREFIX.match(amend)
    if a and b and a[1].lower() == b[1].lower():
        out.append(("equal", b[1] + b[2]))
        base, amend = base[a.end() :], amend[b.end() :]
    x, y = _words(base), _words(amend)
    if x and y and SequenceMatcher(None, x, y).ratio() < DIVERGED:
        return out + [(k, t) for k, t in (("delete", base), ("insert", amend)) if t]
    x, y = PIECE.findall(base), PIECE.findall(amend)
    fold = lambda ts: [t.lower() if WORD.fullmatch(t) else t for t in ts]
    blocks: list[list] = []  # [changed, base text, amend text]
    ops = SequenceMatcher(None, fold(x), fold(y)).get_opcodes()
    for n, (tag, i, j, k, m) in enumerate(ops):
        old, new = "".join(x[i:j]), "".join(y[k:m])
        inner = tag == "equal" and 0 < n < len(ops) - 1 and _GLUE.fullmatch(new)
        changed = tag != "equal" or bool(inner)
        if changed and blocks and blocks[-1][0]:
            blocks[-1][1] += old
            blocks[-1][2] += new
        else:
            blocks.append([changed, old, new])
    for changed, old, new in blocks:
        if not changed:
            out.append(("equal", new))
            continue
        if old and new:
            if old.translate(_QUOTES) == new.translate(_QUOTES):
                out.append(("equal", old))
                continue
            p, q = _FIRST.match(old), _FIRST.match(new)
            if p and q and p[1].lower() == q[1].lower() and new[q.end() :].strip() and not old[p.end() :].strip():
                out.append(("equal", new[: q.end()]))
                old, new = "", new[q.end() :]
        out += [(k, t) for k, t in (("delete", old), ("insert", new)) if t]
    return out


def revision(base: str | None, amend: str | None, color: str, prior: set[str] = frozenset()) -> list[dict]:
    """Runs of the revised paragraph; a struck run keeps its double underline where an earlier layer had inserted one of its words."""
    runs = []
    for kind, text in segments(base or "", amend or ""):
        again = kind == "delete" and any(w in prior for w in _words(text))
        runs.append({"text": text, "kind": kind, "strike": kind == "delete", "double_underline": kind == "insert" or again, "color": None if kind == "equal" else color})
    return runs


def revision_runs(color: str):  # noqa: ANN201
    """Column function (base, amendment) -> runs, Arrow-batched."""

    @F.pandas_udf(RUNS)
    def make(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([revision(x, y, color) for x, y in zip(a, b, strict=True)])

    return make


def alignment_key(line: Column) -> Column:
    """(kind, value) of an annex line: heading, roman, numeric or letter heading, point, body or empty."""
    t = X.without_anchors(line)
    roman, number = C.found(t, r"(?i)^([IVXLC]+)\.(?=\s|$)"), C.found(t, r"(?i)^(\d+[A-Za-z]?)[.)](?=\s|$)")
    alpha, point = C.found(t, r"^([A-Z])\.(?=\s|$)"), C.found(t, r"(?i)^\(([a-z]+)\)(?=\s|$)")
    body = F.lower(F.trim(F.regexp_replace(t, "[^A-Za-z0-9]+", " ")))
    pair = lambda k, v: F.struct(F.lit(k).alias("kind"), v.alias("value"))
    return (
        F.when(t == "", pair("empty", F.lit("")))
        .when(C.annex_label(t).isNotNull(), pair("annex_heading", C.annex_label(t)))
        .when(roman.isNotNull(), pair("roman_heading", F.upper(roman)))
        .when(number.isNotNull(), pair("numeric_heading", F.lower(number)))
        .when(alpha.isNotNull(), pair("alpha_heading", alpha))
        .when(point.isNotNull(), pair("point", F.lower(point)))
        .otherwise(pair("body", body))
    )


def contextual_keys(lines: DataFrame) -> DataFrame:
    """``lines`` (doc_id, ord, text) with kind and value, scoped to the last roman heading and the last numeric one behind it."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = lines.withColumn("_k", alignment_key(F.col("text"))).withColumns({"kind": F.col("_k.kind"), "_v": F.col("_k.value")}).drop("_k")
    rows = rows.withColumn("_r", F.last(F.when(F.col("kind") == "roman_heading", F.col("_v")), ignorenulls=True).over(w))
    rows = rows.withColumn("_isle", F.sum((F.col("kind") == "roman_heading").cast("int")).over(w))
    rows = rows.withColumn("_n", F.last(F.when(F.col("kind") == "numeric_heading", F.col("_v")), ignorenulls=True).over(Window.partitionBy("doc_id", "_isle").orderBy("ord")))
    value = F.when(F.col("kind") == "numeric_heading", F.concat_ws(">", "_r", "_v")).when(F.col("kind").isin("alpha_heading", "point", "body"), F.concat_ws(">", "_r", "_n", "_v")).otherwise(F.col("_v"))
    return rows.withColumn("value", value).drop("_v", "_r", "_n", "_isle")


ALIGNED = "doc_id string, ord int, action string, anchor bigint, old string, new string"
#: lines ahead in which two versions of an annex may meet again (a fixed value)
SYNC = 10


def forward_sync(old: list, new: list, i: int, j: int, window: int = SYNC) -> tuple[int | None, int | None]:
    """Where the key of new line j next stands among the old lines behind i, and that of old line i among the new ones behind j."""
    ahead = lambda keys, key, at: next((n for n in range(at + 1, min(len(keys), at + window)) if keys[n] == key), None)
    return ahead(old, new[j], i), ahead(new, old[i], j)


def actions(old: list[tuple], new: list[tuple]) -> list[tuple]:
    """(action, anchor, old, new) for the lines of one annex (ord, text, kind, value), both sides in order; see :func:`align`."""
    a, b, at = [r[1] for r in old], [r[1] for r in new], [int(r[0]) for r in old] + [None]
    x, y = ([tuple(r[2:]) for r in rows] for rows in (old, new))
    out: list[tuple] = []
    gone = lambda s, e: [("delete", at[n], a[n], None) for n in range(s, e) if a[n].split()]
    come = lambda s, e, n: [("insert", at[n], None, b[m]) for m in range(s, e)]
    for tag, i, j, k, m in SequenceMatcher(None, x, y).get_opcodes():
        if tag == "equal":
            out += [("equal" if a[p].split() == b[q].split() else "revise", at[p], a[p], b[q]) for p, q in zip(range(i, j), range(k, m), strict=True)]
        elif tag != "replace" or len(set(x[i:j]) & set(y[k:m])) < ANNEX_OVERLAP * min(j - i, m - k):
            out += gone(i, j) + come(k, m, i)
        else:
            n = min(j - i, m - k)
            for p, q in zip(range(i, i + n), range(k, k + n), strict=True):
                out += [("revise", at[p], a[p], b[q])] if x[p] == y[q] else gone(p, p + 1) + come(q, q + 1, p)
            out += gone(i + n, j) + come(k + n, m, j)
    return out


def align(pdf_old: pd.DataFrame, pdf_new: pd.DataFrame) -> pd.DataFrame:
    """Line actions of one annex (equal, revise, delete, insert) from lines with keys, in order of the result; ``anchor`` is
    the ord of the old line that is meant or, for an insertion, before which the new one goes (null: at the end)."""
    doc = (pdf_old if len(pdf_old) else pdf_new)["doc_id"].iloc[0]
    old, new = (list(zip(*(d[c] for c in ("ord", "text", "kind", "value")), strict=True)) for d in (pdf_old.sort_values("ord"), pdf_new.sort_values("ord")))
    return pd.DataFrame([(doc, n, *r) for n, r in enumerate(actions(old, new))], columns=["doc_id", "ord", "action", "anchor", "old", "new"]).astype({"anchor": "Int64"})


def align_annexes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Line actions of every annex: a grouped fold per annex over the keys of both sides."""
    left, right = (contextual_keys(d.select("doc_id", "ord", "text")) for d in (old, new))
    return left.groupBy("doc_id").cogroup(right.groupBy("doc_id")).applyInPandas(align, ALIGNED)


def highlighted(color: str):  # noqa: ANN201
    """Column function (base, amendment) -> runs (text, changed, color) of the amendment's words, changed ones marked."""

    @F.pandas_udf("array<struct<text:string,changed:boolean,color:string>>")
    def make(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(a, b, strict=True):
            x, y = _words(p or ""), _words(q or "")
            parts = [(tag in ("insert", "replace"), " ".join(y[k:m])) for tag, _, _, k, m in SequenceMatcher(None, x, y).get_opcodes() if m > k]
            out.append([{"text": t, "changed": c, "color": color if c else None} for c, t in parts])
        return pd.Series(out)

    return make

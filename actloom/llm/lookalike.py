"""One consistent form for text that looks the same.

Method: a batch of texts is exploded into positioned code points (two flat columns: point and row), joined to the
broadcast decomposition and look-alike mappings, its combining marks are ordered by class, pairs are recomposed and
the strings rebuilt.  The mappings are bounded by Unicode itself; nothing is shuffled.

Equal forms: width, composed and decomposed accents, invisible characters, whitespace, hyphens, ligatures, one-character
numerals, letters of another script drawn the same.  Kept apart: case, accents, visible punctuation, raised digits,
dashes, the numero sign.

Defined cases: null stays null; a text of invisible characters and whitespace becomes ''; any length is worked on whole.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actloom.llm import codes
from actloom.runtime import written

#: letters of other scripts and the Latin letters drawn the same, position by position
DRAWN_LIKE = {
    "greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοϲϳͿϹ", "ABEZHIKMNOPTYXvocjJC"),
    "cyrillic": ("АВЕЅІЈКМНОРСТУХҮԚԜӀаеіјорсухѕһԁԛԝӏү", "ABESIJKMHOPCTYXYQWIaeijopcyxshdqwly"),
    "armenian": ("ՕՍՏօսոհզց", "OUSounhqg"),
    "coptic": ("ⲎⲒⲔⲘⲚⲞⲢⲤⲦⲬⲟⲣⲥ", "HIKMNOPCTXopc"),
    "cherokee": ("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏒᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHGZRWVSLCPKB"),
    "lisu": ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
}
#: a table of confusables to add, a path
CONFUSABLES = os.environ.get("ACTLOOM_CONFUSABLES")
HYPHENS = "‐‑﹣－"
#: ranges whose compatibility decomposition is drawn the same: digraphs, ligatures, one-character numerals
COMPAT = ((0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2160, 0x217F), (0x2474, 0x249B), (0xFB00, 0xFB06), (0xFB13, 0xFB17))
#: invisible although not of category Cf or Cc: the grapheme joiner, Hangul fillers, variation selectors
INVISIBLE = ((0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xE0100, 0xE01EF))
HANGUL = (0xAC00, 0xD7A3)


def read_confusables(path: str) -> dict[str, str]:
    """Letters of other scripts to Latin letters from a file in the form of Unicode's public table of confusables
    (``source ; target ; class # comment``, code points in hexadecimal).

    Only pairs of one letter and one Latin letter of the same case are taken (letters without case stand for capitals):
    the table also pairs what merely resembles each other, digits, sequences and marks, which must stay apart.
    """
    found: dict[str, str] = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            cells = [c.split() for c in line.split("#")[0].split(";")]
            if len(cells) < 2 or len(cells[0]) != 1 or len(cells[1]) != 1:
                continue
            a, b = (chr(int(c[0], 16)) for c in cells[:2])
            if a.isalpha() and b.isascii() and b.isalpha() and "LATIN" not in unicodedata.name(a, "LATIN"):
                if (a.islower() and b.islower()) or (not a.islower() and b.isupper()):
                    found[a] = b
    return found


@lru_cache(maxsize=4)
def mappings(table: str | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[tuple[int, int], int]]:
    """(start, length, flat targets, combining class, composition pairs) over all code points; look-alike letters are those
    of ``DRAWN_LIKE`` and of the table file, if one is named (``ACTLOOM_CONFUSABLES``, a parameter; read on the driver)."""
    like = {ord(a): ord(b) for left, right in DRAWN_LIKE.values() for a, b in zip(left, right, strict=True)}
    like = ({ord(a): ord(b) for a, b in read_confusables(table).items()} if table else {}) | like
    like |= {ord(c): ord("-") for c in HYPHENS} | {0xB5: 0x3BC}
    hidden = {i for a, b in INVISIBLE for i in range(a, b + 1)}
    compat = {i for a, b in COMPAT for i in range(a, b + 1)}
    length, start, flat = np.ones(codes.TOP, np.int32), np.zeros(codes.TOP, np.int32), list(range(codes.TOP))
    classes, pairs = np.zeros(codes.TOP, np.uint8), {}

    def target(i: int) -> list[int]:
        c = chr(i)
        if c.isspace() or c in "\u0085  ":
            return [32]
        if i in hidden or unicodedata.category(c) in ("Cf", "Cc"):
            return []
        if i in like:
            return [like[i]]
        d = unicodedata.decomposition(c)
        if not d or HANGUL[0] <= i <= HANGUL[1]:
            return [i]
        tag, *rest = d.split() if d[0] == "<" else ("", *d.split())
        if tag and tag not in ("<wide>", "<narrow>", "<noBreak>") and i not in compat:
            return [i]
        return [y for x in rest for y in target(int(x, 16))]

    for i in range(codes.TOP):
        c = chr(i)
        if unicodedata.combining(c):
            classes[i] = unicodedata.combining(c)
        start[i] = i
        if i < 0x21 or i > 0x7E:
            t = target(i)
            if t != [i]:
                start[i], length[i] = len(flat), len(t)
                flat += t
        d = unicodedata.decomposition(c)
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", c) == c:
            a, b = (int(x, 16) for x in d.split())
            pairs[a, b] = i
    return start, length, np.array(flat, np.uint32), classes, pairs


def _recompose(points: list[int], classes: np.ndarray, pairs: dict[tuple[int, int], int]) -> list[int]:
    """Canonical composition of points whose marks are in order."""
    out: list[int] = []
    at, last = -1, -1  # index of the last starter, class of the last mark kept behind it
    for p in points:
        k = int(classes[p])
        if at >= 0 and (last < k or last == -1):
            s = out[at]
            c = pairs.get((s, p))
            if c is None and last == -1:
                if 0x1100 <= s <= 0x1112 and 0x1161 <= p <= 0x1175:
                    c = HANGUL[0] + ((s - 0x1100) * 21 + p - 0x1161) * 28
                elif HANGUL[0] <= s <= HANGUL[1] and (s - HANGUL[0]) % 28 == 0 and 0x11A8 <= p <= 0x11C2:
                    c = s + p - 0x11A7
            if c is not None:
                out[at] = c
                continue
        out.append(p)
        if k == 0:
            at, last = len(out) - 1, -1
        else:
            last = k
    return out


def consistent(arr: pa.Array, maps: tuple | None = None) -> pa.Array:
    """The consistent form of every text of an Arrow array."""
    start, length, flat, classes, pairs = maps or mappings()
    arr = arr.cast(pa.string())
    out: list[pa.Array] = []
    for _, part in codes.slices(arr):
        cps, off = codes.points(part)
        n = len(part)
        # only rows that hold something to change go on
        odd = (start[cps] != cps) | (classes[cps] > 0) | ((cps >= 0x1100) & (cps <= 0x11FF))
        space = cps == 32
        if len(space):
            odd[1:] |= space[1:] & space[:-1]
            full = off[1:] > off[:-1]
            odd[off[:-1][full]] |= space[off[:-1][full]]
            odd[off[1:][full] - 1] |= space[off[1:][full] - 1]
        rows = np.unique(np.searchsorted(off, np.flatnonzero(odd), side="right") - 1)
        if not len(rows):
            out.append(part)
            continue
        size = (off[1:] - off[:-1])[rows]
        take = np.repeat(off[:-1][rows] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        cp, row = cps[take], np.repeat(np.arange(len(rows)), size)
        # the join: each positioned point to its targets
        ln = length[cp]
        base = np.repeat(start[cp] - np.concatenate([[0], np.cumsum(ln)[:-1]]), ln)
        cp, row = flat[base + np.arange(ln.sum())], np.repeat(row, ln)
        # one space between words, none at the ends
        space = cp == 32
        keep = ~space
        first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else keep
        before = np.concatenate([[True], space[:-1]]) | first
        keep |= space & ~before
        cp, row = cp[keep], row[keep]
        if len(cp):
            last = np.concatenate([row[1:] != row[:-1], [True]])
            keep = ~(last & (cp == 32))
            cp, row = cp[keep], row[keep]
        marks = classes[cp] > 0
        if marks.any():
            k = classes[cp].astype(np.int64)
            new = ~marks
            if len(new):
                new[0] = True
                new[1:] |= row[1:] != row[:-1]
            order = np.lexsort((np.arange(len(cp)), k, np.cumsum(new)))
            cp = cp[order]
        edge = np.searchsorted(row, np.arange(len(rows) + 1))
        text = cp.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        done = [text[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        again = marks | ((cp >= 0x1100) & (cp <= 0x11FF))
        for r in np.unique(row[again]):
            done[r] = "".join(map(chr, _recompose(cp[edge[r] : edge[r + 1]].tolist(), classes, pairs)))
        index = np.arange(n)
        index[rows] = n + np.arange(len(rows))
        mixed = pa.concat_arrays([part, pa.array(done, pa.string())]).take(pa.array(index))
        out.append(mixed)
    got = pa.concat_arrays(out) if out else arr
    return pa.array(got.to_pylist(), pa.string()) if got.offset else got


def _broadcast(spark: SparkSession):
    """The mappings as a broadcast table; its size is fixed by Unicode (about 10 MB)."""
    return spark.sparkContext.broadcast(mappings(CONFUSABLES))


def consistent_text(df: DataFrame, column: str, output: str) -> DataFrame:
    """``df`` with the consistent form of ``column`` as ``output`` (replaced if it exists)."""
    maps = _broadcast(df.sparkSession)

    @F.pandas_udf("string")
    def form(s):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(consistent(pa.array(s, pa.string()), maps.value).to_pylist(), dtype=object)

    return df.withColumn(output, form(F.col(f"`{column}`").cast("string")))


def _keys(maps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(2).cast(pa.string())
            cols = [b.column(0), b.column(1), codes.digests(consistent(raw, maps.value)), codes.digests(raw)]
            yield pa.RecordBatch.from_arrays(cols, names=["tbl", "id", "k", "raw"])

    return run


def lookalike_sets(texts: DataFrame) -> DataFrame:
    """(tbl, first_id, other_id) for the look-alike sets of ``texts`` (tbl, id, text) that hold at least two spellings.

    Plan: one scan writes 128-bit digests of the consistent forms and the spellings; a partial aggregate keeps min id and
    min/max spelling of each set (a stock phrase shrinks to one row a task); only sets with two spellings join back, their
    digests written first, so that Spark sees their size.  AQE splits hot sets.
    Null and empty texts are left out; rows without id too.
    """
    rows = texts.selectExpr("cast(tbl as string) tbl", "cast(id as bigint) id", "cast(text as string) text").where("id is not null and text <> ''")
    keyed = written(rows.mapInArrow(_keys(_broadcast(texts.sparkSession)), "tbl string, id bigint, k binary, raw binary"), "lookalike")
    per = keyed.select("tbl", "id", "k", F.xxhash64("raw").alias("raw")).groupBy("tbl", "k").agg(F.min("id").alias("first_id"), F.min("raw").alias("lo"), F.max("raw").alias("hi"))
    sets = written(per.where("lo <> hi").select("tbl", "k", "first_id"), "lookalike-sets")
    return keyed.join(sets, ["tbl", "k"]).where("id <> first_id").select("tbl", "first_id", F.col("id").alias("other_id")).distinct()

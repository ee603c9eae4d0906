"""What an amending instruction points at."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actloom.functions.classify import found
from actloom.functions.text import clean

_ART = r"\bArticle\s+(\d+[A-Za-z]?)"
#: in order: an earlier pattern wins wherever it matches (fixed values)
ARTICLE = (r"\bin\s+Article\s+(\d+[A-Za-z]?)\b", rf"{_ART}\s*\(\d+[A-Za-z]?\)", rf"{_ART}\s*,\s*the following", rf"{_ART}\s+is\s+amended\b", rf"{_ART}\s+(?:is|are)\s+replaced\b", rf"{_ART}\s+(?:is|are)\s+inserted\b", rf"{_ART}\s+(?:is|are)\s+deleted\b")
#: ordinals of instructions (fixed values)
ORDINALS = ("first", "second", "third", "fourth", "fifth")
#: names of revision colours (fixed values)
COLORS = {"red": (192, 0, 0), "blue": (0, 102, 204), "green": (0, 128, 0), "orange": (230, 120, 0), "purple": (128, 0, 128), "teal": (0, 128, 128), "brown": (128, 64, 0), "black": (0, 0, 0)}


def _first(c: Column, *patterns: str) -> Column:
    return F.coalesce(*[found(clean(c), "(?i)" + p) for p in patterns])


def article(c: Column) -> Column:
    return _first(c, *ARTICLE)


def paragraph(c: Column) -> Column:
    return _first(c, r"\bparagraph\s+(\d+[A-Za-z]?)\b", r"\bArticle\s+\d+[A-Za-z]?\s*\((\d+[A-Za-z]?)\)")


def point(c: Column) -> Column:
    return F.lower(_first(c, r"\bpoint\s*\(([a-z]+)\)"))


def all_points(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(clean(c), F.lit(r"(?i)\(([a-z]+)\)"), F.lit(1)), F.lower))


def annex(c: Column) -> Column:
    return F.upper(_first(c, r"\bin\s+Annex\s+([IVXLC]+)\b"))


def annex_point(c: Column) -> Column:
    return F.lower(_first(c, r"\bpoint\s+([IVXLC]+)\b"))


def _ordinal(c: Column, thing: str) -> Column:
    word = F.lower(_first(c, rf"\b({'|'.join(ORDINALS)})\s+{thing}\b"))
    return F.nullif(F.array_position(F.array(*map(F.lit, ORDINALS)), word).cast("int"), F.lit(0))


def subparagraph_ordinal(c: Column) -> Column:
    return _ordinal(c, "subparagraph")


def inner_ordinal(c: Column) -> Column:
    return _ordinal(c, "(?:sub)?paragraph")


def inserted_annex(c: Column) -> Column:
    return F.upper(_first(c, r"\b(?:is|are)\s+inserted\s+as\s+annex\s+([A-Za-z0-9]+)\b"))


def inserted_article(c: Column) -> Column:
    """The marker of an inserted article that the instruction itself names, as 14a."""
    return F.lower(_first(c, r"\bthe following articles?\s+(?:is|are)\s+(?:inserted|added)\s*:\s*[‘'\"(\[]*\s*article\s+(\d+[A-Za-z])\b"))


def regulation(c: Column) -> Column:
    return _first(c, r"\b(\d{4}/\d{1,4})\b")


def operation_type(instruction: Column, kind: Column | None = None) -> Column:
    k = F.coalesce(kind, F.lit("")) if kind is not None else F.lit("")
    i = clean(instruction)
    return F.when((k == "replacement") | i.rlike(r"(?i)\breplaced\b"), "replace").when((k == "deletion") | i.rlike(r"(?i)\bdeleted\b"), "delete").when((k == "insertion") | i.rlike(r"(?i)\b(?:added|inserted)\b"), "insert").otherwise("unknown")


def target_path(article: Column, paragraph: Column, point: Column, annex: Column, annex_point: Column) -> Column:
    """Path of the target; a part that is missing is left out, nothing at all is ``unresolved``."""
    part = lambda name, c: F.when(F.coalesce(clean(c), F.lit("")) != "", F.concat(F.lit(f"{name}/"), clean(c)))
    by_annex = F.when(clean(annex) != "", F.concat_ws("/", part("annex", annex), part("point", annex_point)))
    by_article = F.when(clean(article) != "", F.concat_ws("/", part("article", article), part("paragraph", paragraph), part("point", point)))
    return F.coalesce(by_annex, by_article, F.lit("unresolved"))


def roman_value(c: Column) -> Column:
    """Value of a roman numeral of I V X L C, by the subtraction rule from the right; other signs count 0."""
    value = lambda x: F.when(x == "I", 1).when(x == "V", 5).when(x == "X", 10).when(x == "L", 50).when(x == "C", 100).otherwise(0)
    step = lambda a, x: F.struct(F.when(value(x) < a["prev"], a["sum"] - value(x)).otherwise(a["sum"] + value(x)).alias("sum"), F.greatest(value(x), a["prev"]).alias("prev"))
    return F.aggregate(F.reverse(F.split(F.upper(c), "")), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("prev")), step, lambda a: a["sum"])


def roman(n: Column) -> Column:
    """Roman numeral of 1..399."""
    digit = lambda q, one, five, ten: F.element_at(F.array(*map(F.lit, ("", one, one * 2, one * 3, one + five if five else "", five, five + one, five + one * 2, five + one * 3, one + ten))), q.cast("int") + 1)
    return F.concat(F.repeat(F.lit("C"), F.floor(n / 100).cast("int")), digit(F.floor(n / 10) % 10, "X", "L", "C"), digit(n % 10, "I", "V", "X"))


def next_roman(label: Column) -> Column:
    t = F.upper(clean(label))
    return F.when(t.rlike("^[IVXLC]+$") & (roman_value(t) > 0), roman(roman_value(t) + 1))


def color(c: Column, default: str | None = "orange") -> Column:
    """Six hex digits of a colour name or hex form; null gives the default; anything else is an error."""
    t = F.lower(F.trim(c))
    by_name = F.coalesce(*[F.when(t == n, "".join(f"{x:02X}" for x in rgb)) for n, rgb in COLORS.items()])
    hexed = F.when(t.rlike("^#?[0-9a-f]{6}$"), F.upper(F.right(t, F.lit(6))))
    rest = F.when(F.coalesce(c, F.lit("")) == "", F.lit("".join(f"{x:02X}" for x in COLORS[default])) if default else F.lit(None).cast("string")).otherwise(F.raise_error(F.concat(F.lit("Unsupported color format: "), c)).cast("string"))
    return F.coalesce(by_name, hexed, rest)

"""Text normalisers as column expressions; several differ on purpose, as the stages they serve do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: whitespace as Unicode has it, listed, which is faster than the property; all of it, and all but the plain space (fixed values)
WS = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD = WS.replace("\\r ", "\\r")
#: the same classes for searches through whole texts: one comparison passes over visible ASCII, most of every text (fixed values)
WS_FAR, ODD_FAR = f"[[^!-~]&&{WS}]", f"[[^ -~]&&{ODD}]"
QUOTE = "‘'\""
POINT = r"\((?:[a-z]+|[ivxlcdm]+)\)"


def _sub(c: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(by))


def _stripped(c: Column) -> Column:
    return _sub(_sub(c, f"^{WS_FAR}+"), f"{WS_FAR}{WS_FAR}*$")


def let(value: Column, body) -> Column:  # noqa: ANN001
    """``body(value)`` with the value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def once(value: Column) -> Column:
    """A costly value as a column of its own rows: filters on it are not pushed below it, where it would be computed again."""
    return F.explode(F.array(value))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def clean(c: Column) -> Column:
    """One space for every run of whitespace, none at the ends."""
    # only what is not a single plain space already is replaced
    return F.trim(_sub(_text(c), f"(?:{ODD_FAR}| (?={WS_FAR})){WS_FAR}*", " "))


def normalized(c: Column) -> Column:
    """:func:`clean`, lower case."""
    return F.lower(clean(c))


def clean_markup(c: Column) -> Column:
    """The parser's form: keeps line breaks, tightens punctuation, plain hyphens."""
    t = F.translate(_text(c), "\u00a0\u2011", " -")
    t = _sub(t, r"[\t\r\f\x0b ]{2,}|[\t\r\f\x0b]", " ")
    t = _sub(t, WS + r"+([,.;:])", "$1")
    t = _sub(t, r"\n{3,}", "\n\n")
    return _sub(t, f"^{WS}+|{WS}+$")


def slug(c: Column) -> Column:
    t = _sub(F.lower(clean_markup(c)), "[^a-z0-9]+", "_")
    t = F.trim(t, F.lit("_"))
    return F.when(t == "", "unknown").otherwise(t)


def truncated(c: Column, n: int = 120) -> Column:
    t = clean_markup(c)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n - 1), F.lit("…"))).otherwise(t)


def hard_spaces(c: Column) -> Column:
    """Non-breaking spaces in amounts: thousands, EUR, the euro sign, per cent."""
    t = _sub(_text(c), r"(?<=\d) (?=\d{3}\b)", "\u00a0")
    t = _sub(t, r"(?U)\b(EUR)\s+(?=\d)", "$1\u00a0")
    t = _sub(t, r"(?U)€\s+(?=\d)", "€\u00a0")
    return _sub(t, r"(?U)(?<=\d)\s+%", "\u00a0%")


def without_anchors(c: Column) -> Column:
    """Source anchors removed in their three written forms; texts that name none are only cleaned."""
    t = _sub(_text(c), r"(?iU)\s*\[\[SRC:[^\]]+\]\]")
    t = _sub(t, r"(?i)\bSRC:[A-Za-z0-9_.-]+\b")
    t = _sub(t, r"(?iU)\bsrc\s+art\s+\d+[A-Za-z]?(?:\s+\d+[A-Za-z]?)?\b")
    return clean(F.when(F.contains(F.lower(_text(c)), F.lit("src")), t).otherwise(c))


def without_roman(c: Column) -> Column:
    return _sub(clean(c), r"(?i)^\([ivxlcdm]+\) ")


def is_bare_marker(c: Column) -> Column:
    return clean(c).rlike(r"(?i)^(?:\([a-z]+\)|\d+[a-z]?\.)$")


def is_list_marker(c: Column) -> Column:
    return clean(c).rlike(rf"(?i)^{POINT}$")


def marker_tab(c: Column) -> Column:
    """A tab behind a leading marker, which may follow a quote."""
    t = _sub(F.translate(_text(c), "\u00a0", " "), r"(?U)^\s+|\s+$")
    q = "[‘'\"“”]?"
    for m in (r"\(\d+\)", r"\d+[A-Za-z]?\.", r"(?i:\([a-z]+\))"):
        t = _sub(t, rf"^({q}{m}){WS}+", "$1\t")
    return t


def marker_tab_lines(c: Column) -> Column:
    return F.array_join(F.transform(F.split(_text(c), "\n"), lambda x: F.when(clean(x) == "", "").otherwise(marker_tab(x))), "\n")


def marker_spacing(c: Column, annex: bool = False) -> Column:
    t = _text(c)
    if annex:
        t = _sub(t, r"(?iU)^([a-z]\.|[ivxlcdm]+\.)\s+", "$1\t")
    for m in (r"\d+\.", r"\([a-z]\)", r"(?i:\([ivxlcdm]+\))"):
        t = _sub(t, rf"^({m}){WS}+", "$1\t")
    return t


def annex_line(c: Column) -> Column:
    t = marker_spacing(clean(c), True)
    for m in (r"(?i:\([a-z]+\))", r"(?i:[ivxlcdm]+\.)", r"[A-Z]\.", r"\d+[A-Za-z]?\)", r"\d+[A-Za-z]?\."):
        t = _sub(t, rf"^({m}){WS}+", "$1\t")
    return t


def without_marker_quote(c: Column) -> Column:
    return _sub(clean(c), rf"^[{QUOTE}](?=\d+[A-Za-z]?\.|\([a-z]+\))")


def unquoted(c: Column) -> Column:
    """Outer quotes off, a doubled final stop made one."""
    t = _stripped(_text(c))
    t = _sub(t, rf"^[{QUOTE}]+")
    t = _sub(t, rf"""[’"']{WS}*;?$""")
    t = _sub(t, r"""[’"']\.$""", ".")
    t = _sub(t, rf"""[’"']+{WS}*;{WS}*$""")
    t = _sub(t, r"\.(?<!\.\.)\.(?!\.)$", ".")
    return _stripped(t)


def unquoted_payload(c: Column) -> Column:
    return _sub(clean(_sub(unquoted(c), r"\[\[FN:\d+\]\]")), r" +([,.;:])", "$1")


def without_footnotes(c: Column) -> Column:
    return _sub(_text(c), r"\[\[FN:\d+\]\]", " ")


def footnote_body(c: Column) -> Column:
    return _sub(_sub(clean(c), r"(?<=\d)\s+([)\].,;:!?])", "$1"), r"\(\s+(?=OJ\b)", "(")


def title_lines(c: Column) -> Column:
    """Lines of an act's title: the date on its own, the relevance clause last."""
    t = _sub(clean(c), r"(?i) (of \d{1,2} [a-z]+ \d{4}) ", "\n$1\n")
    t = _sub(t, r"(?i) (\(Text with EEA relevance\))", "\n$1")
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def quote_noise(c: Column) -> Column:
    return _sub(_text(c), "(?U)[\\s'\"“”‘’`´]+")


def is_quote_change(a: Column, b: Column) -> Column:
    return (_text(a) != "") & (_text(b) != "") & (quote_noise(a) == quote_noise(b))


def without_repeated_word(deleted: Column, inserted: Column) -> Column:
    """The insertion without a first word that the deletion has too, unless nothing would be left."""
    first = lambda x: F.lower(F.regexp_extract(x, r"^\s*([A-Za-z0-9]+)\b", 1))
    rest = _sub(inserted, r"(?U)^\s*[A-Za-z0-9]+\b\s*")
    return F.when((first(deleted) != "") & (first(deleted) == first(inserted)) & (F.trim(rest) != ""), rest).otherwise(inserted)

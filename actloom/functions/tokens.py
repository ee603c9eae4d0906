"""Word tokens and what is computed on token arrays, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actloom.functions.text import clean, without_footnotes

#: the word pattern of all coverage figures (a fixed value)
WORD = r"[A-Za-z0-9]+(?:['-][A-Za-z0-9]+)?"
PIECE = rf"(?U)\[\[FN:\d+\]\]|\[\[SRC:[^\]]+\]\]|\([A-Za-z0-9]+\)|{WORD}|\s+|[^\w\s]"
#: structural words that say nothing about coverage (fixed values)
NOISE = ("article", "annex", "chapter", "section", "subsection", "point", "text", "oj", "en", "eu", "eec", "ec", "eur")
ROMAN = r"m{0,4}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})"


def words(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(WORD), F.lit(0)), F.lower)


def pieces(c: Column) -> Column:
    """Tokens that keep punctuation, spaces and markers."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(PIECE), F.lit(0))


def match_key(t: Column) -> Column:
    return F.when(t.rlike(rf"^(?:{WORD})$"), F.lower(t)).otherwise(t)


def is_noise(t: Column) -> Column:
    return (t == "") | t.isin(*NOISE) | t.rlike(r"^(?:m?\d+|[a-z])$") | (t.rlike(rf"^{ROMAN}$") & (t != ""))


def practical(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: ~is_noise(t))


def probe(c: Column, n: int) -> Column:
    return F.slice(words(clean(without_footnotes(c))), 1, n)


def first_tokens(c: Column, n: int = 30) -> Column:
    return F.slice(words(c), 1, n)


def contains_run(hay: Column, needle: Column) -> Column:
    """Whether the needle stands in the tokens as it is; an empty needle does not."""
    fenced = lambda x: F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" "))
    return (F.size(needle) > 0) & (F.instr(fenced(hay), fenced(needle)) > 0)


def matched_length(hay: Column, needle: Column, shorter: tuple[int, ...]) -> Column:
    """Length of the longest tried prefix of the needle that stands in the tokens, null if none does."""
    whole = F.when(contains_run(hay, needle), F.size(needle))
    return F.coalesce(whole, *[F.when((F.size(needle) > n) & contains_run(hay, F.slice(needle, 1, n)), F.lit(n)) for n in shorter])


def contains_in_order(hay: Column, needle: Column) -> Column:
    at = F.aggregate(hay, F.lit(0), lambda i, t: F.when((i < F.size(needle)) & (F.get(needle, i) == t), i + 1).otherwise(i))
    return (F.size(needle) > 0) & (at == F.size(needle))

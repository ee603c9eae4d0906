"""Similarity and differences of texts; Arrow-batched where the JVM has no equal."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from actloom.functions import tokens as T
from actloom.functions.text import let, normalized

#: longest texts and token lists whose distance is computed and not estimated, and what reports call the two ways (fixed values)
CHARS_EXACT, TOKENS_EXACT = 12_000, 3_000
EXACT, ESTIMATE = "exact_dynamic_programming", "estimated_from_sequence_matcher"
# types are built, not parsed: workers import this module without a session
DIFF = Y.StructType([Y.StructField(c, Y.IntegerType()) for c in ("inserted_words", "deleted_words", "replaced_from_words", "replaced_to_words")])
CODED = Y.StructType([Y.StructField(c, Y.StringType()) for c in ("x", "y")])


def ratio(a: str | None, b: str | None) -> float:
    """Character similarity of base and amendment, in this order; 0 if either is empty."""
    return SequenceMatcher(None, a.lower(), b.lower()).ratio() if isinstance(a, str) and isinstance(b, str) and a and b else 0.0


@F.pandas_udf(Y.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(Y.DoubleType())
def _plain_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(Y.DoubleType())
def _token_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, list(x), list(y)).ratio() for x, y in zip(a, b, strict=True)], dtype=float)


@F.pandas_udf(DIFF)
def word_diff(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Counts of inserted, deleted and replaced words between two token arrays."""
    out = []
    for x, y in zip(a, b, strict=True):
        n = [0, 0, 0, 0]
        for tag, i, j, k, m in SequenceMatcher(None, list(x if x is not None else ()), list(y if y is not None else ())).get_opcodes():
            if tag == "insert":
                n[0] += m - k
            elif tag == "delete":
                n[1] += j - i
            elif tag == "replace":
                n[2] += j - i
                n[3] += m - k
        out.append(n)
    return pd.DataFrame(out, columns=["inserted_words", "deleted_words", "replaced_from_words", "replaced_to_words"])


def _distance(distance: Column, longest: Column, estimate: Column, exact: Column) -> Column:
    """The figures of a comparison; the distance is computed once, however many of them are asked for."""

    def figures(v: Column) -> Column:
        similar = F.when(v["longest"] == 0, 1.0).otherwise(F.when(v["exact"], 1 - v["d"] / v["longest"]).otherwise(v["estimate"]))
        return F.struct(v["d"].alias("distance"), similar.alias("normalized_similarity"), F.when(v["exact"], EXACT).otherwise(ESTIMATE).alias("method"), (~v["exact"]).alias("is_estimate"))

    d = F.when(exact, distance).otherwise(F.round((1 - estimate) * longest).cast("int"))
    return let(F.struct(d.alias("d"), longest.alias("longest"), estimate.alias("estimate"), exact.alias("exact")), figures)


def char_distance(a: Column, b: Column, most: int = CHARS_EXACT) -> Column:
    """Edit distance of two normalised texts; an estimate from the similarity beyond ``most`` characters."""
    x, y = normalized(a), normalized(b)
    exact = F.greatest(F.length(x), F.length(y)) <= most
    # the estimate sees empty texts where the exact distance is taken
    estimate = _plain_ratio(F.when(exact, "").otherwise(x), F.when(exact, "").otherwise(y))
    return _distance(F.when(x == y, 0).otherwise(F.levenshtein(F.when(exact, x).otherwise(""), F.when(exact, y).otherwise(""))), F.greatest(F.length(x), F.length(y)), estimate, exact)


@F.pandas_udf(CODED)
def coded(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Two token arrays as strings with one character for each distinct token of the pair."""
    out = []
    for p, q in zip(a, b, strict=True):
        code: dict[str, str] = {}
        out.append(["".join(code.setdefault(t, chr(0x4E00 + len(code))) for t in s) for s in (p, q)])
    return pd.DataFrame(out, columns=["x", "y"])


def token_distance(a: Column, b: Column, most: int = TOKENS_EXACT) -> Column:
    """Edit distance of token arrays, exact up to ``most`` tokens: each token one character for the JVM's own function."""
    x, y = T.words(normalized(a)), T.words(normalized(b))
    exact = F.greatest(F.size(x), F.size(y)) <= most
    none = F.array().cast("array<string>")
    code = coded(F.when(exact, x).otherwise(none), F.when(exact, y).otherwise(none))
    estimate = _token_ratio(F.when(exact, none).otherwise(x), F.when(exact, none).otherwise(y))
    return _distance(F.levenshtein(code["x"], code["y"]), F.greatest(F.size(x), F.size(y)), estimate, exact)


def inserted_words(runs: Column) -> Column:
    """Words of runs that are double underlined and not struck."""
    live = F.filter(runs, lambda r: r["double_underline"] & ~r["strike"])
    return F.array_distinct(F.flatten(F.transform(live, lambda r: T.words(r["text"]))))

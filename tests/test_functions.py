"""Column functions against plain Python on hand-made and random lines."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from actloom.functions import classify as C
from actloom.functions import compare as K
from actloom.functions import targets as G
from actloom.functions import text as X
from actloom.functions import tokens as T


def values(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("t"))).collect()]


def test_clean_collapses_unicode_space(spark):
    assert values(spark, [" a\xa0b \n c ", None, "", " x"], X.clean) == ["a b c", "", "", "x"]


def test_markup_keeps_lines_and_tightens_points(spark):
    assert values(spark, ["a\t b ,\n\n\n\nc‑d .", "  x\n"], X.clean_markup) == ["a b,\n\nc-d.", "x"]


def test_slug(spark):
    assert values(spark, ["Article 5a — Scope", "__", None], X.slug) == ["article_5a_scope", "unknown", "unknown"]


def test_hard_spaces(spark):
    n = " "
    assert values(spark, ["EUR 10 000 000 and 5 %, € 3", "page 1 000a"], X.hard_spaces) == [f"EUR{n}10{n}000{n}000 and 5{n}%, €{n}3", "page 1 000a"]


def test_anchors_go(spark):
    assert values(spark, ["a [[SRC:art_1.2]] b SRC:art_3.1 c src art 4 5 d"], X.without_anchors) == ["a b c d"]


def test_marker_tabs(spark):
    lines = ["(1) a", "1a. b", "(B) c", "‘(iv)  d", "plain e", "", None]
    assert values(spark, lines, X.marker_tab) == ["(1)\ta", "1a.\tb", "(B)\tc", "‘(iv)\td", "plain e", "", ""]
    assert values(spark, ["(a) x\n\n1. y"], X.marker_tab_lines) == ["(a)\tx\n\n1.\ty"]
    assert values(spark, ["A. x", "IV. y", "(ab) z", "1a) w"], X.annex_line) == ["A.\tx", "IV.\ty", "(ab)\tz", "1a)\tw"]


def test_quotes(spark):
    assert values(spark, ["‘text’;", "'a..", "\"q\".", "‘6a. x’", "a...", None], X.unquoted) == ["text", "a.", "q.", "6a. x", "a...", ""]
    assert values(spark, ["‘6a. x", "‘(a) y", "‘word"], X.without_marker_quote) == ["6a. x", "(a) y", "‘word"]


def test_title_lines(spark):
    t = "Regulation (EU) 1/2 of the Council of 14 June 2017 on things (Text with EEA relevance)"
    assert values(spark, [t], X.title_lines) == [["Regulation (EU) 1/2 of the Council", "of 14 June 2017", "on things", "(Text with EEA relevance)"]]


def test_repeated_word(spark):
    df = spark.createDataFrame([("for", "for equity"), ("for", "for"), ("a", "b c")], "d string, i string")
    assert [r[0] for r in df.select(X.without_repeated_word(F.col("d"), F.col("i"))).collect()] == ["equity", "for", "b c"]


def test_let_binds_once(spark):
    assert values(spark, ["a", None], lambda c: X.let(c, lambda x: F.concat(x, x))) == ["aa", None]


def test_words_and_noise(spark):
    assert values(spark, ["Don't x-ray Article 5 (iv) İ"], T.words) == [["don't", "x-ray", "article", "5", "iv"]]
    words = ["", "article", "m12", "7", "a", "iv", "xii", "iiii", "mix", "law", "mm"]
    assert values(spark, words, T.is_noise) == [True, True, True, True, True, True, True, False, True, False, True]


def test_pieces_are_lossless(spark):
    t = "(a) Don't – stop, [[FN:3]] é ok_."
    got = values(spark, [t], T.pieces)[0]
    assert "[[FN:3]]" in got and "(a)" in got and "Don't" in got


@pytest.mark.parametrize(("hay", "needle", "shorter", "want"), [("a b c d", "b c", (), 2), ("a b c", "b c d", (2,), 2), ("a b", "c", (1,), None), ("a b", "", (), None), ("ab c", "b c", (), None)])
def test_matched_length(spark, hay, needle, shorter, want):
    df = spark.createDataFrame([(hay.split(), needle.split())], "h array<string>, n array<string>")
    assert df.select(T.matched_length(F.col("h"), F.col("n"), shorter)).first()[0] == want


def test_in_order(spark):
    df = spark.createDataFrame([(list("abcde"), list("ace")), (list("abc"), list("cb")), (list("abc"), [])], "h array<string>, n array<string>")
    assert [r[0] for r in df.select(T.contains_in_order(F.col("h"), F.col("n"))).collect()] == [True, False, False]


def test_marker_types(spark):
    lines = ["1. x", "(a) x", "(iv) x", "— x", "A. x", "IV. x", "x", "(i) x"]
    assert values(spark, lines, C.marker_type) == ["digit", "letter", "roman", "dash", "annex-letter", "annex-roman", None, "letter"]
    assert values(spark, lines, C.paragraph_level) == [1, 2, 3, 3, 1, 1, 0, 2]


def test_headings(spark):
    assert values(spark, ["Article 5a Scope", "article 7", "In Article 5", None], C.article_number) == ["5a", "7", None, None]
    assert values(spark, ["ANNEX IV", "Annex Va", "ANNEXES"], C.annex_number) == ["IV", None, None]
    assert values(spark, ["‘ANNEX Va", "ANNEX IV x"], C.annex_label) == ["VA", "IV"]


@pytest.mark.parametrize(
    ("line", "kind"),
    [("Article 2 is replaced by the following:", "replacement"), ("point (a) is deleted", "deletion"), ("the following points are added:", "insertion"), ("", "insertion"), ("is inserted as Annex VA", "insertion")],
)
def test_kinds(spark, line, kind):
    assert values(spark, [line], lambda c: C.amendment_kind(c, F.lit("text"))) == [kind]
    assert values(spark, ["x"], lambda c: C.amendment_kind(c, F.lit("(a)"))) == ["structural"]


def test_instructions(spark):
    lines = ["(12)", "(i) Article 5 is amended as follows:", "the following subparagraph is inserted:", "Annexes I to V are amended in accordance with the Annex to this Regulation", "The office shall publish.", ""]
    assert values(spark, lines, C.is_instruction) == [True, True, True, True, False, False]


def test_targets(spark):
    line = "In point (F) of Article 15(1), paragraph 3a, point IV in Annex ix of Regulation 2017/1129, the second subparagraph, points (a) and (b)"
    got = {n: values(spark, [line], f)[0] for n, f in {"art": G.article, "par": G.paragraph, "pt": G.point, "pts": G.all_points, "annex": G.annex, "apt": G.annex_point, "reg": G.regulation, "sub": G.subparagraph_ordinal}.items()}
    assert got == {"art": "15", "par": "3a", "pt": "f", "pts": ["f", "a", "b"], "annex": "IX", "apt": "iv", "reg": "2017/1129", "sub": 2}
    assert values(spark, ["points (a) and (b) are deleted", None], G.point) == [None, None]
    assert values(spark, ["in Article 3, Article 9 is replaced"], G.article) == ["3"]


def test_target_path_has_no_text_for_nulls(spark):
    df = spark.createDataFrame([("1", None, "a", None, None), (None, None, None, "II", "iv"), (None,) * 5], "a string, p string, t string, n string, q string")
    assert [r[0] for r in df.select(G.target_path(*[F.col(c) for c in "aptnq"])).collect()] == ["article/1/point/a", "annex/II/point/iv", "unresolved"]


def test_roman_roundtrip(spark):
    df = spark.range(1, 400)
    assert df.where(G.roman_value(G.roman(F.col("id"))) != F.col("id")).isEmpty()
    assert values(spark, ["V", "ix", "", "Q"], G.next_roman) == ["VI", "X", None, None]


def test_colors(spark):
    assert values(spark, ["Red", "#0a0b0c", "ABCDEF", None], G.color) == ["C00000", "0A0B0C", "ABCDEF", "E67800"]
    with pytest.raises(Exception, match="Unsupported color"):
        values(spark, ["pinkish"], G.color)


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_distances(spark):
    rnd = random.Random(1)
    pairs = [(" ".join(rnd.choices("abé xyz".split() + ["long", "word"], k=rnd.randint(0, 12))), " ".join(rnd.choices("abé xyz".split() + ["long"], k=rnd.randint(0, 12)))) for _ in range(60)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", K.char_distance(F.col("a"), F.col("b")).alias("c"), K.token_distance(F.col("a"), F.col("b")).alias("t")).collect():
        words = [re.findall("[a-z0-9]+", s) for s in (r.a, r.b)]
        assert r.c.distance == lev(r.a.strip(), r.b.strip()) and r.t.distance == lev(*words) and not r.c.is_estimate
    long = spark.createDataFrame([("a " * 40, "a " * 39 + "b")], "a string, b string").select(K.char_distance(F.col("a"), F.col("b"), 10).alias("c")).first().c
    assert long.is_estimate and long.method == K.ESTIMATE


def test_similarity_is_the_sequence_matchers(spark):
    df = spark.createDataFrame([("Abc def", "abd ef"), ("", "x"), (None, "x")], "a string, b string")
    want = [SequenceMatcher(None, "abc def", "abd ef").ratio(), 0.0, 0.0]
    assert [r[0] for r in df.select(K.similarity("a", "b")).collect()] == want

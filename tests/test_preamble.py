"""Parts of acts by container ids, and what an amending act adds to a text."""

import pytest

from actloom.operators import preamble as P
from actloom.sources import html

PAGE = """<html><body><div class="eli-container">
<div class="eli-subdivision" id="pbl_1"><p class="oj-normal">THE COUNCIL,</p>
<div class="eli-subdivision" id="cit_1"><p class="oj-normal">Having regard to x,</p></div>
<p class="oj-normal">Whereas:</p>
<div class="eli-subdivision" id="rct_1"><table><tr><td><p class="oj-normal">(1)</p></td><td><p class="oj-normal">First reason.</p></td></tr></table></div>
<div class="eli-subdivision" id="rct_2"><p class="oj-normal">(2) Second.</p></div>
<p class="oj-normal">HAVE ADOPTED THIS REGULATION:</p></div>
<div id="cpt_I"><p class="oj-ti-section-1">CHAPTER I</p><p class="oj-ti-section-2">General</p>
<div class="eli-subdivision" id="art_2"><p class="oj-ti-art">Article 2</p><p class="oj-sti-art">Scope</p><p class="oj-normal">1. Text.</p><p class="oj-normal">1. Text.</p></div></div>
<div class="eli-subdivision" id="art_1"><p class="oj-ti-art">Article 1</p><div id="art_1.tit_1">Article 1 Aim</div><p class="oj-normal">the following Articles are inserted:</p><div id="014A"><p class="oj-normal">‘Article 14a</p></div></div>
<div class="eli-subdivision" id="art_3"><p class="oj-ti-art">Article 3</p><p class="oj-sti-art">Entry into force</p><p class="oj-normal">It enters into force.</p></div>
<div class="oj-final"><p class="oj-normal">Done at the seat.</p><div class="oj-signatory"><p class="oj-signatory">The President</p><p class="oj-signatory"><span class="oj-italic">A. B.</span></p></div></div>
<div id="anx_1"><p>ANNEX</p><p>Annexes I and II are replaced by the following:</p><p>‘ANNEX I</p><p>line one</p><p>The following Annexes are added:</p><p>ANNEX VA</p><p>(a)</p><p>name;’</p></div>
</div></body></html>"""


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


@pytest.fixture(scope="module")
def e(spark):
    return html.elements(spark.createDataFrame([("d", PAGE)], "doc_id string, html string")).cache()


def test_preamble_parts(e):
    assert rows(P.preamble(e).orderBy("pos"), "part", "text") == [("entity", "THE COUNCIL,"), ("citation", "Having regard to x,"), ("bridge", "Whereas:"), ("formula", "HAVE ADOPTED THIS REGULATION:")]
    assert rows(P.recitals(e).orderBy("pos"), "number", "text") == [("1", "(1) First reason."), ("2", "(2) Second.")]
    assert rows(P.fallback_recitals(e).orderBy("pos"), "text") == [("(1)",), ("(2) Second.",)]


def test_operatives(e):
    assert rows(P.operatives(e).orderBy("ord"), "chapter", "number", "title") == [("cpt_I", "2", "Scope"), (None, "1", "Aim"), (None, "3", "Entry into force")]
    assert rows(P.chapters(e), "heading", "title") == [("CHAPTER I", "General")]
    assert [r[0] for r in rows(P.fallback_items(e).where("article_number = '2'"), "text")] == ["1. Text."]


def test_closing_parts(e):
    f = P.entry_into_force(e).first()
    assert (f.article_heading_line, f.article_subheading_line, f.article_body, f.final_lines) == ("Article 3", "Entry into force", ["It enters into force."], ["Done at the seat."])
    assert rows(P.signatories(e).orderBy("pos"), "text", "italic") == [("The President", False), ("A. B.", True)]


def test_annex_changes(e):
    got = rows(P.annex_changes(e).orderBy("annex_label", "ord"), "annex_label", "mode", "text")
    assert got == [("I", "replace", "ANNEX I"), ("I", "replace", "line one"), ("VA", "add", "ANNEX VA"), ("VA", "add", "(a)"), ("VA", "add", "name;’")]
    lines = P.annex_changes(e).where("annex_label = 'VA'").select("doc_id", "ord", "text")
    assert rows(P.merged_lines(lines).orderBy("ord"), "text") == [("ANNEX VA",), ("(a)\tname;",)]
    lines = P.annex_changes(e).where("annex_label = 'I'").select("doc_id", "ord", "text")
    assert rows(P.comparable_annex_lines(lines), "text") == [("ANNEX I\nline one",)]


def test_inserted_article_markers(e):
    ins = e.where("text = 'the following Articles are inserted:' and tag = 'p'").select("doc_id", "pos")
    assert rows(P.inserted_article_markers(e, ins), "marker") == [("14a",)]


def test_title_recitals_and_closing_are_added_once(spark):
    base = spark.createDataFrame([("d", i, t) for i, t in enumerate(["REGULATION X", "(1)\told", "Article 1"])], "doc_id string, ord int, text string")
    title = spark.createDataFrame([("d", "Regulation Y of 1 May 2020 on z")], "doc_id string, text string")
    rec = spark.createDataFrame([("d", 5, "(1) new one"), ("d", 6, "(1) old")], "doc_id string, pos int, text string")
    once = P.with_title_and_recitals(base, title, rec)
    want = ["REGULATION X", "as amended by", "Regulation Y\nof 1 May 2020\non z", "(1)\told", "(1)\tnew one", "Article 1"]
    assert [t for (t,) in rows(once.orderBy("ord"), "text")] == want
    again = P.with_title_and_recitals(once.select("doc_id", "ord", "text"), title, rec)
    assert [t for (t,) in rows(again.orderBy("ord"), "text")] == want
    end = spark.createDataFrame([("d", 0, "Done."), ("d", 1, "Article 1")], "doc_id string, pos int, text string")
    assert [t for (t,) in rows(P.with_closing(base, end).orderBy("ord"), "text")] == ["REGULATION X", "(1)\told", "Article 1", "Done."]

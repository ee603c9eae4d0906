"""A whole layer: title, recitals, closing parts, annexes, items, checks; and what each of the parts does on small documents."""

import pytest
from pyspark.sql import functions as F

from actloom.operators import annexes, apply, checks, preamble, revise
from actloom.operators import structure as S
from actloom.plans import pipeline
from actloom.sources import html

COLOR = "E67800"
ACT = ["REGULATION one", "(1) Old reason.", "Article 1", "1. First paragraph of the act.", "(a) old point;", "(b) other point;", "2. Second paragraph of the act.", "(c) third point;", "Article 2", "1. Scope of it.", "ANNEX I", "I. Old head", "Line one.", "(a) point of one.", "Line two.", "II. Other head", "ANNEX VI", "I. Last"]


def page(body, end="", annex=""):
    return f'''<html><body><div class="eli-container"><div class="eli-main-title">REGULATION two</div><div class="eli-subdivision" id="rct_1"><p class="oj-normal">(1)</p><p class="oj-normal">New reason.</p></div>
    <div class="eli-subdivision" id="art_1"><p class="oj-ti-art">Article 1</p><p class="oj-sti-art">Amendments</p>{body}</div>
    <div class="eli-subdivision" id="art_2"><p class="oj-ti-art">Article 2</p><p class="oj-sti-art">Entry into force</p><p class="oj-normal">It enters into force.</p></div>{end}{annex}</div></body></html>'''


def lines_of(spark, texts, doc="d"):
    return spark.createDataFrame([(doc, i, t) for i, t in enumerate(texts)], "doc_id string, ord bigint, text string")


def item(n, text, instruction, kind=None, article=None, paragraph=None, point=None, annex=None, annex_point=None, fresh=None):
    return ("d", n, text, kind, instruction, article, paragraph, point, annex, annex_point, fresh)


ITEM = "doc_id string, item_idx bigint, text string, amendment_kind string, source_instruction string, target_article_number string, target_paragraph_number string, target_point_marker string, target_annex_number string, target_annex_point_marker string, inserted_article_marker string"


def layer(spark, texts, *items):
    got = apply.apply_layer(lines_of(spark, texts), spark.createDataFrame(list(items), ITEM), COLOR)
    text = [r.text for r in got.where("part = 'paragraph'").orderBy("ord").collect()]
    return text, {r.item_idx: r for r in got.where("part = 'item'").collect()}


def test_annex_point_is_replaced_line_by_line_and_keeps_its_numeral(spark):
    said = "In Annex I, point I is replaced by the following:"
    text, done = layer(spark, ACT, *[item(n, t, said, annex="I", annex_point="i") for n, t in enumerate(["New head", "New one.", "New two.", "Too many."])])
    assert text[11:16] == ["I.\tNew head", "New one.", "(a) point of one.", "New two.", "II. Other head"]
    assert [done[n].applied_mode for n in range(4)] == ["replaced"] * 3 + ["analysis_only"]


def test_paragraph_is_inferred_from_points_similarity_and_items_before(spark):
    said = "In Article 1, in the first subparagraph, the text is replaced by the following:"
    like = item(0, "Second paragraph of the law, point (z).", said, article="1")
    _, done = layer(spark, ACT, like)
    assert done[0].target_paragraph_number == "2"
    _, done = layer(spark, ACT, item(0, "See point (c).", said, article="1"))
    assert done[0].target_paragraph_number == "2"
    _, done = layer(spark, ACT, item(0, "New point;", "In Article 1, paragraph 1, point (a) is replaced by the following:", article="1", paragraph="1", point="a"), item(1, "Text.", said, article="1"))
    assert done[1].target_paragraph_number == "1"
    _, done = layer(spark, ACT, item(0, "(bb) x;", "the following point is added:", article="1", paragraph="1", point="bb"), item(1, "(x) y;", "the following point is added:", article="1", point="x"), item(2, "(y) y;", "point (y) is replaced by the following:", article="1", point="y"))
    assert done[1].target_paragraph_number == "1" and done[2].target_paragraph_number is None


@pytest.mark.parametrize(
    ("text", "point", "left"),
    [("1. Lead:\n(a) one;\n(i) inner;\n(b) two;\nAfter all.", "a", "1. Lead:\n(b) two;\nAfter all."), ("1. Lead:\n(a) one;\nand more;\nAfter all.", "a", "1. Lead:\nAfter all."), ("(a) one", "a", None), ("x\ny", "a", None), ("(a) one\nmore", "a", ""), ("(i) one\n(ii) two", "i", "(ii) two")],
)
def test_points_are_pruned_from_paragraphs_of_several_lines(text, point, left):
    assert apply.pruned(text, point) == left


def test_deletion_prunes_a_line(spark):
    text, done = layer(spark, ["Article 1", "1. Lead:\n(a) one;\n(b) two;"], item(0, "deleted", "In Article 1(1), point (a) is deleted", "deletion", "1", "1", "a"))
    assert text[1] == "1. Lead:\n(b) two;" and done[0].applied_mode == "replaced"


def test_roman_points_of_replacements_stay_plain():
    doc = apply.Document(["x"])
    doc.insert(1, "(ii)\troman", COLOR, "is replaced by the following:")
    doc.insert(2, "(b)\tletter", COLOR, "is replaced by the following:")
    assert [r[0]["double_underline"] for r in doc.runs] == [False, False, True]


def test_levels_of_an_inserted_annex():
    assert annexes.levels(["I. Head", "Text", "1. Number", "(a) point", "(b) point", "and more", "After", "(a) point"]) == [(1, -1), (1, 0), (2, -1), (3, -1), (3, -1), (3, 0), (3, 0), (3, -1)]
    assert annexes.levels(["(a) point", "Body again"]) == [(2, -1), (1, 0)]


def test_alignment_pairs_by_key_and_keeps_anchors():
    import pandas as pd

    side = lambda ts: pd.DataFrame([("d", 10 * i, t, "body", t.lower().split()[0]) for i, t in enumerate(ts)], columns=["doc_id", "ord", "text", "kind", "value"])
    got = revise.align(side(["a x", "b x", "c x", "d x"]), side(["a x", "b y", "e x", "d x", "f x"]))
    assert [(r.action, None if pd.isna(r.anchor) else r.anchor, r.old, r.new) for r in got.itertuples()] == [("equal", 0, "a x", "a x"), ("revise", 10, "b x", "b y"), ("delete", 20, "c x", None), ("insert", 20, None, "e x"), ("equal", 30, "d x", "d x"), ("insert", None, None, "f x")]
    assert revise.forward_sync(["a", "b", "c"], ["c", "a"], 0, 0) == (2, 1) and revise.forward_sync(["a"] + ["x"] * 20 + ["c"], ["c"], 0, 0) == (None, None)


def test_annexes_are_replaced_aligned_and_added(spark):
    base = lines_of(spark, ACT).withColumn("runs", F.lit(None).cast(revise.RUNS))
    new = [("d", "I", "replace", n, t) for n, t in enumerate(["ANNEX I", "I. Old head", "Line one, revised.", "(b) new point", "II. Other head"])]
    new += [("d", "IA", "add", n, t) for n, t in enumerate(["ANNEX IA", "NEW THINGS OF NOTE"])] + [("d", "VI", "add", 0, "ANNEX VI"), ("d", "IX", "replace", 0, "ANNEX IX"), ("d", "IX", "replace", 1, "I. Head")]
    got = annexes.with_annexes(base, spark.createDataFrame(new, "doc_id string, annex_label string, mode string, ord int, text string"), COLOR).orderBy("ord").collect()
    text = [r.text for r in got]
    assert text[:10] == ACT[:10] and text.index("ANNEX IA\nNEW THINGS OF NOTE") == text.index("II. Other head") + 1 and text[-2:] == ["ANNEX IX", "I.\tHead"]
    assert text.count("ANNEX VI") == 1 and "(b)\tnew point" in text and "Line two." not in text
    struck = [r.runs[0].text for r in got if r.runs and r.runs[0].kind == "delete"]
    assert "Line two." in struck and "(a) point of one." in struck
    assert [r.ord for r in got] == list(range(len(got)))


def test_a_layer_from_its_page(spark):
    body = "".join(f'<p class="oj-normal">{t}</p>' for t in ("In Article 1, paragraph 1, point (a) is replaced by the following:", "(a) brand new point;", "In Article 2, the following paragraph is added:", "2. Added paragraph of scope.", "In Annex I, point II is replaced by the following:", "Second head"))
    end = '<div class="oj-final"><p class="oj-normal">Done.</p><div class="oj-signatory"><p class="oj-signatory">The President</p></div></div>'
    amending = spark.createDataFrame([("d", page(body, end))], "doc_id string, html string")
    got = pipeline.consolidate(lines_of(spark, ACT), amending, COLOR, require_full=True)
    text = [r.text for r in got["paragraphs"].orderBy("ord").collect()]
    assert text[:5] == ["REGULATION one", "as amended by", "REGULATION two", "(1) Old reason.", "(1)\tNew reason."]
    assert "(a)\tbrand new point;" in text and "II.\tSecond head" in text
    assert text[text.index("2.\tAdded paragraph of scope.") - 1] == "1. Scope of it."
    at = text.index("ANNEX I")
    assert text[at - 4 : at] == ["Article 2\nEntry into force", "It enters into force.", "Done.", "The President"]
    # the line on entry into force is an item too, and stands already
    assert [r.applied_mode for r in got["analysis"].orderBy("item_idx").collect()] == ["replaced", "inserted", "replaced", "already_applied"]
    assert got["one_go"].first().passed and got["proofs"].where("status <> 'proven'").isEmpty()
    # the same page again adds no title, recital, closing line or paragraph
    again = [r.text for r in pipeline.consolidate(got["paragraphs"], amending, "0066CC")["paragraphs"].orderBy("ord").collect()]
    assert [t for t in again if t] == [t for t in text if t]


def test_a_layer_that_is_not_applied_whole_is_refused(spark):
    amending = spark.createDataFrame([("d", page('<p class="oj-normal">In Article 9, paragraph 1 is replaced by the following:</p><p class="oj-normal">1. Words that nowhere stand in this whole act so far.</p>'))], "doc_id string, html string")
    assert not pipeline.consolidate(lines_of(spark, ACT), amending, COLOR)["one_go"].first().passed
    with pytest.raises(RuntimeError, match="one go"):
        pipeline.consolidate(lines_of(spark, ACT), amending, COLOR, require_full=True)


def test_inserted_articles_get_the_marker_beside_their_instruction(spark):
    body = '<p class="oj-normal">the following article is inserted:</p><div class="eli-subdivision" id="001A"><p class="oj-ti-art">Article 1a</p></div><p class="oj-normal">1. Text of the new article.</p>'
    got = pipeline.consolidate(lines_of(spark, ACT), spark.createDataFrame([("d", page(body))], "doc_id string, html string"), COLOR)
    assert [r.inserted_article_marker for r in got["items"].orderBy("item_idx").collect()] == ["1a", None]
    text = [r.text for r in got["paragraphs"].orderBy("ord").collect()]
    assert text[text.index("Article 1a") + 1] == "1.\tText of the new article." and text.index("Article 1a") < text.index("Article 2")


def test_report_of_a_layer(spark):
    said = "In Article 1, paragraph 1, point (a) is replaced by the following:"
    items = spark.createDataFrame([item(0, "(a) brand new point;", said, article="1", paragraph="1", point="a"), item(1, "Far away words that stand nowhere in the act at all.", "In Article 9, paragraph 1 is replaced by the following:", article="9", paragraph="1")], ITEM)
    result = apply.apply_layer(lines_of(spark, ACT), items, COLOR)
    texts = [t for t in ACT if t != "(a) old point;"] + ["(a) brand new point;"]
    good = pipeline.report(result, spark.createDataFrame([("d", "\n".join(texts))], "doc_id string, text string"), COLOR).first()
    assert good.issues == ["replacements_not_applied"] and not good.passed and good.comparison.strict_coverage == 1.0
    none = pipeline.report(result, spark.createDataFrame([("other", "x")], "doc_id string, text string"), COLOR).first()
    assert "no_source_compared" in none.issues
    bare = apply.apply_layer(lines_of(spark, ACT), spark.createDataFrame([], ITEM), COLOR)
    assert "no_inserted_runs_in_layer_color" in pipeline.report(bare, spark.createDataFrame([("d", "\n".join(ACT))], "doc_id string, text string"), COLOR).first().issues


def test_verify_tells_documents_of_one_side(spark):
    t = lambda *r: spark.createDataFrame(list(r), "doc_id string, text string")
    got = {r.doc_id: r for r in pipeline.verify(t(("a", "x"), ("b", "y")), t(("a", "x"), ("c", "z"))).collect()}
    assert got["a"].passed and not got["b"].passed and not got["c"].passed and set(got) == {"a", "b", "c"}


PAGE = """<html><body><p class="oj-hd-oj">outside</p><div class="eli-container"><p class="oj-hd-lg">EN</p><p class="oj-hd-oj">L 1/2</p>
<div id="anx_I" class="eli-subdivision"><p class="oj-doc-ti">ANNEX I</p><p class="oj-ti-tbl">Table 1</p><p class="oj-normal">Plain line.</p>
<div class="oj-enumeration-spacing"><p>I.</p><p>Summary</p><p class="oj-normal">Body of it.</p><table><tr><td>A.<td><p>one</p><p>two</p></table></div>
<table class="oj-table"><tr><th>h<th>k</tr><tr><td>x<td>y<td>z</tr><tr><td></tr></table><table><tr><td>1<tr><td>2<tr><td>3<tr><td>4<tr><td>5</table></div></div></body></html>"""


def test_annexes_of_a_page(spark):
    e = html.elements(spark.createDataFrame([("d", PAGE)], "doc_id string, html string")).cache()
    t = annexes.largest_tables(e).first()
    assert (t.box, t.rows, t.cells) == ("anx_I", 3, 6)  # the styled one, although another has more rows
    assert {r.text for r in annexes.cell_texts(e).collect()} == {"A.", "one\ntwo", "h", "k", "x", "y", "z", "", "1", "2", "3", "4", "5"}
    assert [(r.left, r.right, r.is_header) for r in annexes.structured_tables(e).orderBy("ord").collect()] == [("h", "k", True), ("x", "y\nz", False)]
    got = [(r.text, r.left_cm, r.first_line_cm) for r in annexes.emitted(e).orderBy("ord").collect()]
    assert got[:4] == [("Plain line.", 0, 0), ("I.\tSummary", 1, -1), ("Body of it.", 1, 0), ("A.\tone\ntwo", 2, -1)] and got[4:6] == [("h\tk", 2, -1), ("x\ty\tz", 2, -1)]
    heads = e.where(S.has("oj-doc-ti")).select("doc_id", "pos")
    box = e.where("id = 'anx_I'").first().pos
    assert annexes.nearest_containers(e, heads).first().container == box
    m = S.metadata(e, S.legal_root(e)).first().metadata
    assert m["official_journal"] == "L 1/2" and m["language"] == "EN" and m["source_path"] == "d"


def test_highlighted_words(spark):
    df = spark.createDataFrame([("the old law", "the new law applies"), (None, "all"), ("x", None)], "a string, b string")
    got = [[(r.text, r.changed) for r in x.h] for x in df.select(revise.highlighted(COLOR)("a", "b").alias("h")).collect()]
    assert got == [[("the", False), ("new", True), ("law", False), ("applies", True)], [("all", True)], []]


def test_examples_are_the_first_cases(spark):
    df = spark.createDataFrame([("d", i) for i in range(40, 0, -1)] + [("e", 5)], "doc_id string, item_idx bigint")
    got = {r.doc_id: r.examples for r in checks.examples(df, 3).collect()}
    assert got == {"d": [1, 2, 3], "e": [5]}


def test_annex_checks_and_retrofit(spark):
    items = spark.createDataFrame([("d", 0, "The Annex is inserted as Annex VIA", "text"), ("d", 1, "is inserted as Annex X", "Line one.")], "doc_id string, item_idx bigint, source_instruction string, amending_text string")
    got = {r.label: (r.present, r.in_order) for r in checks.annex_checks(items, lines_of(spark, [*ACT, "ANNEX VIa", "ANNEX VII"])).collect()}
    assert got == {"VIA": (True, True), "X": (False, True)}
    assert [r.text for r in checks.retrofit(lines_of(spark, ACT), items).collect()] == ["Line one."]


def test_closing_lines_stand_before_the_annexes(spark):
    block = spark.createDataFrame([("d", "Article 3", None, ["1. It enters."], ["Done."])], "doc_id string, article_heading_line string, article_subheading_line string, article_body array<string>, final_lines array<string>")
    signed = spark.createDataFrame([], "doc_id string, block int, pos int, text string, italic boolean")
    got = preamble.with_closing(lines_of(spark, ACT), preamble.closing_lines(block, signed)).orderBy("ord").collect()
    assert [r.text for r in got if r.added] == ["Article 3", "1.\tIt enters.", "Done."] and [r.text for r in got][10:14] == ["Article 3", "1.\tIt enters.", "Done.", "ANNEX I"]

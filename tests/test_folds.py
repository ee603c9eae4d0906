"""Articles and annexes of many acts are folded as they come from a sort, not one pandas group each."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from actloom.operators import annexes, collect, revise

COLOR = "E67800"
LINES = "doc_id string, article_number string, article_heading string, pos int, text string, in_table boolean, near_article string"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_items_of_many_articles_do_not_mix(spark, monkeypatch):
    said = ["In Article 4, paragraph 2, the following points are added:", "(a) first thing;", "(b) second thing;"]
    # pos is as it comes; the second article of each act begins without an instruction
    lines = [(f"d{d}", a, "Amendments", 10 * int(a) + n, t, False, None) for d in range(40) for a, ts in (("2", ["Plain text."]), ("1", said)) for n, t in enumerate(ts)]
    got = collect.items(spark.createDataFrame(lines[::-1], LINES))
    assert "MapInArrow" in plan(got) and "GroupsInPandas" not in plan(got)
    rows = {}
    for r in got.orderBy("doc_id", "item_idx").collect():
        rows.setdefault(r.doc_id, []).append((r.item_idx, r.article_number, r.text, r.target_article_number, r.target_paragraph_number, r.source_instruction))
    want = [(0, "1", "(a)\tfirst thing;", "4", "2", said[0]), (1, "1", "(b)\tsecond thing;", "4", "2", said[0]), (2, "2", "Plain text.", None, None, None)]
    assert rows == {f"d{d}": want for d in range(40)}
    # batches may end within an article, results are sent on in parts
    whole = collect.described(spark.createDataFrame(lines, LINES)).orderBy("doc_id", "article_number", "pos").toArrow()
    monkeypatch.setattr(collect, "SENT", 7)
    parts = [pa.Table.from_batches(list(collect._folded(iter(whole.to_batches(max_chunksize=n))))).to_pylist() for n in (1, 5, 1000)]
    assert len(parts[0]) == 120 and parts[0] == parts[1] == parts[2]
    assert list(collect._folded(iter([])))[0].num_rows == 0


def test_annexes_of_many_acts_are_changed_without_a_group_each(spark, monkeypatch):
    base, new = [], []
    for d in range(30):
        base += [(f"d{d}", n, t) for n, t in enumerate(["Title", "ANNEX I", "I. Head", f"Line of {d}.", "ANNEX II", "Stays."])]
        new += [(f"d{d}", "I", "replace", n, t) for n, t in enumerate(["ANNEX I", "I. Head", f"Line of {d}, revised.", "More."])] + [(f"d{d}", "III", "add", 0, "ANNEX III")] * (d % 2)
    lines = spark.createDataFrame(base, "doc_id string, ord bigint, text string").withColumn("runs", F.lit(None).cast(revise.RUNS))
    seen, written = [], annexes.written
    monkeypatch.setattr(annexes, "written", lambda df, label="t": seen.append(plan(df)) or written(df, label))
    got = annexes.with_annexes(lines, spark.createDataFrame(new, "doc_id string, annex_label string, mode string, ord int, text string"), COLOR)
    # made once, though lines that change and lines that stay both ask for them
    assert len(seen) == 1 and "MapInArrow" in seen[0] and "GroupsInPandas" not in seen[0] + plan(got)
    rows = {}
    for r in got.orderBy("doc_id", "ord").collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    for d in range(30):
        # a heading may stand with the line below it, a struck line stands without text
        assert " ".join(rows[f"d{d}"]).split() == " ".join(["Title ANNEX I I. Head", f"Line of {d}, revised. More.", "ANNEX II Stays.", "ANNEX III" * (d % 2)]).split()
    schema = to_arrow_schema(spark.createDataFrame([], annexes.CHANGED).schema)
    kinds = pa.schema([("doc_id", pa.string()), ("label", pa.string()), ("side", pa.int32()), ("ord", pa.int64()), ("text", pa.string()), ("kind", pa.string()), ("value", pa.string()), ("runs", schema.field("runs").type)])
    sides = [(f"d{d}", "I", s, n, t, "body", t, None) for d in range(9) for s in range(2) if (d + s) % 3 for n, t in enumerate(["a b", "c d" if s else "c", "e"])]
    whole = pa.Table.from_pylist([dict(zip(kinds.names, r, strict=True)) for r in sides], kinds)
    monkeypatch.setattr(annexes, "SENT", 4)
    parts = [pa.Table.from_batches(list(annexes._change(COLOR, schema)(iter(whole.to_batches(max_chunksize=n))))).to_pylist() for n in (1, 4, 1000)]
    assert parts[0] == parts[1] == parts[2] and {r["doc_id"] for r in parts[0]} == {f"d{d}" for d in range(9) if (d + 1) % 3}


def test_headings_are_sought_only_in_lines_that_name_them(spark):
    from actloom.functions import classify as C

    texts = ["ANNEX IV", " ‘Annex iva’ ", "‘ AnNeX\t\n II.", "Annexes I", "an annex I", "Article 3a", " ARTICLE  7 ", "see Article 3", "Chapter ii", "chapter X.", "ſArticle 1", "ARTİCLE 1", "ANNE X", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(*[f(F.col("t")).alias(n) for n, f in (("x", C.annex_label), ("a", C.article_number), ("c", C.chapter_number))])
    want = {0: ("IV", None, None), 1: ("IVA", None, None), 2: ("II", None, None), 5: (None, "3a", None), 6: (None, "7", None), 8: (None, None, "II"), 9: (None, None, "X")}
    assert [tuple(r) for r in got.collect()] == [want.get(i, (None, None, None)) for i in range(len(texts))]
    # a line without the word is not cleaned: the search stands behind the test for it
    for c in got.columns:
        assert "case when contains(lower(" in plan(got.select(c)).lower()

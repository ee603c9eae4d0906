import random
from difflib import SequenceMatcher

import pytest

from actloom.functions import matching
from actloom.operators import apply, checks


def plain(texts, amend):
    low = amend.lower()
    score, at = max(((SequenceMatcher(None, t.lower(), low).ratio(), -i) for i, t in enumerate(texts) if t and low), default=(0.0, 1))
    return (-at, score) if score > 0 else (-1, 0.0)


@pytest.mark.parametrize("seed", range(6))
def test_best_matches_of_many_texts_are_those_of_difflib(monkeypatch, seed):
    if seed % 2:
        for name, value in (("PAIRS", 7), ("HITS", 50), ("BLOCK_CHARS", 60), ("FEW", 0), ("BOUNDED", 0.0)):
            monkeypatch.setattr(matching, name, value)
    rnd = random.Random(seed)
    for _ in range(30):
        letters, long = rnd.choice(["ab", "abc ", "abcdefghijklmnop ", "aabbccdeXİß𝒜é "]), rnd.choice([5, 30, 150, 400])
        texts = ["".join(rnd.choices(letters, k=rnd.randint(0, long))) for _ in range(rnd.randint(1, 20))] + [None]
        near = list(rnd.choice(texts[:-1]) * 2)
        for i in rnd.sample(range(len(near)), len(near) // 8):
            near[i] = rnd.choice(letters)
        amends = ["", "".join(near), "".join(rnd.choices(letters + "zqw", k=rnd.choice([20, 250, 500])))]
        want = [plain(texts, a) for a in amends]
        assert matching.Lines(texts).best(amends) == want
        assert matching.Lines(texts).best(amends, 0.6) == [(i, r) if r >= 0.6 else (-1, 0.0) for i, r in want]


def test_many_texts_are_not_compared_pair_by_pair(monkeypatch):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("abcdefghij ", k=80)) for _ in range(60)]
    amend = "".join(rnd.choices("abcdefghij ", k=90))
    want = plain(texts, amend)
    monkeypatch.setattr(SequenceMatcher, "find_longest_match", lambda *_: pytest.fail("a pair alone"))
    assert apply.best_match(texts, amend) == want


@pytest.mark.parametrize("seed", range(8))
def test_bounds_of_matching_characters_hold_and_matches_stay_those_of_difflib(monkeypatch, seed):
    for name, value in (("ALL", 0), ("FEW", 0), ("FIRST", (1, 2)), *((("MET", 5), ("MET_PLACES", 9), ("BLOCK_CHARS", 900), ("ORDERED", 1)) if seed % 2 else ())):
        monkeypatch.setattr(matching, name, value)
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("etaoinshr", k=rnd.randint(1, 6)) + rnd.choices("xzqéж", k=rnd.choice([0, 0, 1])))
    words = [word() for _ in range(rnd.choice([8, 60]))]
    text = lambda n: " ".join(rnd.choices(words, k=n))
    texts = [text(rnd.randint(0, 70)) for _ in range(25)]
    amends = [text(rnd.choice([5, 60, 140, 400])) for _ in range(6)] + [texts[3][:60] + text(60) + texts[9][-50:], "e" * 300]
    assert matching.Lines(texts).best(amends) == [plain(texts, a) for a in amends]
    own = [t for t in dict.fromkeys(texts) if t]
    block, every = matching._Block(own), [matching.Amendment(a) for a in amends]
    for most, got in zip(block.ceilings(every), block.matched([(b, matching.np.arange(len(own))) for b in every]), strict=True):
        assert (most >= got).all()


def test_texts_that_cannot_be_best_are_not_compared(monkeypatch):
    rnd = random.Random(4)
    words = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 6))) + rnd.choice(["", "", "x", "q", "zk"]) for _ in range(300)]
    texts = [" ".join(rnd.choices(words, k=40)) for _ in range(300)]
    amend = " ".join(rnd.choices(words, k=30)) + texts[77][40:150] + " ".join(rnd.choices(words, k=30))
    compared, matched = [], matching._Block.matched
    monkeypatch.setattr(matching._Block, "matched", lambda self, pairs: compared.extend(len(x[-1]) for x in pairs) or matched(self, pairs))
    assert matching.Lines(texts).best([amend]) == [plain(texts, amend)]
    assert sum(compared) < 100


def test_the_resolved_items_of_a_layer_are_made_once(spark, data, monkeypatch):
    from actloom.plans import audit_queries

    labels = []
    monkeypatch.setattr(audit_queries, "written", lambda df, label="t": labels.append(label) or df)
    audit_queries.applied(spark, data)
    assert labels == ["todo"]


def test_a_layer_without_matches_differs_in_nothing_else(spark):
    rnd = random.Random(8)
    word = lambda: rnd.choice("Member States shall ensure that goods of every kind are listed in time".split())
    text = lambda n: " ".join(word() for _ in range(n))
    lines, items = [], []
    for d in range(12):
        own = ["Article 1", "1. " + text(9), "(a) " + text(8), "(b) " + text(20), "2. " + text(30)] if d else []
        lines += [(str(d), i, t) for i, t in enumerate(own)]
        for k in range(6):
            near = rnd.choice(own or ["x"]).split(" ")
            near[-1] = word()
            kind = rnd.choice(["replaced", "added", "deleted"])
            items.append((str(d), 10 * d + k, rnd.choice([" ".join(near), text(12), None]), f"In Article 1, point (a) is {kind} by the following:", {"deleted": "deletion"}.get(kind), rnd.choice(["1", None]), rnd.choice(["1", "7", None]), rnd.choice(["a", "z", None]), None, None))
    paragraphs = spark.createDataFrame(lines, "doc_id string, ord int, text string")
    todo = spark.createDataFrame(items, "doc_id string, item_idx bigint, text string, source_instruction string, amendment_kind string, target_article_number string, target_paragraph_number string, target_point_marker string, target_annex_number string, target_annex_point_marker string")
    whole, bare = (apply.apply_layer(paragraphs, todo, "E67800", m).collect() for m in (True, False))
    key = lambda r: (r.doc_id, r.part, r.ord if r.part == "paragraph" else r.item_idx)
    shown = lambda rows: [[v for c, v in r.asDict(True).items() if not c.startswith("best_")] for r in sorted(rows, key=key)]
    assert shown(whole) == shown(bare) and len({r.applied_mode for r in whole if r.part == "item"}) >= 3
    assert all(r.best_match_index is None for r in bare) and any(r.best_match_score for r in whole if r.part == "item")


def test_ordered_words_and_sections_in_one_pass(spark):
    rnd = random.Random(9)
    words = lambda n: [rnd.choice("abcde") for _ in range(n)]
    lines = [(d, i, s, s.lower() if s else None, " ".join(words(rnd.randint(0, 30)))) for d in ("x", "y") for i in range(20) for s in [f"{i // 5}"]]
    probes = [(d, n, words(rnd.choice([0, 1, 3, 7, 9, 40]))) for n, d in enumerate(["x", "y", "z"] * 30)]
    p = spark.createDataFrame(probes, "doc_id string, item_idx bigint, probe array<string>")
    df = spark.createDataFrame([(d, i, s, int(s) * 5, t) for d, i, s, _, t in lines], "doc_id string, ord bigint, article string, start bigint, text string")
    of = lambda d, s=None: [w for x, _, a, _, t in lines if x == d and s in (None, a) for w in t.split()]

    def ordered(hay, needle):
        it = iter(hay)
        return bool(needle) and all(w in it for w in needle)

    assert {r.item_idx for r in checks.in_order(p, df).collect()} == {n for d, n, q in probes if ordered(of(d), q)}
    want = {}
    for d, n, q in probes:
        for s in {a for x, _, a, _, _ in lines if x == d}:
            hay, k = of(d, s), min(checks.KEY, len(q))
            got = [next((m for m in range(len(q) + 1) if m == len(q) or i + m >= len(hay) or hay[i + m] != q[m]), 0) for i in range(len(hay))]
            if q and max(got, default=0) >= k:
                want[n, s] = max(got)
    assert {(r.item_idx, r.article): r.matched for r in checks.section_matches(p, df).collect()} == want

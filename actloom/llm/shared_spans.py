"""Long exact spans shared between records.

Method: repeated-phrase automata.  Every span of ``span`` words contains, at a place that depends only on its words, one
anchor (the least hash among its ``GRAM``-word grams), so recurring passages show as recurring anchors.  The stretches of
text around recurring anchors are routed by anchor; a task takes anchors together until their spans fill a shard,
confirms the spans that recur, compiles the shard's Aho-Corasick automaton over word numbers and streams the stretches
through it to locate every occurrence.  No stretch meets an automaton of anchors it does not hold: streaming every text
through every shard would grow with the square of the collection and find the same.

An anchor with ``HOT_ANCHOR`` stretches or more, and every such anchor, is spread over tasks by record.  Its spans are
confirmed by an aggregate over all its shares, and each share then compiles its automata from the confirmed spans it holds.

Spans that stand in the same texts form one class, so that a passage of two hundred words is one class and not 181 spans.

Words are what stands between whitespace, compared character for character; texts and classes are known by 128-bit digests.

Defined cases: null texts and texts under ``span`` words share nothing; equal texts are one text with several members;
rows without id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actloom.llm import codes
from actloom.runtime import partitions, written

SPAN, GRAM = 20, 8
#: spans of one automaton; stretches of one anchor from which on it is spread over tasks; anchors of one task
SHARD_SPANS, HOT_ANCHOR, TASK_ANCHORS = 20_000, 20_000, 2_000_000
#: whitespace as Python's str.split has it
SPACE = r"(?U)[\s\x{1c}-\x{1f}]+"


class Grams:
    """Words and anchors of a slice of texts that have at least ``span`` words."""

    def __init__(self, text: pa.Array, span: int, gram: int) -> None:
        self.text = text
        h, row, self.start, self.end = codes.spaced(text)
        edge = codes.bounds(row, len(text))
        n = np.diff(edge)
        self.rows = np.flatnonzero(n >= span)
        self.first, self.n = edge[:-1][self.rows], n[self.rows]
        pre = codes.prefix(codes.mix(h))
        count = max(0, len(h) - gram + 1)
        i = np.arange(count)
        g = codes.stretch(pre, i, i + gram)
        w = span - gram + 1
        self.anchor = np.zeros(0, np.uint64)
        self.local = self.low = self.high = np.zeros(0, np.int64)  # text, first and last word at which a span of this anchor starts
        if len(self.rows) and count >= w:
            low = np.lib.stride_tricks.sliding_window_view(g, w).argmin(1) + np.arange(count - w + 1)
            # windows that lie within one text
            size = self.n - span + 1
            at = np.repeat(self.first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            local = np.repeat(np.arange(len(self.rows)), size)
            low = low[at]
            new = np.ones(len(low), bool)
            new[1:] = (low[1:] != low[:-1]) | (local[1:] != local[:-1])
            self.local, self.anchor, self.low = local[new], g[low[new]], at[new]
            self.high = at[np.append(new[1:], True)]

    def keys(self) -> np.ndarray:
        """Digests of the words of the texts."""
        if not len(self.rows):
            return np.zeros(0, codes.PAIR)
        return np.frombuffer(b"".join(codes.digest(" ".join(t.split()).encode("utf-8", "surrogatepass")) for t in self.text.take(pa.array(self.rows)).to_pylist()), codes.PAIR)


def _grams(batches: Iterator[pa.RecordBatch], column: int, span: int, gram: int) -> Iterator[tuple[pa.RecordBatch, int, pa.Array, Grams]]:
    for b in batches:
        for at, part in codes.slices(b.column(column).cast(pa.string())):
            yield b, at, part, Grams(part, span, gram)


SURVEY = "grp string, id bigint, k binary, n_words int, anchor bigint, route int"
PASS = -1  # route of an anchor that its task already knows to recur
ROUTES = 1 << 30


def _distinct(anchor: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (anchor, key) in order."""
    order = np.lexsort((key["y"], key["x"], anchor))
    anchor, key = anchor[order], key[order]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    return anchor[new], key[new]


def _known(anchor: np.ndarray) -> np.ndarray:
    """Route of each distinct (anchor, key) pair of a task, sorted: by the anchor; of the pairs of an anchor with several
    keys only two are routed, which tell the other tasks, and the rest pass."""
    route = (anchor % np.uint64(ROUTES)).astype(np.int32)
    first = np.searchsorted(anchor, anchor)
    route[np.arange(len(anchor)) - first > 1] = PASS
    return route


def _survey(span: int, gram: int):
    """One pass for the members (grp, id, k, n_words) and the anchors (k, anchor, route) of a task, each text once."""

    def table(**cols: pa.Array) -> pa.RecordBatch:
        n = len(next(iter(cols.values())))
        types = {"grp": pa.string(), "id": pa.int64(), "k": pa.binary(), "n_words": pa.int32(), "anchor": pa.int64(), "route": pa.int32()}
        return pa.RecordBatch.from_arrays([cols.get(c, pa.nulls(n, t)) for c, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            anchor, key = _distinct(*(np.concatenate([h[i] for h in held]) for i in range(2)))
            return table(k=codes.binaries(key), anchor=pa.array(codes.signed(anchor)), route=pa.array(_known(anchor)))

        for b, at, _, g in _grams(batches, 2, span, gram):
            rows, key = pa.array(at + g.rows), g.keys()
            yield table(grp=b.column(0).take(rows).cast(pa.string()), id=b.column(1).take(rows), k=codes.binaries(key), n_words=pa.array(g.n.astype(np.int32)))
            fresh = np.zeros(len(key), bool)
            fresh[codes.distinct_pairs(key)[0]] = True
            names = key.tolist()
            fresh &= np.array([x not in seen for x in names], bool)
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(x for x, f in zip(names, fresh.tolist(), strict=True) if f)
            on = fresh[g.local]
            held.append((g.anchor[on], key[g.local[on]]))
            size += int(on.sum())
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return run


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, k) of the anchors of a partition that stand in texts of several keys; a partition has about ``TASK_ANCHORS``."""
    got = [(codes.signed(b.column(0).to_numpy(zero_copy_only=False)).view(np.uint64), codes.pairs_of(b.column(1)), b.column(2).to_numpy(zero_copy_only=False)) for b in batches]
    if not got:
        return
    anchor, k, route = (np.concatenate([g[i] for g in got]) for i in range(3))
    passed = route == PASS
    a, key = _distinct(anchor[~passed], k[~passed])
    several = np.searchsorted(a, a, side="right") - np.searchsorted(a, a) > 1
    a, key = np.concatenate([a[several], anchor[passed]]), np.concatenate([key[several], k[passed]])
    yield pa.RecordBatch.from_arrays([pa.array(codes.signed(a)), codes.binaries(key)], names=["anchor", "k"])


def _stretches(span: int, gram: int):
    """(anchor, k, first word, words) of the texts (k, anchors, text): the words of all spans of each recurring anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, at, part, g in _grams(batches, 2, span, gram):
            lists = b.column(1)
            text = part.to_pylist()
            out: list[tuple] = []
            cut = np.searchsorted(g.local, np.arange(len(g.rows) + 1))
            for i, r in enumerate(g.rows.tolist()):
                want = np.array(lists[at + r].as_py(), np.int64).view(np.uint64)
                s, e = cut[i], cut[i + 1]
                hit = np.isin(g.anchor[s:e], want)
                words = text[r].split()
                key = b.column(0)[at + r].as_py()
                first = g.first[i]
                for a, lo, hi in zip(codes.signed(g.anchor[s:e][hit]).tolist(), (g.low[s:e][hit] - first).tolist(), (g.high[s:e][hit] - first).tolist(), strict=True):
                    out.append((a, key, lo, " ".join(words[lo : hi + span])))
            cols = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.int32(), pa.string()), strict=True)], names=["anchor", "k", "first", "words"])

    return run


OCCURRENCE = "class binary, k binary, lo int, hi int"
Found = tuple[bytes, bytes, int, int]  # class, key, first and last word at which a span of the class starts


def _automaton(spans: list[tuple[int, ...]]):  # noqa: ANN202
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, p in enumerate(spans):
        a.add_word(p, i)
    a.make_automaton()
    return a


def _digest(parts: list[bytes]) -> bytes:
    return codes.digest(b"".join(parts))


def locate(stretches: list[tuple[bytes, int, str]], span: int) -> list[Found]:
    """The classes of all spans that stand in stretches of at least two keys, and where they start.

    ``stretches``: (key, first word, words), all those of the anchors they hold.
    """
    numbers: dict[str, int] = {}
    seqs = [(k, first, tuple([numbers.setdefault(w, len(numbers)) for w in words.split(" ")])) for k, first, words in stretches]
    holder: dict[tuple[int, ...], bytes] = {}
    confirmed: set[tuple[int, ...]] = set()
    for k, _, seq in seqs:
        for i in range(len(seq) - span + 1):
            p = seq[i : i + span]
            if holder.setdefault(p, k) != k:
                confirmed.add(p)
    if not confirmed:
        return []
    spans = list(confirmed)
    automaton = _automaton(spans)
    hits = [[(end - span + 1, which) for end, which in automaton.iter(seq)] for _, _, seq in seqs]
    keys: list[set[bytes]] = [set() for _ in spans]
    for (k, _, _), hit in zip(seqs, hits, strict=True):
        for _, which in hit:
            keys[which].add(k)
    names: dict[frozenset, bytes] = {}
    label = []
    for s in keys:
        f = frozenset(s)
        if f not in names:
            names[f] = _digest(sorted(f))
        label.append(names[f])
    found: list[Found] = []
    for (k, first, _), hit in zip(seqs, hits, strict=True):
        last = None
        for at, which in hit:
            if last and last[0] == label[which] and last[2] == at - 1:
                last[2] = at
            else:
                last = [label[which], at, at]
                found.append((k, first, last))
    return [(c, k, first + lo, first + hi) for k, first, (c, lo, hi) in found]


def locate_confirmed(stretches: list[tuple[bytes, int, str]], spans: list[str], span: int) -> Iterator[Found]:
    """The same for one share of a hot anchor: ``spans`` are those of its spans that are known to stand in several texts; each is a class."""
    for c in range(0, len(spans), SHARD_SPANS):
        part = spans[c : c + SHARD_SPANS]
        numbers: dict[str, int] = {}
        automaton = _automaton([tuple([numbers.setdefault(w, len(numbers)) for w in p.split(" ")]) for p in part])
        label = [codes.digest(p.encode("utf-8", "surrogatepass")) for p in part]
        for k, first, words in stretches:
            for end, which in automaton.iter(tuple([numbers.get(w, len(numbers)) for w in words.split(" ")])):
                at = first + end - span + 1
                yield label[which], k, at, at


SPANS = "anchor bigint, words string, share int, lo binary, hi binary"


def _spans_of(span: int):
    """(anchor, words, share, least and greatest key) of the spans of the stretches of hot anchors, once a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[tuple[int, str, int], list[bytes]] = {}
            for anchor, share, k, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = words.split(" ")
                for i in range(len(w) - span + 1):
                    ends = held.setdefault((anchor, " ".join(w[i : i + span]), share), [k, k])
                    ends[0], ends[1] = min(ends[0], k), max(ends[1], k)
            rows = [(*key, *ends) for key, ends in held.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["anchor", "words", "share", "lo", "hi"])

    return run


def _locate(span: int):
    """Shards of whole anchors, and shares of hot ones, from rows (anchor, share, k, first, words) sorted by anchor and share.

    A share of 0 or more is one of a hot anchor; its confirmed spans, rows without key, come before its stretches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[Found]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.int32(), pa.int32()), strict=True)], names=["class", "k", "lo", "hi"])

        shard: list[tuple] = []
        spans = 0
        last, group, confirmed = None, [], []

        def close() -> list[Found]:
            nonlocal shard, spans
            if last and last[1] >= 0:
                return list(locate_confirmed(group, confirmed, span))
            if any(k != group[0][0] for k, _, _ in group[1:]):
                shard += group
                spans += 8 * len(group)
            if spans < SHARD_SPANS:
                return []
            got, shard, spans = locate(shard, span), [], 0
            return got

        for b in batches:
            for anchor, share, k, first, words in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (anchor, share) != last:
                    got = close()
                    if got:
                        yield table(got)
                    last, group, confirmed = (anchor, share), [], []
                if k is None:
                    confirmed.append(words)
                else:
                    group.append((k, first, words))
        got = close()
        yield table(got + locate(shard, span))

    return run


def occurrences(texts: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(occurrences, members) of ``texts`` (grp, id, text): occurrences (class, k, lo, hi) of the spans that stand in texts
    of at least two keys (a span of the class starts at each word from lo to hi), members (grp, id, k, n_words) of the
    texts that are long enough.

    Shuffles: anchors (about one in seven words, of an anchor frequent in a task only two), the texts that hold recurring
    anchors, their stretches; the spans of hot anchors.  AQE splits hot join keys, hot anchors are spread by record.
    """
    if gram > span:
        raise ValueError("gram must not exceed span")
    rows = texts.selectExpr("cast(grp as string) grp", "cast(id as bigint) id", "cast(text as string) text").where("id is not null and text is not null")
    survey = written(rows.mapInArrow(_survey(span, gram), SURVEY), "span-survey")
    members = survey.where("id is not null").select("grp", "id", "k", "n_words").distinct()
    anchors = survey.where("anchor is not null").select("anchor", "k", "route")
    parts = max(partitions(texts.sparkSession), anchors.count() // TASK_ANCHORS + 1)
    spread = F.expr(f"cast(if(route = {PASS}, pmod(xxhash64(k), {parts}), pmod(route, {parts})) as int)")
    again = written(anchors.repartitionById(parts, spread).mapInArrow(_recurring, "anchor bigint, k binary"), "span-anchors")
    lists = again.groupBy("k").agg(F.collect_set("anchor").alias("anchors"))
    holder = members.groupBy("k").agg(F.min(F.struct("id", "grp")).alias("m")).join(lists, "k").select("k", "anchors", "m.id", "m.grp")
    held = rows.join(holder, ["grp", "id"]).select("k", "anchors", "text")
    many = again.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_ANCHOR)
    hot = written(many.select("anchor", F.ceil(F.col("n") / HOT_ANCHOR).cast("int").alias("shares")), "span-hot")
    pieces = held.mapInArrow(_stretches(span, gram), "anchor bigint, k binary, first int, words string").join(hot, "anchor", "left")
    pieces = pieces.withColumn("share", F.coalesce(F.expr("cast(pmod(xxhash64(k), shares) as int)"), F.lit(-1))).select("anchor", "share", "k", "first", "words")
    if not hot.isEmpty():
        pieces = written(pieces, "span-pieces")
        each = pieces.where("share >= 0").select("anchor", "share", "k", "words").mapInArrow(_spans_of(span), SPANS)
        known = each.groupBy("anchor", "words").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set("share").alias("shares")).where("lo <> hi")
        pieces = pieces.unionByName(known.select("anchor", F.explode("shares").alias("share"), F.lit(None).cast("binary").alias("k"), F.lit(None).cast("int").alias("first"), "words"))
    routed = pieces.repartition("anchor", "share").sortWithinPartitions("anchor", "share", F.col("k").isNotNull())
    found = written(routed.mapInArrow(_locate(span), OCCURRENCE), "span-found")
    return found, members


def item_pairs(found: DataFrame, members: DataFrame) -> DataFrame:
    """(a_id, b_id) of different records that share a span, the smaller id first; equal texts count, any group against any."""
    once = found.select("class", "k").distinct()
    keys = once.join(once.withColumnRenamed("k", "k2"), "class").where("k < k2").select("k", "k2").distinct()
    own = members.select("k", "id").distinct()
    across = keys.join(own.withColumnRenamed("id", "x"), "k").join(own.withColumnsRenamed({"id": "y", "k": "k2"}), "k2").where("x <> y").select("x", "y")
    copies = own.withColumnRenamed("id", "x").join(own.withColumnRenamed("id", "y"), "k").where("x < y").select("x", "y")
    return across.unionByName(copies).select(F.least("x", "y").alias("a_id"), F.greatest("x", "y").alias("b_id")).distinct()


def _placed(found: DataFrame, members: DataFrame) -> DataFrame:
    """(class, grp, id, lo, hi) of the spans that stand in at least two records: least and greatest record of each class from
    those of its texts, and only then the texts' records."""
    ends = members.groupBy("k").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    several = found.select("class", "k").join(ends, "k").groupBy("class").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("class")
    return found.join(several, "class", "left_semi").join(members.select("grp", "id", "k"), "k").select("class", "grp", "id", "lo", "hi")


def _copied(members: DataFrame) -> DataFrame:
    """(k, copied) of the texts that several records hold as they are."""
    return members.groupBy("k").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("k", F.lit(True).alias("copied"))


def _reached(found: DataFrame, members: DataFrame, span: int) -> tuple[DataFrame, Window]:
    """(grp, id, lo, hi, reach): stretches of words lo..hi of each text in order, and the end of those before."""
    order = Window.partitionBy("grp", "id").orderBy("lo", "hi")
    at = _placed(found, members).select("grp", "id", "lo", (F.col("hi") + span).alias("hi"))
    return at.withColumn("reach", F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))), order


def shared_words(found: DataFrame, members: DataFrame, span: int = SPAN) -> DataFrame:
    """(grp, id, n_words, shared_words, share) of every text that is long enough; a text that other records hold as it is counts whole."""
    part, _ = _reached(found, members, span)
    gain = F.greatest(F.lit(0), F.col("hi") - F.greatest("lo", F.coalesce("reach", "lo")))
    part = part.groupBy("grp", "id").agg(F.sum(gain).alias("some"))
    all_ = members.join(_copied(members), "k", "left").join(part, ["grp", "id"], "left")
    n = F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("some", F.lit(0))).cast("bigint")
    return all_.select("grp", "id", "n_words", n.alias("shared_words"), (n / F.col("n_words")).alias("share"))


def classes(found: DataFrame, members: DataFrame, span: int = SPAN) -> DataFrame:
    """(class, grp, id, first_word, n_words): the compact form of what is shared, each class of passages with its members and
    where they hold it; texts that several records hold as they are form classes of their own."""
    inside = _placed(found, members).distinct().select(F.lower(F.hex("class")).alias("class"), "grp", "id", F.col("lo").alias("first_word"), (F.col("hi") - F.col("lo") + span).alias("n_words"))
    whole = members.join(_copied(members), "k").select(F.lower(F.hex("k")).alias("class"), "grp", "id", F.lit(0).alias("first_word"), "n_words")
    return inside.unionByName(whole)


def passages(found: DataFrame, members: DataFrame, texts: DataFrame, span: int = SPAN) -> DataFrame:
    """(grp, id, first_word, n_words, passage): the stretches of each text made of spans that stand in another record's text;
    a text that other records hold as it is gives one passage, the whole."""
    at, order = _reached(found, members, span)
    at = at.withColumn("isle", F.sum(F.coalesce((F.col("lo") > F.col("reach")).cast("int"), F.lit(1))).over(order))
    runs = at.groupBy("grp", "id", "isle").agg(F.min("lo").alias("first_word"), (F.max("hi") - F.min("lo")).cast("int").alias("n_words")).drop("isle")
    whole = members.join(_copied(members), "k").select("grp", "id", F.lit(0).alias("first_word"), "n_words")
    runs = runs.join(whole, ["grp", "id"], "left_anti").select("grp", "id", "first_word", "n_words").unionByName(whole)
    # where the passages of a text are is small beside it: written, so that Spark broadcasts it if it is small at all
    places = written(runs.groupBy("grp", "id").agg(F.collect_list(F.struct("first_word", "n_words")).alias("runs")), "span-places")
    words = texts.select(F.col("grp").cast("string").alias("grp"), F.col("id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null").join(places, ["grp", "id"])
    words = words.select("grp", "id", F.split(F.trim(F.regexp_replace("text", SPACE, " ")), " ").alias("words"), F.explode("runs").alias("r"))
    return words.select("grp", "id", "r.first_word", "r.n_words", F.array_join(F.slice("words", F.col("r.first_word") + 1, F.col("r.n_words")), " ").alias("passage"))

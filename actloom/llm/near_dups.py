"""Near-duplicate records: multiset word similarity of at least a threshold, found without comparing all pairs.

Method: signature trees.  A text's words, numbered by occurrence, form a set; texts whose sets reach the threshold share
one of their rarest elements (prefix bound), so texts are routed by those elements in columnar blocks.  The texts of one
element form a signature tree: leaves of texts in order of size, nodes with the OR of their word bitmaps, size ranges
and the largest slack; a dual traversal drops every pair of nodes whose maximum possible overlap is too small, and the
same bound drops pairs of texts in the leaves.  What is left is verified on the words themselves.

Rarest means rarest by counts of all elements, kept in a sketch of ``BUCKETS`` counters (any total order gives the same
result; the sketch only makes it a good one).  An element that counts more than ``HOT_ELEMENT`` texts does not route by
itself: texts that share it as their first common element share a second one next to it (prefix bound plus one), so they
are routed by both, which keeps groups small as the collection grows.  Texts of ``LONG_TEXT`` words and more, which have
too many such pairs, are routed by single elements, as are shorter ones that such a text could still match.

The result is exact: no link is lost.  An element held by more than ``HOT_BUCKET`` texts of a task is cut into blocks whose
pairs, if their sizes fit, are spread over all tasks.

Defined cases: null and short texts (under ``min_words`` words) have no links; texts with equal word multisets are one
text with several members (two independent 64-bit sums say which are); a text may be of any length; rows without id are
left out; letters are folded one by one, so a word has the same letters in every step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actloom.llm import codes
from actloom.runtime import partitions, written

#: counters of the sketch of element counts; what is broadcast of it is 4 bytes each
BUCKETS = 1 << 20
SIG = 3  # 64-bit words of a bitmap
LEAF, FAN = 64, 8
FLUSH_TEXTS = 20_000
#: texts that hold an element beyond which it routes together with a second one only, and words from which on texts do not do that
HOT_ELEMENT, LONG_TEXT = 20_000, 128
#: texts that share one element beyond which the element's work is cut into block pairs
HOT_BUCKET = 20_000
#: routed elements of one task
TASK_ELEMENTS = 1_000_000


def by_row(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order of (row, leading 44 bits of the key) by one sort of single numbers; a batch has fewer than 2**20 rows."""
    return np.argsort((row.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20)))


class Sets:
    """Numbered word sets of a slice of texts: ``elem`` by row, rows that are long enough only."""

    def __init__(self, text: pa.Array, salt: np.ndarray, min_words: int) -> None:
        h, row = codes.words(text)
        n = np.bincount(row, minlength=len(text))
        keep = n[row] >= max(1, min_words)
        h, row = h[keep], row[keep]
        order = by_row(row, h)
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        nth = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
        with np.errstate(over="ignore"):
            self.elem = codes.mix(h + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + salt[row])
        self.rows, self.at, self.n = np.unique(row, return_index=True, return_counts=True)
        self.local = np.repeat(np.arange(len(self.rows)), self.n)
        self.key = np.zeros(len(self.at), codes.PAIR)
        if len(self.at):
            with np.errstate(over="ignore"):
                self.key["x"] = np.add.reduceat(codes.mix(self.elem), self.at)
                self.key["y"] = np.add.reduceat(codes.mix(self.elem ^ np.uint64(0xA5A5A5A55A5A5A5A)), self.at)


def _salt(b: pa.RecordBatch) -> np.ndarray:
    grp = b.column(0).cast(pa.string()).dictionary_encode()
    names = [int.from_bytes(hashlib.blake2b((v or "").encode(), digest_size=8).digest(), "little") for v in [*grp.dictionary.to_pylist(), None]]
    at = grp.indices.fill_null(len(names) - 1).to_numpy(zero_copy_only=False)
    return np.array(names, np.uint64)[at]


def _sets(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[tuple[pa.RecordBatch, int, Sets]]:
    """Batches have the columns grp, id, text."""
    for b in batches:
        salt = _salt(b)
        for at, part in codes.slices(b.column(2).cast(pa.string())):
            yield b, at, Sets(part, salt[at : at + len(part)], min_words)


SURVEY = "grp string, id bigint, k binary, size bigint, bucket int, n bigint"


def _survey(min_words: int):
    """One pass for the members (grp, id, k, size) and the sketch of element counts (bucket, n) of a task."""

    def table(**cols: pa.Array) -> pa.RecordBatch:
        n = len(next(iter(cols.values())))
        types = {"grp": pa.string(), "id": pa.int64(), "k": pa.binary(), "size": pa.int64(), "bucket": pa.int32(), "n": pa.int64()}
        return pa.RecordBatch.from_arrays([cols.get(c, pa.nulls(n, t)) for c, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for b, at, s in _sets(batches, min_words):
            counts += np.bincount(_bucket(s.elem), minlength=BUCKETS)
            rows = pa.array(at + s.rows)
            yield table(grp=b.column(0).take(rows).cast(pa.string()), id=b.column(1).take(rows), k=codes.binaries(s.key), size=pa.array(s.n.astype(np.int64)))
        some = np.flatnonzero(counts)
        yield table(bucket=pa.array(some.astype(np.int32)), n=pa.array(counts[some]))

    return run


def _bucket(elem: np.ndarray) -> np.ndarray:
    return (elem % np.uint64(BUCKETS)).astype(np.int64)


def _pack_block(k: np.ndarray, n: np.ndarray, sig: np.ndarray, bk: np.ndarray, idx: np.ndarray) -> bytes:
    head = np.array([len(k), len(bk)], np.int64)
    return b"".join(x.tobytes() for x in (head, k, n.astype(np.uint32), sig, bk.astype(np.uint32), idx.astype(np.uint16 if len(k) < 65536 else np.uint32)))


def _unpack_block(raw: bytes) -> tuple[np.ndarray, ...]:
    m, r = (int(x) for x in np.frombuffer(raw, np.int64, 2))
    at, out = 16, []
    for dtype, count in ((codes.PAIR, m), (np.uint32, m), (np.uint64, m * SIG), (np.uint32, r), (np.uint16 if m < 65536 else np.uint32, r)):
        out.append(np.frombuffer(raw, dtype, count, at))
        at += out[-1].nbytes
    k, n, sig, bk, idx = out
    return k, n.astype(np.int64), sig.reshape(m, SIG), bk, idx.astype(np.int64)


def prefix_length(n: np.ndarray, t: float) -> np.ndarray:
    """Elements of a text of which a partner of any size must hold one."""
    return n - np.ceil(t * n - 1e-9).astype(np.int64) + 1


def index_length(n: np.ndarray, t: float) -> np.ndarray:
    """Elements of a text of which a partner that is no smaller must hold one: the first common element stands among them."""
    return n - np.ceil(2 * t / (1 + t) * n - 1e-9).astype(np.int64) + 1


def in_order(local: np.ndarray, elem: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order of the elements of each text, the rarest first: by count, then by hash."""
    level = np.floor(np.log2(1.0 + counts) * 64).astype(np.uint64)
    key = (level << np.uint64(52)) | (elem >> np.uint64(12))
    order = by_row(local, key)
    k = ((local.astype(np.uint64) << np.uint64(44)) | (key >> np.uint64(20)))[order]
    if (k[1:] == k[:-1]).any():
        order = np.lexsort((elem, key, local))
    return order


def routes(elem: np.ndarray, local: np.ndarray, place: np.ndarray, n: np.ndarray, hot: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, text, early) by which texts are routed, from their elements in order; ``n``: sizes of the texts, ``hot``: elements that count too many texts."""
    head = place < prefix_length(n, t)[local]
    early = place < index_length(n, t)[local]
    # by single elements: rare ones; hot ones of long texts, of texts that a long one could match, and of texts that one common element makes similar
    alone = head & (~hot | (n[local] >= t * LONG_TEXT - 1e-6) | (np.ceil(t * n - 1e-9) < 2)[local])
    codes_, texts, firsts = [elem[alone]], [local[alone]], [early[alone]]
    first = np.flatnonzero(head & hot & (n[local] < LONG_TEXT))
    if len(first):
        # the second stands behind the first, at most one place beyond the prefix
        last = np.minimum(prefix_length(n, t), n - 1)[local[first]]
        many = last - place[first]
        i = np.repeat(first, many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        with np.errstate(over="ignore"):
            codes_.append(codes.mix(elem[i] * np.uint64(3) + codes.mix(elem[j])))
        texts.append(local[i])
        firsts.append(early[i])
    return np.concatenate(codes_), np.concatenate(texts), np.concatenate(firsts)


def _route(sketch, t: float, min_words: int, parts: int):  # noqa: ANN001
    """Blocks (part, block) of texts with their rarest elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        seen: set[tuple[int, int]] = set()
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            k, n, sig = (np.concatenate([h[i] for h in held]) for i in range(3))
            shift = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])])
            elem = np.concatenate([h[3] for h in held])
            idx = np.concatenate([h[4] + o for h, o in zip(held, shift, strict=False)])
            early = np.concatenate([h[5] for h in held])
            part = (elem % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((elem, part))
            # the code of an element and, as its last bit, whether it is early in the text
            code = ((elem >> np.uint64(32)) & ~np.uint64(1)) | early
            code, idx, part = code[order], idx[order], part[order]
            edge = np.searchsorted(part, np.arange(parts + 1))
            ids, blobs = [], []
            for p in np.flatnonzero(np.diff(edge)).tolist():
                a, b = edge[p], edge[p + 1]
                own, inv = np.unique(idx[a:b], return_inverse=True)
                ids.append(p)
                blobs.append(_pack_block(k[own], n[own], sig[own], code[a:b], inv))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "block"])

        for _, _, s in _sets(batches, min_words):
            fresh = np.zeros(len(s.key), bool)
            fresh[codes.distinct_pairs(s.key)[0]] = True
            keys = s.key.tolist()
            if seen:
                fresh &= np.array([x not in seen for x in keys], bool)
            if len(seen) > 1_000_000:
                seen.clear()
            seen.update(x for x, f in zip(keys, fresh.tolist(), strict=True) if f)
            if not fresh.any():
                continue
            new = np.cumsum(fresh) - 1
            on = fresh[s.local]
            elem, local = s.elem[on], new[s.local[on]]
            n = s.n[fresh]
            bits = np.zeros((len(n), SIG * 64), np.uint8)
            bits[local, (elem >> np.uint64(7)) % np.uint64(SIG * 64)] = 1
            sig = np.packbits(bits, axis=1).view(np.uint64)
            count = counts[_bucket(elem)]
            order = in_order(local, elem, count)
            elem, local, hot = elem[order], local[order], count[order] > HOT_ELEMENT
            place = np.arange(len(elem)) - np.concatenate([[0], np.cumsum(n)[:-1]])[local]
            held.append((s.key[fresh], n, sig, *routes(elem, local, place, n, hot, t)))
            size += len(n) + len(held[-1][3]) // 64
            if size >= FLUSH_TEXTS:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


class Tree:
    """A signature tree over texts in order of size: levels of (OR bitmap, least size, largest size, largest slack)."""

    def __init__(self, k: np.ndarray, n: np.ndarray, sig: np.ndarray) -> None:
        order = np.lexsort((sig[:, 0], n))
        leaves = -(-len(n) // LEAF)
        pad = leaves * LEAF - len(n)
        self.k = np.concatenate([k[order], np.zeros(pad, np.int64)])
        sig = np.concatenate([sig[order], np.zeros((pad, SIG), np.uint64)])
        slack = n[order] - np.bitwise_count(sig[: len(n)]).sum(1).astype(np.int64)
        self.n = np.concatenate([n[order], np.full(pad, n.max(initial=0))]).astype(np.int32).reshape(leaves, LEAF)
        self.slack = np.concatenate([slack, np.full(pad, -(1 << 28))]).astype(np.int32).reshape(leaves, LEAF)
        self.sig = [np.ascontiguousarray(sig[:, w].reshape(leaves, LEAF)) for w in range(SIG)]
        level = (np.stack([np.bitwise_or.reduce(s, 1) for s in self.sig], 1), self.n.min(1), self.n.max(1), self.slack.max(1))
        self.levels = [level]
        while len(level[1]) > FAN:
            cut = np.arange(0, len(level[1]), FAN)
            level = (np.bitwise_or.reduceat(level[0], cut, 0), np.minimum.reduceat(level[1], cut), np.maximum.reduceat(level[2], cut), np.maximum.reduceat(level[3], cut))
            self.levels.append(level)


def _possible(x: tuple, y: tuple, i: np.ndarray, j: np.ndarray, t: float) -> np.ndarray:
    """Whether a text of node i and one of node j could reach the threshold, by size ranges and maximum overlap."""
    ok = (x[2][i] >= t * y[1][j] - 1e-6) & (y[2][j] >= t * x[1][i] - 1e-6)
    overlap = np.minimum(x[3][i], y[3][j]) + np.bitwise_count(x[0][i] & y[0][j]).sum(1)
    return ok & (overlap >= t / (1 + t) * (x[1][i] + y[1][j]) - 1e-6)


def dual_traversal(a: Tree, b: Tree | None, t: float, ordered: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of texts of two trees (of one tree, if b is None) that pass the bound; ``ordered``: the first no larger than the second."""
    same = b is None
    b = a if same else b
    depth = max(len(a.levels), len(b.levels)) - 1
    la, lb = min(depth, len(a.levels) - 1), min(depth, len(b.levels) - 1)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[la][1])), np.arange(len(b.levels[lb][1])), indexing="ij"))
    while True:
        if same:
            keep = i <= j
            i, j = i[keep], j[keep]
        keep = _possible(a.levels[la], b.levels[lb], i, j, t)
        if ordered:
            keep &= a.levels[la][1][i] <= b.levels[lb][2][j]
        i, j = i[keep], j[keep]
        if la == 0 and lb == 0:
            break
        if la > 0:
            i, j = np.repeat(i, FAN) * FAN + np.tile(np.arange(FAN), len(i)), np.repeat(j, FAN)
            la -= 1
            i, j = i[i < len(a.levels[la][1])], j[i < len(a.levels[la][1])]
        if lb > 0:
            i, j = np.repeat(i, FAN), np.repeat(j, FAN) * FAN + np.tile(np.arange(FAN), len(j))
            lb -= 1
            i, j = i[j < len(b.levels[lb][1])], j[j < len(b.levels[lb][1])]
    left, right = [], []
    r = t / (1 + t)
    low, high = a.levels[0], b.levels[0]
    need = np.clip(np.ceil(r * (low[1][i] + high[1][j]) - np.minimum(low[3][i], high[3][j]) - 1e-3), 0, 255).astype(np.uint8)
    for c in range(0, len(i), 16):
        p, q = i[c : c + 16], j[c : c + 16]
        shared = np.bitwise_count(a.sig[0][p][:, :, None] & b.sig[0][q][:, None, :])
        for w in range(1, SIG):
            shared += np.bitwise_count(a.sig[w][p][:, :, None] & b.sig[w][q][:, None, :])
        # the leaves' common bound in bytes first, the pair's own bound for what is left
        flat = np.flatnonzero(shared >= need[c : c + 16, None, None])
        if len(flat):
            x, y, z = np.unravel_index(flat, shared.shape)
            x, y, s1, s2 = p[x], y, a.slack[p[x], y], b.slack[q[x], z]
            v = j[c + flat // (LEAF * LEAF)]
            n1, n2 = a.n[x, y], b.n[v, z]
            fit = (np.minimum(s1, s2) + shared.ravel()[flat] >= r * (n1 + n2) - 1e-3) & (np.minimum(n1, n2) >= t * np.maximum(n1, n2) - 1e-6)
            if same:
                fit &= (x < v) | (y < z)
            if ordered:
                fit &= n1 <= n2
            left.append(a.k[x[fit] * LEAF + y[fit]])
            right.append(b.k[v[fit] * LEAF + z[fit]])
    if not left:
        e = np.zeros(0, np.int64)
        return e, e
    left, right = np.concatenate(left), np.concatenate(right)
    keep = left != right
    return np.minimum(left, right)[keep], np.maximum(left, right)[keep]


Texts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # number, size, bitmap, whether the element is early


def bucket_pairs(x: Texts, y: Texts | None, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of texts of one element: the smaller of a pair holds it early, so pairs of two late holders are left out."""
    (xa, xc), (ya, yc) = ([Tree(*(c[on] for c in s[:3])) if on.any() else None for on in (s[3], ~s[3])] for s in (x, y or x))
    if xa and (y is None or ya):
        yield dual_traversal(xa, None if y is None else ya, t)
    if xa and yc:
        yield dual_traversal(xa, yc, t, ordered=True)
    if y is not None and ya and xc:
        yield dual_traversal(ya, xc, t, ordered=True)


PAIRS = "a binary, b binary, x binary, y binary"


def _pairs(k: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """The pairs of numbers as pairs of keys, the smaller key first."""
    a, b = k[left], k[right]
    swap = (a["x"] > b["x"]) | ((a["x"] == b["x"]) & (a["y"] > b["y"]))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    void = pa.nulls(len(a), pa.binary())
    return pa.RecordBatch.from_arrays([codes.binaries(a), codes.binaries(b), void, void], names=["a", "b", "x", "y"])


def _unit(x: bytes, y: bytes) -> pa.RecordBatch:
    void = pa.nulls(1, pa.binary())
    return pa.RecordBatch.from_arrays([void, void, pa.array([x], pa.binary()), pa.array([y], pa.binary())], names=["a", "b", "x", "y"])


def _join(t: float):
    """All pairs that pass the bound in the elements of a partition; block pairs (x, y) of hot elements for another round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [_unpack_block(x) for b in batches for x in b.column(1).to_pylist()]
        if not got:
            return
        shift = np.concatenate([[0], np.cumsum([len(g[0]) for g in got])])
        k, n, sig = (np.concatenate([g[i] for g in got]) for i in range(3))
        bk = np.concatenate([g[3] for g in got])
        idx = np.concatenate([g[4] + o for g, o in zip(got, shift, strict=False)])
        del got
        first, inv = codes.distinct_pairs(k)
        k, n, sig, idx = k[first], n[first], sig[first], inv[idx]
        # a text may hold two elements of one code; early in one is early
        order = np.lexsort((~bk & 1, idx, bk >> 1))
        bk, idx, early = bk[order] >> 1, idx[order], (bk[order] & 1).astype(bool)
        once = np.ones(len(bk), bool)
        once[1:] = (bk[1:] != bk[:-1]) | (idx[1:] != idx[:-1])
        bk, idx, early = bk[once], idx[once], early[once]
        edge = np.append(np.flatnonzero(np.concatenate([[True], bk[1:] != bk[:-1]])), len(bk))
        held, size = [], 0

        def table() -> pa.RecordBatch:
            both = np.unique(np.concatenate([h[0] * len(k) + h[1] for h in held]))
            return _pairs(k, both // len(k), both % len(k))

        for s, e in zip(edge[:-1], edge[1:], strict=True):
            if e - s < 2:
                continue
            own, on = idx[s:e], early[s:e]
            if not on.any():
                continue
            if e - s > HOT_BUCKET:
                by = np.argsort(n[own], kind="stable")
                own, on = own[by], on[by]
                cut = [slice(c, c + HOT_BUCKET // 2) for c in range(0, len(own), HOT_BUCKET // 2)]
                packed = [_pack_block(k[own[c]], n[own[c]], sig[own[c]], on[c], np.arange(len(own[c]))) for c in cut]
                for i, x in enumerate(cut):
                    for j, y in enumerate(cut[i:], i):
                        if n[own[x][-1]] >= t * n[own[y][0]] - 1e-6:
                            yield _unit(packed[i], b"" if i == j else packed[j])
                continue
            for a, b in bucket_pairs((own, n[own], sig[own], on), None, t):
                if len(a):
                    held.append((a, b))
                    size += len(a)
            if size > 500_000:
                yield table()
                held, size = [], 0
        if held:
            yield table()

    return run


def _join_units(t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                k, n, sig, on, idx = _unpack_block(x)
                left, right = (idx, n[idx], sig[idx], on.astype(bool)), None
                if y:
                    k2, n, sig, on, idx = _unpack_block(y)
                    right = (idx + len(k), n[idx], sig[idx], on.astype(bool))
                    k = np.concatenate([k, k2])
                for a, c in bucket_pairs(left, right, t):
                    yield _pairs(k, a, c).select([0, 1])

    return run


def similarities(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Sum of the smaller word counts over sum of the larger, for each pair of texts; texts without a word count as equal to each other."""
    x, y = (Sets(t, np.zeros(len(t), np.uint64), 1) for t in (a, b))
    row = np.concatenate([x.rows[x.local], y.rows[y.local]])
    elem = np.concatenate([x.elem, y.elem])
    order = np.lexsort((elem, row))
    row, elem = row[order], elem[order]
    low = np.bincount(row[1:][(row[1:] == row[:-1]) & (elem[1:] == elem[:-1])], minlength=len(a))
    high = np.bincount(row, minlength=len(a)) - low
    return np.where(high > 0, low / np.maximum(1, high), 1.0)


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        left, right = (b.column(i).cast(pa.string()) for i in (2, 3))
        for at, part in codes.slices(left):
            s = similarities(part, right.slice(at, len(part)))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), b.column(1).slice(at, len(part)), pa.array(s, pa.float64())], names=["a", "b", "score"])


def near_links(texts: DataFrame, threshold: float = 0.8, min_words: int = 1) -> tuple[DataFrame, DataFrame]:
    """(links, members) of ``texts`` (grp, id, text): links (a, b, score) between keys of different word multisets of one
    group, members (grp, id, k) of every text that is long enough.

    Shuffles: the sketch (partial sums), the columnar blocks, the surviving pairs, and the texts of those pairs, which are
    fetched by their ids (written first, so that Spark broadcasts them if they are few).
    """
    spark = texts.sparkSession
    rows = texts.selectExpr("cast(grp as string) grp", "cast(id as bigint) id", "cast(text as string) text").where("id is not null and text is not null")
    survey = written(rows.mapInArrow(_survey(min_words), SURVEY), "near-survey")
    counted = survey.where("bucket is not null").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS, np.float32)
    counts[counted["bucket"].to_numpy(np.int64)] = counted["n"].to_numpy(np.float32)
    members = survey.where("k is not null").select("grp", "id", "k").distinct()
    total = survey.where("k is not null").agg(F.sum("size")).first()[0] or 0
    parts = max(partitions(spark), int(total * (1 - threshold)) // TASK_ELEMENTS + 1)
    blocks = rows.mapInArrow(_route(spark.sparkContext.broadcast(counts), threshold, min_words, parts), "part int, block binary").repartitionById(parts, F.col("part"))
    joined = written(blocks.mapInArrow(_join(threshold), PAIRS), "near-pairs")
    more = joined.where("x is not null").select("x", "y").repartition(parts).mapInArrow(_join_units(threshold), "a binary, b binary")
    pairs = written(joined.where("a is not null").select("a", "b").unionByName(more).distinct(), "near-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    holder = written(members.groupBy("k").agg(F.min(F.struct("id", "grp")).alias("m")).join(ends, "k", "left_semi").select("k", "m.id", "m.grp"), "near-holders")
    own = written(rows.join(holder, ["grp", "id"]).select("k", "text").dropDuplicates(["k"]), "near-texts")
    both = pairs.join(own.withColumnsRenamed({"k": "a", "text": "ta"}), "a").join(own.withColumnsRenamed({"k": "b", "text": "tb"}), "b")
    links = both.select("a", "b", "ta", "tb").mapInArrow(_exact, "a binary, b binary, score double").where(F.col("score") >= threshold - 1e-12)
    return written(links, "near-links"), members


def expanded(links: DataFrame, members: DataFrame) -> DataFrame:
    """(grp, a_id, b_id) of all linked rows, copies included; the smaller id first."""
    left = members.select("grp", F.col("id").alias("x"), F.col("k").alias("a"))
    right = members.select(F.col("grp").alias("g2"), F.col("id").alias("y"), F.col("k").alias("b"))
    across = links.join(left, "a").join(right, "b").select("grp", "x", "y")
    copies = left.join(right, (F.col("a") == F.col("b")) & (F.col("grp") == F.col("g2")) & (F.col("x") < F.col("y"))).select("grp", "x", "y")
    return across.unionByName(copies).select("grp", F.least("x", "y").alias("a_id"), F.greatest("x", "y").alias("b_id"))


def components(links: DataFrame) -> DataFrame:
    """(k, root) of every linked key, the root the smallest key reachable: large stars and small stars in turn, so that the
    rounds, each written, grow with the logarithm of the longest chain and not with its length."""
    stars = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "stars")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
    before = mark(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = written(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(least.select("u", F.col("m").alias("v")))
        stars = written(small.distinct(), "stars")
        now = mark(stars)
        if now == before:
            return stars.select(F.col("u").alias("k"), F.col("v").alias("root"))
        before = now


def classes(links: DataFrame, members: DataFrame) -> DataFrame:
    """(grp, id, class_id, n_links): one row a text; the class is the smallest id reachable over links, n_links the
    linked texts of other wording."""
    rooted = members.join(components(links), "k", "left").withColumn("root", F.coalesce("root", "k"))
    first = rooted.groupBy("grp", "root").agg(F.min("id").alias("class_id"))
    degree = links.select(F.explode(F.array("a", "b")).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    return rooted.join(first, ["grp", "root"]).join(degree, "k", "left").select("grp", "id", "class_id", F.coalesce("n", F.lit(0)).alias("n_links"))

"""Duplicates hidden by formatting: equal records up to whitespace, case, punctuation and field order.

Method: every field streams through a skip-and-fold table into a rolling polynomial hash (no canonical string is ever
built), the field hashes of a record are combined in sorted order, rows are grouped by that hash, and each row is held
against the first row of its group by a two-pointer comparison that skips separators on both sides.  Rows that only
collide are grouped again among themselves until none is left, so the result is exact.

Defined cases: a null field equals an empty one; a record without any letter or digit equals every other such record;
rows without id are left out; rows of one id are one record if they are equal, else the id belongs to the set of each of
them; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actloom.llm import codes
from actloom.runtime import written


@lru_cache(maxsize=8)
def _named(names: tuple[str, ...]) -> re.Pattern:
    return re.compile(rf"(?:^|[|\t])[^\S\t]*(?:{'|'.join(map(re.escape, names))})[^\S\t]*[=:]", re.IGNORECASE)


def parse_line(line: str | None, names: tuple[str, ...]) -> list[str]:
    """The values of the fields ``names`` of one raw record, in any order: a JSON object, or fields set apart by a bar or a
    tab, with or without names.

    Bar or tab: the one that occurs more often among those that occur no more often than the fields allow, the bar in a tie.
    Text that is none of these is a record of one field; missing fields are empty; fields beyond the last join it.
    """
    line, width = line or "", len(names)
    values: list[str] | None = None
    if line.lstrip()[:1] == "{":
        try:
            got = json.loads(line, strict=False)
            values = ["" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in got.values()]
        except (ValueError, AttributeError):
            pass
    if values is None:
        named = list(_named(names).finditer(line)) if names else []
        if named:
            ends = [m.start() for m in named[1:]] + [len(line)]
            values = [line[m.end() : e] for m, e in zip(named, ends, strict=True)]
        else:
            bars, tabs = line.count("|"), line.count("\t")
            values = line.split("\t" if tabs and (not bars or bars < tabs < width) else "|")
    if len(values) > width:
        values = [*values[: width - 1], " ".join(values[width - 1 :])]
    return values + [""] * (width - len(values))


def _fields(batch: pa.RecordBatch, first: int, names: tuple[str, ...]) -> list[pa.Array]:
    """The field columns of a batch; the column after them holds raw lines, null where the fields are given."""
    width = len(names)
    cols = [batch.column(first + i) for i in range(width)]
    lines = batch.column(first + width)
    if lines.null_count == len(lines):
        return cols
    given = [c.to_pylist() for c in cols]
    for r, line in enumerate(lines.to_pylist()):
        if line is not None:
            for i, v in enumerate(parse_line(line, names)):
                given[i][r] = v
    return [pa.array(g, pa.string()) for g in given]


def field_hashes(arr: pa.Array) -> np.ndarray:
    """One hash a row of its runs of letters and digits, from the positions the kept symbols would have."""
    out = np.zeros(len(arr), np.uint64)
    table, sep = codes.word_table(), codes.mix(np.array([codes.TOP + 7], np.uint64))[0]
    for at, part in codes.slices(arr):
        cps, off = codes.points(part)
        folded = table[cps]
        kept = folded > 0
        start, _, row = codes.runs(kept, off)
        # before each run but a row's first stands one separator
        sep_at = start[1:][row[1:] == row[:-1]] if len(start) else start
        step = kept.astype(np.int64)
        step[sep_at] += 1
        upto = np.concatenate([[0], np.cumsum(step)])
        total = int(upto[-1])
        power = codes._POW.upto(total + 1)
        with np.errstate(over="ignore"):
            value = np.where(kept, codes.mix(folded) * power[np.maximum(upto[1:] - 1, 0)], np.uint64(0))
            value[sep_at] += sep * power[upto[sep_at]]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
            a, b = off[:-1], off[1:]
            h = (sums[b] - sums[a]) * codes._INV.upto(total + 1)[upto[a]] + (upto[b] - upto[a]).astype(np.uint64)
        out[at : at + len(part)] = codes.mix(h)
    return out


def _hash_rows(names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = np.sort(np.stack([field_hashes(c) for c in _fields(b, 1, names)]), axis=0)
            key = np.zeros(len(b), np.uint64)
            with np.errstate(over="ignore"):
                for x in h:
                    key = codes.mix(key * codes.BASE + x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes.signed(key))], names=["id", "h"])

    return run


@lru_cache(maxsize=1)
def _fold() -> list[int]:
    return codes.word_table().tolist()


def same_runs(a: str, b: str) -> bool:
    """Two pointers over two texts and the fold table, each skipping what is no letter or digit; nothing is copied."""
    if a == b:
        return True
    fold, n, m = _fold(), len(a), len(b)
    i = j = 0
    begun = False
    while True:
        p, q = i, j
        while i < n and not fold[ord(a[i])]:
            i += 1
        while j < m and not fold[ord(b[j])]:
            j += 1
        if i == n or j == m:
            return i == n and j == m
        # a run that ends here on one side only
        if begun and (i > p) != (j > q):
            return False
        if fold[ord(a[i])] != fold[ord(b[j])]:
            return False
        begun = True
        i += 1
        j += 1


def same_record(a: list[str], b: list[str]) -> bool:
    """Whether the fields of two records match one to one in some order."""
    if all(same_runs(x, y) for x, y in zip(a, b, strict=True)):
        return True
    return any(all(same_runs(x, y) for x, y in zip(a, p, strict=True)) for p in permutations(b))


def _verify(names: tuple[str, ...]):
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = zip(*(c.to_pylist() for c in _fields(b, 3, names)), strict=True)
            right = zip(*(c.to_pylist() for c in _fields(b, 4 + width, names)), strict=True)
            ok = [same_record([v or "" for v in x], [v or "" for v in y]) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(ok, pa.bool_())], names=["h", "first_id", "id", "ok"])

    return run


def as_records(df: DataFrame, id_col: str, fields: list[str], line: str | None = None) -> DataFrame:
    """Columns id, f0.., line of a table of parsed fields and/or raw lines."""
    cols = [F.col(f"`{c}`").cast("string").alias(f"f{i}") for i, c in enumerate(fields)]
    raw = F.col(f"`{line}`") if line else F.lit(None)
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *cols, raw.cast("string").alias("line")).where("id is not null")


def format_duplicates(records: DataFrame, names: list[str]) -> DataFrame:
    """(first_id, copy_id) for each record but the smallest of its set; ``records`` as :func:`as_records` gives them, ``names`` the fields' names in raw lines.

    Plan: one scan writes (id, h), narrow; a partial aggregate finds the groups; the members join their group.  Only the
    texts of groups of two or more move: their ids are written, so that Spark sees their size and broadcasts them if they
    are few, else joins by shuffle, and the texts they select are written once and meet the pairs.  AQE splits the joins of
    a hot group; no group is collected.
    """
    names = tuple(names)
    todo, found = written(records.mapInArrow(_hash_rows(names), "id bigint, h bigint").distinct(), "format-hash"), None
    cols = records.columns[1:]
    while True:
        groups = todo.groupBy("h").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id")).where("first_id < last_id").drop("last_id")
        pairs = written(todo.join(groups, "h").where("id <> first_id").select("h", "first_id", "id"), "format-pairs")
        ids = written(pairs.select("id").unionByName(pairs.select(F.col("first_id").alias("id"))).distinct(), "format-ids")
        own = written(records.join(ids, "id", "left_semi").distinct(), "format-texts")
        both = pairs.join(own, "id").join(own.select(F.col("id").alias("first_id"), *[F.col(c).alias(f"a{c}") for c in cols]), "first_id")
        checked = both.select("h", "first_id", "id", *[f"a{c}" for c in cols], *cols).mapInArrow(_verify(names), "h bigint, first_id bigint, id bigint, ok boolean")
        # rows of one id: equal if any of them is
        checked = written(checked.groupBy("h", "first_id", "id").agg(F.max("ok").alias("ok")), "format-checked")
        good = checked.where("ok").select("first_id", F.col("id").alias("copy_id"))
        found = good if found is None else found.unionByName(good)
        todo = checked.where("not ok").select("id", "h")
        if todo.isEmpty():
            return found


def collapse(records: DataFrame, names: list[str]) -> DataFrame:
    """One row (id, copies) for each distinct record: its smallest id and how many ids are equal to it, itself included."""
    pairs = format_duplicates(records, names)
    member = records.select("id").distinct().join(pairs, F.col("id") == F.col("copy_id"), "left")
    return member.groupBy(F.coalesce("first_id", "id").alias("id")).agg(F.count(F.lit(1)).alias("copies"))

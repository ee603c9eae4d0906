"""Frequency of every distinct value, term or phrase.

Method: suffix-sorted n-gram counting.  Each sequence gives its suffixes, cut to ``sigma`` terms; they are routed by
first term, sorted in reverse lexicographic order, and one pass yields total and record set of all prefixes at once.  The
stack of open prefixes is held as one column of boundaries for each depth: where the first d terms of a row differ from
those of the row before, the prefix of depth d is closed and the next one opened.  The deepest level counts its records in
order as they come; the others merge the record sets of what they hold.

A first term with ``HOT_SUFFIXES`` suffixes or more, and every such term, is routed by (term, share of records): the record
sets of the shares are disjoint, so their counts add up, and no group of a task is larger.

Defined cases: null terms are dropped, null weights count 0; an empty table gives an empty result; a record delivered
twice must be made distinct before (the queries do); a NUL in a term, which sets terms apart here, becomes a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actloom.runtime import written

#: suffixes of one first term from which on the term is split by record
HOT_SUFFIXES = 200_000
#: rows that are worked on at once, if the groups of their first terms end by then
CHUNK = 200_000
#: sorts before all else, so that the suffixes of a prefix stand together
SEP = "\x00"
SCHEMA = "field string, gram string, n int, total bigint, records bigint"


def prefix_counts(rows: pa.Table, sigma: int) -> Iterator[pa.RecordBatch]:
    """Counts of all prefixes of sorted suffixes (field, share, suffix, record, weight) that hold whole first terms."""
    rows = rows.combine_chunks()
    n = len(rows)
    if not n:
        return
    field, share, suffix, record, weight = (rows.column(i).chunk(0) for i in range(5))
    terms = pc.split_pattern(suffix, SEP)
    size = terms.value_lengths().to_numpy(zero_copy_only=False)
    code = terms.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    names, share = field.dictionary_encode().indices.to_numpy(zero_copy_only=False), share.to_numpy(zero_copy_only=False)
    record, weight = record.to_numpy(zero_copy_only=False), weight.to_numpy(zero_copy_only=False)
    new = np.ones(n, bool)
    new[1:] = (names[1:] != names[:-1]) | (share[1:] != share[:-1])
    for d in range(1, sigma + 1):
        at = np.where(size >= d, code[np.minimum(start + d - 1, len(code) - 1)], -1)
        new[1:] |= at[1:] != at[:-1]
        on = np.flatnonzero(size >= d)
        if not len(on):
            return
        opened = new[on]
        first = np.flatnonzero(opened)
        group = np.cumsum(opened) - 1
        r = record[on]
        if d < sigma:
            order = np.lexsort((r, group))
            r, g = r[order], group[order]
        else:
            g = group
        fresh = np.ones(len(r), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
        head = pa.array(on[first])
        gram = pc.binary_join(pc.list_slice(terms.take(head), 0, d), SEP)
        counts = np.bincount(g[fresh], minlength=len(first)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([field.take(head), gram, pa.array(np.full(len(first), d, np.int32)), pa.array(np.add.reduceat(weight[on], first)), pa.array(counts)], names=["field", "gram", "n", "total", "records"])


def _stack(sigma: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size < CHUNK:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            first = pc.list_element(pc.split_pattern(t.column(2).chunk(0), SEP, max_splits=1), 0)
            key = [c.dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in (t.column(0).chunk(0), first)] + [t.column(1).to_numpy()]
            differs = np.any([k[1:] != k[:-1] for k in key], axis=0)
            cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if cut:
                yield from prefix_counts(t.slice(0, cut), sigma)
            held, size = t.slice(cut).to_batches(), len(t) - cut
        if held:
            yield from prefix_counts(pa.Table.from_batches(held), sigma)

    return run


def term_counts(seqs: DataFrame, sigma: int = 1) -> DataFrame:
    """(field, gram, n, total, records) of all n-grams of up to ``sigma`` terms.

    ``seqs``: field string, record bigint, terms array<string>, weights array<bigint> or null (1 each); the total of an
    n-gram adds the weights of its first terms.  Terms of a gram are set apart by ``SEP``.

    Plan: a partial aggregate of the first terms finds the hot ones, which are written, so that Spark sees their size and
    joins them by broadcast or by shuffle; one shuffle of the suffixes; one of the counts.
    """
    ones = F.transform("terms", lambda _: F.lit(1).cast("bigint"))
    zipped = F.arrays_zip(F.transform("terms", lambda t: F.replace(t, F.lit(SEP), F.lit(" "))).alias("t"), F.coalesce("weights", ones).alias("w"))
    each = seqs.select("field", "record", F.filter(zipped, lambda z: z["t"].isNotNull()).alias("z")).where("size(z) > 0")
    each = each.select("field", "record", F.col("z.t").alias("ts"), F.col("z.w").alias("ws"))
    hot = each.select("field", F.explode("ts").alias("first")).groupBy("field", "first").count().where(F.col("count") >= HOT_SUFFIXES)
    hot = written(hot.select("field", "first", F.ceil(F.col("count") / HOT_SUFFIXES).cast("int").alias("shares")), "hot-terms")
    cut = F.transform(F.sequence(F.lit(1), F.size("ts")), lambda i: F.struct(F.get("ts", i - 1).alias("first"), F.array_join(F.slice("ts", i, sigma), SEP).alias("suffix"), F.get("ws", i - 1).alias("w")))
    suffix = each.select("field", "record", F.explode(cut).alias("s")).select("field", "s.first", "s.suffix", "record", F.coalesce("s.w", F.lit(0)).cast("bigint").alias("weight"))
    routed = suffix.join(hot, ["field", "first"], "left").withColumn("share", F.coalesce(F.expr("cast(pmod(xxhash64(record), shares) as int)"), F.lit(0)))
    parts = routed.repartition("field", "first", "share").sortWithinPartitions(F.asc("field"), F.asc("share"), F.desc("suffix"), F.asc("record"))
    counted = parts.select("field", "share", "suffix", "record", "weight").mapInArrow(_stack(sigma), SCHEMA)
    return counted.groupBy("field", "gram", "n").agg(F.sum("total").alias("total"), F.sum("records").alias("records"))


def marked(counts: DataFrame, sizes: DataFrame, rare_below: int = 3, common_share: float = 0.2) -> DataFrame:
    """``counts`` with a mark: ``rare`` below ``rare_below`` records, else ``common`` above ``common_share`` of all records of ``sizes`` (field, n_records), else null."""
    joined = counts.join(F.broadcast(sizes), "field")
    mark = F.when(F.col("records") < rare_below, "rare").when(F.col("records") > common_share * F.col("n_records"), "common")
    return joined.withColumn("mark", mark)

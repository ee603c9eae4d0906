"""Mixing sources to target weights.

Method: Pfair scheduling.  Every source's stream of tokens is cut into blocks; block j of a source of weight w is released
at floor((j-1)/w) and due at ceil(j/w), and the earliest deadline goes first, so that at every moment no source is a block
or more from its share.  Weights are exact fractions of one period, the schedule repeats after a period, and every piece of
a document finds its slot from its token offset, computed by a prefix sum of three levels.

Weights: the shares are taken as the decimals they are written as.  Where their common period has at most ``PERIOD`` slots
the weights are exact and all blocks have ``BLOCK_TOKENS``; else a source gets its slots of ``PERIOD`` rounded up, one at
least, and blocks smaller in proportion, so its share of tokens stays what it is and no block is above ``BLOCK_TOKENS``.

The mix is as large as the caps allow: the smallest of available * max_repeats / share over its sources.

Defined cases: sources of a mix without tokens get share 0 and the others keep their proportions; documents of unlisted
or null source, of no tokens or without id are not used; a mix without any tokens is empty; rows of one id are uses of
documents of their own; a source listed twice in a mix keeps its last row.
"""

from __future__ import annotations

import heapq
from fractions import Fraction
from math import ceil, lcm

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: the schedule of a period, at most about so many slots, is made on the driver and broadcast
PERIOD = 65_536
BLOCK_TOKENS = 4096
#: documents of one bucket of the prefix sums, and buckets of one upper bucket
BUCKET_DOCS, UPPER = 20_000, 4096


def weights(shares: dict[str, float], block: int = BLOCK_TOKENS, period: int = PERIOD) -> dict[str, tuple[int, int]]:
    """(slots a period, tokens a block) of each source; the period is the sum of the slots."""
    exact = {s: Fraction(repr(float(w))) for s, w in shares.items()}
    total = sum(exact.values())
    exact = {s: w / total for s, w in exact.items()}
    least = lcm(*(w.denominator for w in exact.values())) if exact else 1
    if least <= period:
        return {s: (int(w * least), block) for s, w in exact.items()}
    slots = {s: ceil(w * period) for s, w in exact.items()}
    return {s: (n, max(1, round(block * exact[s] * period / n))) for s, n in slots.items()}


def earliest_deadline_first(slots: dict[str, int]) -> list[str]:
    """The source of each slot of one period."""
    period = sum(slots.values())
    waiting = [(0, s, 1) for s in sorted(slots)]  # (release, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    order = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-j * period // slots[s]), s, j))
        _, s, j = heapq.heappop(ready)
        order.append(s)
        if j < slots[s]:
            heapq.heappush(waiting, (j * period // slots[s], s, j + 1))
    return order


def _plan(targets: list, totals: dict[str, int], block: int) -> tuple[list[tuple], list[tuple]]:
    """Rows of the plan (mix, source, share, cap, available, quota, slots, period, tokens a block) and of the slots (mix, source, nth, slot)."""
    plan, slots = [], []
    for mix in sorted({t.mix_name for t in targets}):
        own = {t.source: t for t in targets if t.mix_name == mix and t.source is not None and t.target_share and t.target_share > 0}
        live = {s: t for s, t in own.items() if totals.get(s, 0) > 0 and t.max_repeats and t.max_repeats > 0}
        if not live:
            continue
        norm = sum(t.target_share for t in live.values())
        share = {s: t.target_share / norm for s, t in live.items()}
        size = min(totals[s] * live[s].max_repeats / share[s] for s in live)
        whole = weights({s: t.target_share for s, t in live.items()}, block)
        order, nth = earliest_deadline_first({s: n for s, (n, _) in whole.items()}), dict.fromkeys(whole, 0)
        for at, s in enumerate(order):
            slots.append((mix, s, nth[s], at))
            nth[s] += 1
        plan += [(mix, s, float(t.target_share), int(t.max_repeats), totals[s], min(int(size * share[s] + 1e-6), totals[s] * int(t.max_repeats)), whole[s][0], len(order), whole[s][1]) for s, t in live.items()]
    return plan, slots


def _offsets(docs: DataFrame, buckets: int) -> DataFrame:
    """``docs`` (source, id, n_tokens) with the token offset of each within its source, in order of id hash.

    Documents are summed inside buckets of about ``BUCKET_DOCS``, buckets inside upper ones, upper ones inside the source, so
    no window holds more than a bucket, whatever the size of a source; the sums join on the bucket, where the documents already are.
    """
    order = docs.withColumn("h", F.xxhash64("id")).withColumn("b", F.expr(f"pmod(h, {buckets})"))
    per = order.groupBy("source", "b").agg(F.sum("n_tokens").alias("t")).withColumn("u", F.expr(f"b div {UPPER}"))
    within = per.withColumn("low", F.sum("t").over(Window.partitionBy("source", "u").orderBy("b")) - F.col("t"))
    above = per.groupBy("source", "u").agg(F.sum("t").alias("t"))
    above = above.select("source", "u", (F.sum("t").over(Window.partitionBy("source").orderBy("u")) - F.col("t")).alias("high"))
    before = within.join(above, ["source", "u"]).select("source", "b", (F.col("low") + F.col("high")).alias("before"))
    inside = Window.partitionBy("source", "b").orderBy("h", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = order.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(before, ["source", "b"])
    return placed.select("source", "id", "n_tokens", (F.col("before") + F.col("inner")).alias("offset"))


def mix(lengths: DataFrame, targets: DataFrame, block: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Chosen documents (mix_name, source, id, n_tokens, repeats, first_slot, ...) and the schedule table of the blocks.

    ``lengths``: id, source, n_tokens.  ``targets``: mix_name, source, target_share, max_repeats, a small table.
    The schedule decides: a source's stream, its documents repeated, fills its blocks in the order of their slots until its
    part of the mix is full; a document is chosen as often as it lies whole in that part, and ``first_slot`` is the slot of
    the block its first token falls into.  Plan and slots are broadcast, both bounded by ``PERIOD`` a mix.
    """
    spark = lengths.sparkSession
    rows = [r for r in targets.select("mix_name", "source", "target_share", "max_repeats").collect() if r.mix_name is not None]
    wanted = sorted({r.source for r in rows if r.source is not None})
    docs = lengths.where((F.col("n_tokens") > 0) & F.col("source").isin(wanted)).select("source", "id", "n_tokens")
    sums = docs.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    plan, slots = _plan(rows, {r.source: r.t for r in sums}, block)
    placed = _offsets(docs, max((r.n for r in sums), default=0) // BUCKET_DOCS + 1)
    p = spark.createDataFrame(plan, "mix_name string, source string, target_share double, max_repeats int, available bigint, quota bigint, slots int, period int, block_tokens int")
    s = spark.createDataFrame(slots, "mix_name string, source string, nth int, at int")
    chosen = placed.join(F.broadcast(p), "source").withColumn("repeats", F.greatest(F.lit(0), F.floor((F.col("quota") - F.col("offset") - F.col("n_tokens")) / F.col("available")) + 1).cast("int"))
    return _slotted(chosen.where("repeats > 0").withColumn("block", F.expr("offset div block_tokens")), s).withColumnRenamed("slot", "first_slot").drop("block"), s


def _slotted(blocks: DataFrame, slots: DataFrame) -> DataFrame:
    """``blocks`` (mix_name, source, block, slots, period, ...) with the slot of the block."""
    at = blocks.withColumn("nth", F.expr("cast(block % slots as int)")).join(F.broadcast(slots), ["mix_name", "source", "nth"])
    return at.withColumn("slot", F.expr("(block div slots) * period + at")).drop("nth", "at")


def shares(chosen: DataFrame) -> DataFrame:
    """Actual shares of a mix as :func:`mix` chose it, one row a source."""
    used = chosen.groupBy("mix_name", "source").agg(
        F.first("target_share").alias("target_share"), F.first("max_repeats").alias("max_repeats"), F.first("available").alias("available_tokens"),
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("most_repeats"),
    )
    return used.withColumn("total_tokens", F.sum("tokens").over(Window.partitionBy("mix_name"))).withColumn("actual_share", F.col("tokens") / F.col("total_tokens"))


def schedule(chosen: DataFrame, slots: DataFrame) -> DataFrame:
    """One row for each piece of each use of a document, cut where a block ends: (mix_name, slot, source, doc_id, use, start, n_tokens).

    Rows in order of slot give the mix: after every full slot each source is less than a block from its share of the tokens.
    """
    uses = chosen.withColumn("use", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1))).withColumn("position", F.col("use") * F.col("available") + F.col("offset"))
    blocks = uses.withColumn("block", F.explode(F.expr("sequence(position div block_tokens, (position + n_tokens - 1) div block_tokens)")))
    start = F.expr("greatest(position, block * block_tokens)")
    end = F.expr("least(position + n_tokens, (block + 1) * block_tokens)")
    cut = blocks.select("mix_name", "source", F.col("id").alias("doc_id"), "use", "block", "slots", "period", (start - F.col("position")).alias("start"), (end - start).alias("n_tokens"))
    return _slotted(cut, slots).select("mix_name", "slot", "source", "doc_id", "use", "start", "n_tokens")

"""Filling fixed-capacity containers with whole items.

Method: bounded-space online packing.  Every partition keeps a fixed number of open windows for each capacity and places
items best-fit; when no window has room the fullest is emitted and a new one opened.  Windows still open at the end of
a partition are merged as items of their own, over ever fewer partitions.  Every merging round works alike: a task takes
the leftovers of ``FAN_IN`` partitions, so at most ``FAN_IN * windows`` a capacity, packs them largest first with as many
windows, and emits the fullest until no more than ``windows`` are left open.

Defined cases: an item above the capacity is cut into full pieces and one rest, and only then; items of no length need
no container and are left out; equal ids are packed as separate items; an empty table gives no container.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actloom.runtime import written

WINDOWS = 64
#: partitions of leftovers that one merging task takes together
FAN_IN = 16
ITEM = "pack int, id bigint, piece int, pieces int, start bigint, n_tokens bigint, bin bigint, is_open boolean"


class Windows:
    """At most ``limit`` open windows of one capacity; ``emit`` takes (bin, items, fill, is_open)."""

    def __init__(self, capacity: int, limit: int, first_bin: int, emit) -> None:  # noqa: ANN001
        self.capacity, self.limit, self.bin, self.emit = capacity, limit, first_bin, emit
        self.open: list[tuple[int, int]] = []
        self.items: dict[int, list] = {}

    def put(self, size: int, item: tuple) -> None:
        at = bisect_left(self.open, (size, -1))
        if at < len(self.open):
            free, b = self.open.pop(at)
        else:
            if len(self.open) >= self.limit:
                self._close(self.open.pop(0))
            free, b = self.capacity, self.bin
            self.bin += 1
            self.items[b] = []
        self.items[b].append(item)
        if free == size:
            self._close((0, b))
        else:
            insort(self.open, (free - size, b))

    def _close(self, window: tuple[int, int], is_open: bool = False) -> None:
        free, b = window
        self.emit(b, self.items.pop(b), self.capacity - free, is_open)

    def end(self, keep: int) -> None:
        """Emit the fullest until ``keep`` are left, which go on as open."""
        while len(self.open) > keep:
            self._close(self.open.pop(0))
        while self.open:
            self._close(self.open.pop(0), True)


def _pack(capacities: list[int], windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        base = TaskContext.get().partitionId() << 32
        packs = []
        for k, c in enumerate(capacities):
            packs.append(Windows(c, windows, base, lambda b, items, fill, is_open, k=k: out.extend((k, *i, b, is_open) for i in items)))

        def table() -> pa.RecordBatch:
            types = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            cols = list(zip(*out, strict=True)) if out else [[]] * 8
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in ITEM.split(", ")])
            out.clear()
            return got

        for b in batches:
            # in order of arrival: sorted by size, few windows would be emitted before the small items that fill them come
            for i, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for p in packs:
                    pieces = -(-n // p.capacity)
                    for j in range(pieces):
                        size = min(p.capacity, n - j * p.capacity)
                        p.put(size, (i, j, pieces, j * p.capacity, size))
            yield table()
        for p in packs:
            p.end(windows)
        yield table()

    return run


def _merge(capacities: list[int], windows: int, level: int):
    """Leftover windows packed as items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((n, k, b) for x in batches for k, b, n in zip(*(c.to_pylist() for c in x.columns), strict=True)), reverse=True)
        out: list[tuple] = []
        base = (level << 58) | (TaskContext.get().partitionId() << 32)
        packs = [Windows(c, FAN_IN * windows, base, lambda b, items, fill, is_open, k=k: out.extend((k, i, b, fill, is_open) for i in items)) for k, c in enumerate(capacities)]
        for n, k, b in rows:
            packs[k].put(n, b)
        for p in packs:
            p.end(windows)
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["pack", "bin", "into", "fill", "is_open"])

    return run


def pack(lengths: DataFrame, sizes: list[tuple[str, int]], windows: int = WINDOWS) -> DataFrame:
    """(pack_name, capacity_tokens, container, id, piece, pieces, start, n_tokens) of ``lengths`` (id, n_tokens).

    Plan: one pass over the lengths, no shuffle; only items of windows left open (at most ``windows`` a partition and
    capacity) take part in the merging rounds, whose number is the logarithm of the number of partitions.
    """
    spark = lengths.sparkSession
    sizes = [(n, int(c)) for n, c in sizes if c and c > 0]
    caps = [c for _, c in sizes]
    items = lengths.where("n_tokens > 0").select("id", "n_tokens")
    placed = written(items.mapInArrow(_pack(caps, windows), ITEM), "packed")
    parts = max(1, items.rdd.getNumPartitions())
    left = placed.where("is_open").groupBy("pack", "bin").agg(F.sum("n_tokens").alias("fill"))
    moves: DataFrame | None = None
    level = 1
    while True:
        last = parts <= 1
        parts = max(1, -(-parts // FAN_IN))
        step = written(left.repartition(parts).sortWithinPartitions("pack", "bin").mapInArrow(_merge(caps, windows, level), "pack int, bin bigint, into bigint, fill bigint, is_open boolean"), "merged")
        now = step.select("pack", "bin", "into")
        moves = now if moves is None else moves.join(now.select("pack", F.col("bin").alias("into"), F.col("into").alias("next")), ["pack", "into"], "left").select("pack", "bin", F.coalesce("next", "into").alias("into"))
        if parts == 1 or last:
            break
        left = step.where("is_open").select("pack", F.col("into").alias("bin"), "fill").distinct()
        level += 1
    names = spark.createDataFrame([(k, n, c) for k, (n, c) in enumerate(sizes)], "pack int, pack_name string, capacity_tokens int")
    closed = placed.where("not is_open").withColumn("container", F.col("bin"))
    opened = placed.where("is_open").join(moves, ["pack", "bin"], "left").withColumn("container", F.coalesce("into", "bin")).drop("into")
    both = closed.unionByName(opened).join(F.broadcast(names), "pack")
    return both.select("pack_name", "capacity_tokens", "container", "id", "piece", "pieces", "start", "n_tokens")

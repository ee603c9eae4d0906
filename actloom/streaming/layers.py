"""Amendment layers as they arrive: every micro-batch of items becomes the next layer of the acts it names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from actloom.operators import amendments, apply
from actloom.operators.revise import RUNS
from actloom.runtime import written


class LayerStore:
    """Acts as Parquet versions in a folder: layer n holds the paragraphs of the acts that batch n changed, layer 0 all of
    the beginning; an act stands as its newest layer has it, so a batch writes no act that it does not name.

    A version is written whole before it counts, and a batch that comes again after a failure writes the same version,
    so the chain survives restarts.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, n: int, what: str = "paragraphs") -> str:
        return f"{self.folder}/{what}/layer={n}"

    def start(self, paragraphs: DataFrame) -> None:
        rows = paragraphs if "runs" in paragraphs.columns else paragraphs.withColumn("runs", F.lit(None).cast(RUNS))
        rows.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("ord").cast("int").alias("ord"), "text", "runs").write.mode("overwrite").parquet(self.path(0))

    def paragraphs(self, n: int, named: DataFrame | None = None) -> DataFrame:
        """All acts, or the ``named`` ones (doc_id), after layer n; the newest layer of an act is found from its narrow id column."""
        all_ = self.spark.read.schema(f"doc_id string, ord int, text string, runs {RUNS}, layer int").parquet(f"{self.folder}/paragraphs").where(F.col("layer") <= n)
        if named is not None:
            all_ = all_.join(named, "doc_id", "left_semi")
        newest = all_.groupBy("doc_id").agg(F.max("layer").alias("layer"))
        return all_.join(newest, ["doc_id", "layer"], "left_semi").select("doc_id", "ord", "text", "runs")

    def results(self, n: int) -> DataFrame:
        return self.spark.read.parquet(self.path(n, "items"))

    def add(self, items: DataFrame, batch: int, color: str) -> None:
        """Layer batch + 1: the acts that this batch names, from their newest version before it."""
        todo = written(amendments.identify(items), "batch")
        result = written(apply.apply_layer(self.paragraphs(batch, todo.select("doc_id").distinct()), todo, color), "layer")
        result.where("part = 'item'").drop("part", "ord", "text", "runs").write.mode("overwrite").parquet(self.path(batch + 1, "items"))
        apply.next_layer(result).write.mode("overwrite").parquet(self.path(batch + 1))


def stream_layers(items: DataFrame, store: LayerStore, checkpoint: str, colors: tuple[str, ...] = ("E67800", "800080", "0066CC", "804000", "008000")) -> StreamingQuery:
    """Run ``items`` (a stream in the form of raw amendment items) through the store until it is stopped or, with files at rest, all is read."""

    def one(df: DataFrame, batch: int) -> None:
        store.add(df, batch, colors[batch % len(colors)])

    return items.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(items: DataFrame, late: str = "30 days", width: str = "1 day") -> DataFrame:
    """Windowed counts of arriving items by kind, for streams with the time column ``loaded_at``; items later than ``late`` are left out once their window is closed."""
    kind = amendments.C.amendment_kind(F.col("source_instruction"), F.col("text"))
    return items.withWatermark("loaded_at", late).groupBy(F.window("loaded_at", width).alias("w"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).select("w.start", "w.end", "kind", "n")

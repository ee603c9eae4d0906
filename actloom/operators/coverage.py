"""Multiset token coverage between a source text and a target text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actloom.functions import tokens as T


def token_counts(texts: DataFrame, key: str, tokens: Column, kept: bool = False) -> DataFrame:
    """(key, token, n, first) of the token arrays, aggregated map-side; ``kept`` drops practical noise."""
    each = texts.select(key, F.posexplode(tokens).alias("pos", "token"))
    if kept:
        each = each.where(~T.is_noise(F.col("token")))
    return each.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))


def compare(source: DataFrame, target: DataFrame, key: str, tokens: Column, kept: bool = False) -> DataFrame:
    """One row (key, token, s, d, first_s, first_d) for every token of either side; ``source`` and ``target`` hold the key and what ``tokens`` is made of.

    Both sides go into one aggregate with a sign of their own: one shuffle, combined map-side.
    """
    side = lambda df, is_source: df.select(key, F.lit(is_source).alias("is_source"), F.posexplode(tokens).alias("pos", "token"))
    each = side(source, True).unionByName(side(target, False))
    if kept:
        each = each.where(~T.is_noise(F.col("token")))
    of = lambda f, on, value: f(F.when(F.col("is_source") == on, value))
    return each.groupBy(key, "token").agg(of(F.count, True, F.lit(1)).alias("s"), of(F.count, False, F.lit(1)).alias("d"), of(F.min, True, F.col("pos")).alias("first_s"), of(F.min, False, F.col("pos")).alias("first_d"))


def summary(pairs: DataFrame, key: str) -> DataFrame:
    """The coverage figures of each key; the ratio of an empty source is 1."""
    over = lambda x: F.greatest(x, F.lit(0))
    missing, extra = over(F.col("s") - F.col("d")), over(F.col("d") - F.col("s"))
    got = pairs.groupBy(key).agg(
        F.sum("s").alias("total_source_tokens"), F.sum("d").alias("total_docx_tokens"), F.sum(F.least("s", "d")).alias("matched_tokens"),
        F.sum(missing).alias("missing_tokens_total"), F.sum((missing > 0).cast("bigint")).alias("missing_unique_tokens"),
        F.sum(extra).alias("extra_tokens_total"), F.sum((extra > 0).cast("bigint")).alias("extra_unique_tokens"),
    )
    return got.withColumn("coverage_ratio", F.when(F.col("total_source_tokens") == 0, 1.0).otherwise(F.col("matched_tokens") / F.col("total_source_tokens")))


def top_differences(pairs: DataFrame, key: str, side: str = "missing", n: int = 50) -> DataFrame:
    """The n tokens of each key that are most often missing (or extra); ties by first occurrence."""
    gap, first = (F.col("s") - F.col("d"), "first_s") if side == "missing" else (F.col("d") - F.col("s"), "first_d")
    ranked = pairs.withColumn("n", gap).where("n > 0").withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), first, "token")))
    return ranked.where(F.col("rank") <= n).select(key, "token", "n", "rank")

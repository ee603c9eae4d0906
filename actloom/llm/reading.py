"""Reading level of each document.

Method: every word gets an acquisition grade, the grade at which half of its rate of use over the graded texts has been
met; a document's level comes from quantiles of the grades of its known words, calibrated on the graded documents by
least squares.

The model is fitted on a bounded sample of the graded documents, those of the smallest id hash (so the sample is stable):
at most ``MAX_LABELLED`` of them, none above ``MAX_TEXT`` characters and ``MAX_SAMPLE`` characters together.  All words of
the sample are kept, a word of few texts with a grade drawn to the middle by ``PRIOR`` even texts; the bound of the sample
bounds the words that are broadcast.  Every document is scored whole.

Defined cases: several grades of a document are averaged; null text, or text without a known word, has a null level;
without any graded document all levels are null; extra columns are ignored; rows of one id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from actloom.llm import codes
from actloom.runtime import partitions, written

GRADES = 5
#: bounds of the sample of graded documents: documents, characters of one, characters in all
MAX_LABELLED, MAX_TEXT, MAX_SAMPLE = 20_000, 200_000, 40_000_000
#: texts, spread evenly over the grades, that each word is taken to stand in besides those of the sample
PRIOR = 3
QUANTILES = (0.25, 0.5, 0.75, 0.9)
#: abbreviations whose full stop ends no sentence (fixed values)
ABBREVIATIONS = ("Art", "No", "cf", "p", "para")
#: levels from here on, the ones nearest to grade 3 or more, may be an expert reader's
EXPERT_FROM = 2.5
FEATURES = "n_words bigint, n_letters bigint, n_sentences bigint, n_known bigint, " + ", ".join(f"q{i} double" for i in range(len(QUANTILES)))


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """0 for what is no letter, else the lower-case code point plus 1."""
    t = np.zeros(codes.TOP, np.uint32)
    for i in range(codes.TOP):
        c = chr(i)
        if c.isalpha():
            t[i] = ord(c.lower()[0]) + 1
    return t


def _hash_word(w: str) -> int:
    cps = np.array([ord(c) for c in w], np.uint64)
    return int(codes.stretch(codes.prefix(codes.mix(cps)), np.array([0]), np.array([len(w)]))[0])


def letter_words(cps: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows and hashes (of the lower-case form) of the maximal runs of letters."""
    folded = letters()[cps]
    s, e, row = codes.runs(folded > 0, off)
    return s, e, row, codes.stretch(codes.prefix(codes.mix(folded)), s, e)


def sentence_ends(cps: np.ndarray, off: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Positions of the stops that end a sentence: before whitespace or the end of the text, and not of an abbreviation."""
    if not len(cps):
        return np.zeros(0, np.int64)
    stop = (cps == 46) | (cps == 33) | (cps == 63)
    after = np.ones(len(cps), bool)
    after[:-1] = codes.space_table()[cps[1:]]
    ends = off[1:][off[1:] > off[:-1]]
    after[ends - 1] = True
    at = np.flatnonzero(stop & after)
    exact = codes.stretch(codes.prefix(codes.mix(cps)), s, e)
    short = np.isin(exact, np.array([_hash_word(a) for a in ABBREVIATIONS], np.uint64))
    return at[~((cps[at] == 46) & np.isin(at, e[short]))]


def features(arr: pa.Array, keys: np.ndarray, grades: np.ndarray) -> list[np.ndarray]:
    """The columns of ``FEATURES`` for the texts; ``keys`` are sorted word hashes."""
    cols: list[list[np.ndarray]] = [[] for _ in range(4 + len(QUANTILES))]
    for _, part in codes.slices(arr):
        cps, off = codes.points(part)
        n = len(part)
        s, e, row, h = letter_words(cps, off)
        words = np.bincount(row, minlength=n)
        chars = np.bincount(row, weights=e - s, minlength=n).astype(np.int64)
        sentences = np.bincount(np.searchsorted(off, sentence_ends(cps, off, s, e), side="right") - 1, minlength=n)
        at = np.minimum(np.searchsorted(keys, h), max(0, len(keys) - 1))
        hit = keys[at] == h if len(keys) else np.zeros(len(h), bool)
        g, r = grades[at[hit]] if len(keys) else np.zeros(0), row[hit]
        g = g[np.lexsort((g, r))]
        known = np.bincount(r, minlength=n)
        first = np.concatenate([[0], np.cumsum(known)])
        some = known > 0
        qs = []
        for q in QUANTILES:
            x = np.full(n, np.nan)
            x[some] = g[(first[:-1] + np.floor(q * (known - 1)).astype(np.int64))[some]]
            qs.append(x)
        for c, v in zip(cols, [words, chars, sentences, known, *qs], strict=True):
            c.append(v)
    return [np.concatenate(c) if c else np.zeros(0) for c in cols]


def _arrow(cols: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(c.astype(np.int64)) for c in cols[:4]] + [pa.array(c.astype(float), pa.float64(), from_pandas=True) for c in cols[4:]]


class Model:
    """Word grades and the calibration of the quantiles."""

    def __init__(self, keys: np.ndarray, grades: np.ndarray, weights: np.ndarray | None) -> None:
        self.keys, self.grades, self.weights = keys, grades, weights

    def level(self, qs: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(qs[0]), np.nan)
        return np.clip(np.stack([np.ones(len(qs[0])), *qs], 1) @ self.weights, 1, GRADES)

    def calibrate(self, qs: list[np.ndarray], grade: np.ndarray) -> None:
        """Least squares of the grades on the quantiles; a slight ridge on the slopes, none on the constant."""
        x = np.stack([np.ones(len(grade)), *qs], 1)
        ridge = np.diag([0.0] + [1e-2] * len(qs))
        self.weights = np.linalg.solve(x.T @ x + ridge, x.T @ grade)


def _word_rates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, grade, rate, texts) sums of each task; a text adds the share of its words."""
    for b in batches:
        grade = b.column(1).to_numpy(zero_copy_only=False)
        for at, part in codes.slices(b.column(2).cast(pa.string())):
            cps, off = codes.points(part)
            _, _, row, h = letter_words(cps, off)
            n = np.bincount(row, minlength=len(part))
            key = np.rec.fromarrays([h, row])
            u, c = np.unique(key, return_counts=True)
            r = u["f1"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.signed(u["f0"])), pa.array(np.rint(grade[at + r]).astype(np.int32)), pa.array(c / np.maximum(1, n[r])), pa.array(np.ones(len(u), np.int64))],
                names=["word", "grade", "rate", "texts"],
            )


def acquisition_grades(rates: np.ndarray, held: np.ndarray, texts: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Grade at which half of a word's use is reached, interpolated.

    ``rates``: rows are words, columns the sums of their shares in the texts of a grade; ``held``: texts that hold the word;
    ``texts``: texts of each grade.
    """
    even = (rates.sum(1) / np.maximum(1, held) * prior)[:, None] * (texts / max(1, texts.sum()))[None, :]
    p = (rates + even) / np.maximum(1, texts)[None, :]
    c = np.cumsum(p, 1) / np.maximum(p.sum(1, keepdims=True), 1e-300)
    k = np.argmax(c >= 0.5, 1)
    i = np.arange(len(c))
    low = np.where(k > 0, c[i, np.maximum(k - 1, 0)], 0.0)
    return k + 0.5 + (0.5 - low) / np.maximum(c[i, k] - low, 1e-12)


def graded_sample(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_text: int = MAX_TEXT, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, grade, text) of the graded documents the model is fitted on; the grades are broadcast, the texts never shuffled."""
    graded = labels.where(F.col("grade").between(1, GRADES)).groupBy("doc_id").agg(F.avg("grade").alias("grade"))
    some = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = written(documents.select("doc_id", "text").where(F.length("text") <= max_text).join(F.broadcast(some), "doc_id").select("doc_id", "grade", "text"), "graded")
    size = texts.groupBy("doc_id").agg(F.sum(F.length("text")).alias("size"))  # one narrow row a graded document
    upto = F.sum("size").over(Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("doc_id"), "doc_id"))
    kept = size.withColumn("upto", upto).where(F.col("upto") <= max_sample).select("doc_id")
    return texts.join(F.broadcast(kept), "doc_id", "left_semi")


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """The model of graded documents: ``documents`` (doc_id, text), ``labels`` (doc_id, grade)."""
    spark = documents.sparkSession
    texts = graded_sample(documents, labels)
    texts = written(texts.repartition(partitions(spark)), "graded")
    rate = texts.mapInArrow(_word_rates, "word bigint, grade int, rate double, texts bigint").groupBy("word").agg(
        *[F.sum(F.when(F.col("grade") == g, F.col("rate")).otherwise(0.0)).alias(f"g{g}") for g in range(1, GRADES + 1)], F.sum("texts").alias("texts")
    )
    words = rate.toPandas()
    per = {int(r["g"]): int(r["n"]) for r in texts.groupBy(F.rint("grade").alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    keys = words["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    count = np.array([per.get(g, 0) for g in range(1, GRADES + 1)])
    grade = acquisition_grades(words[[f"g{g}" for g in range(1, GRADES + 1)]].to_numpy(float), words["texts"].to_numpy(float), count) if len(words) else np.zeros(0)
    model = Model(keys[order], grade[order].astype(np.float32), None)
    got = score_features(texts.select("doc_id", "text", "grade"), spark.sparkContext.broadcast(model), "doc_id", "text", ("grade",)).toPandas()
    got = got[got["n_known"] > 0]
    if len(got):
        model.calibrate([got[f"q{i}"].to_numpy(float) for i in range(len(QUANTILES))], got["k0"].to_numpy(float))
    return model


def score_features(df: DataFrame, model, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:  # noqa: ANN001
    """(id, k0.., the features, level) of every row; ``model`` is a broadcast :class:`Model`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            cols = features(b.column(b.num_columns - 1).cast(pa.string()), m.keys, m.grades)
            level = m.level([c.astype(float) for c in cols[4:]])
            names = [*b.schema.names[:-1], *[x.split()[0] for x in FEATURES.split(", ")], "level"]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *_arrow(cols), pa.array(level, pa.float64(), from_pandas=True)], names=names)

    kept = [F.col(f"`{c}`").cast("string").alias(f"k{i}") for i, c in enumerate(keep)]
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *kept, F.col(f"`{text_col}`").cast("string").alias("text")).where("id is not null")
    schema = "id bigint, " + "".join(f"k{i} string, " for i in range(len(keep))) + FEATURES + ", level double"
    return rows.mapInArrow(run, schema)


def levels(documents: DataFrame, labels: DataFrame, keep: tuple[str, ...] = (), model: Model | None = None) -> tuple[DataFrame, Model]:
    """Scores of all documents and the model; one pass over the texts beyond the fitting."""
    model = model or fit(documents, labels)
    return score_features(documents, documents.sparkSession.sparkContext.broadcast(model), "doc_id", "text", keep), model

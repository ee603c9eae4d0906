"""Reports and tables as files: JSON in and out, CSV out, PDF text, and the names that stages give their files."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_COUNTS = "total_source_tokens bigint, total_docx_tokens bigint, matched_tokens bigint, missing_tokens_total bigint, missing_unique_tokens bigint, extra_tokens_total bigint, extra_unique_tokens bigint"
_LISTS = "coverage_ratio double, top_missing array<array<string>>, top_extra array<array<string>>"
COVERAGE = f"created_at_utc string, docx_path string, docx_token_count bigint, source_type string, source_path string, min_coverage_threshold double, comparison struct<{', '.join(f'{c.split()[0]}: {c.split()[1]}' for c in ('source_type string, source_path string, ' + _COUNTS + ', ' + _LISTS).split(', '))}>"
_TARGETS = "target_article_number: string, target_paragraph_number: string, target_point_marker: string, target_annex_number: string, target_annex_point_marker: string"
ANALYSIS = f"created_at_utc string, amendment_number int, amending_title string, recitals_inserted int, items_detected int, items_analyzed int, items_applied_by_replacement int, items_inserted_as_new int, analysis array<struct<article_number: string, article_heading: string, amending_text: string, source_instruction: string, {_TARGETS}, best_match_index: int, best_match_score: double, best_match_text: string, applied_mode: string, diff: struct<inserted_words: int, deleted_words: int, replaced_from_words: int, replaced_to_words: int>>>"
IDENTIFIED = f"created_at_utc string, target_regulation string, amending_title string, recitals array<string>, detected_items int, relevant_items int, items array<struct<article_number: string, article_heading: string, text: string, amendment_kind: string, {_TARGETS}, inserted_article_marker: string, source_instruction: string>>"


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON reports under a fixed schema, one object a file; fields a branch leaves out are null."""
    return spark.read.json(path, schema=schema, multiLine=True)


def analysis_items(reports: DataFrame) -> DataFrame:
    """(doc_id, item_idx, the item's fields) of analysis reports read with their path as doc_id."""
    return reports.select("doc_id", F.posexplode("analysis").alias("item_idx", "a")).select("doc_id", "item_idx", "a.*")


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text a row, nulls kept."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    as_json(df).write.text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def pdf_text(files: DataFrame) -> DataFrame:
    """(doc_id, text) of PDF ``files`` (doc_id, content); needs the pypdf library, as the error says where it is absent."""
    try:
        import pypdf  # noqa: F401
    except ImportError as e:
        raise RuntimeError("PDF comparison requires pypdf. Install it with: pip install pypdf") from e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        from pypdf import PdfReader

        for b in batches:
            texts = [" ".join(" ".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(x)).pages).split()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return files.select(F.col("doc_id").cast("string"), "content").mapInArrow(run, "doc_id string, text string")


def layer_names(folder: str, layer: int) -> dict[str, Path]:
    """The files a consolidation layer reads and writes."""
    base = Path(folder)
    return {"output": base / f"layer_{layer}.docx", "analysis": base / "qa" / f"layer_{layer}_analysis.json", "identified": base / "qa" / f"layer_{layer}_items.json", "report": base / "qa" / f"layer_{layer}_check.json"}


def base_of(folder: str, layer: int, exists=Path.exists) -> Path | None:  # noqa: ANN001
    """The newest earlier output to build a layer on: layer n-1 down to 1, then the formatted act."""
    tries = [*(layer_names(folder, n)["output"] for n in range(layer - 1, 0, -1)), Path(folder) / "act.docx"]
    return next((p for p in tries if exists(p)), None)

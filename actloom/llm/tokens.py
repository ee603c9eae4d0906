"""Token lengths under a public byte-level BPE vocabulary, given as a file of base64 ranks."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("ACTLOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: the pre-split of this family of public vocabularies (a fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(digest: str, holder: "_Ranks"):  # noqa: ANN202
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, holder.data.splitlines())}
    return tiktoken.Encoding(digest, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Ranks:
    def __init__(self, data: bytes) -> None:
        self.data = data

    def __hash__(self) -> int:
        return 0

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Ranks)


def encoding(data: bytes):  # noqa: ANN201
    return _encoding(hashlib.sha256(data).hexdigest(), _Ranks(data))


def token_lengths(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, *keep as k0.., n_tokens); null text has 0 tokens, rows without id are left out.

    The vocabulary file (under 1 MB) is read on the driver and broadcast, so executors need no copy of it.
    """
    with open(vocabulary, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value)
        for b in batches:
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])

    cols = [F.col(f"`{id_col}`").cast("bigint").alias("id"), *[F.col(f"`{c}`").cast("string").alias(f"k{i}") for i, c in enumerate(keep)]]
    rows = df.select(*cols, F.col(f"`{text_col}`").cast("string").alias("text")).where("id is not null")
    return rows.mapInArrow(run, ", ".join(["id bigint", *[f"k{i} string" for i in range(len(keep))], "n_tokens bigint"]))

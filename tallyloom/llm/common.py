"""Helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """The place of a vocabulary file; ``folder`` replaces the installed one."""
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; Python workers are told where this package lies, as the driver may have found it by its own path.

    Where executors don't share that place, ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", *others: str) -> DataFrame:
    """Key, text and named columns only, so that the rest can neither clash nor be read; a null text is empty."""
    return docs.select(F.col(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias(text), *others)


def renewed(df: DataFrame) -> DataFrame:
    """The same columns under new references, so that a table can meet itself."""
    return df.select(*[F.col(f"`{name}`").alias(name) for name in df.columns])


def text_blocks(texts: list[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``chars`` characters together, one text at least."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def byte_blocks(texts: pa.Array, size: int = 10_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of at most ``size`` bytes together, or of one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
        yield start, stop
        start = stop


def is_finite_vector(column: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    return F.coalesce(
        column.isNotNull()
        & (F.size(column) > 0)
        & F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))),
        F.lit(False),
    )

"""Streams over folders of Parquet or text files, and rows given in code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from clickflow.schemas import RAW_RECORD


def _bounded(spark: SparkSession, bytes_per_batch: int | None, files_per_batch: int | None):
    """A stream reader whose batches are bounded as given, else by what has arrived."""
    reader = spark.readStream
    if files_per_batch:
        return reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else reader


def stream_files(spark: SparkSession, path: str, schema: StructType,
                 bytes_per_batch: int | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files; new files are taken in as they appear.

    Bound a backlog's batches by bytes to what the cluster can hold. Clicks are late by the
    batches before theirs, so where batches are cut decides which clicks those are.
    """
    return _bounded(spark, bytes_per_batch, files_per_batch).schema(schema).parquet(path)


def stream_click_files(spark: SparkSession, path: str, **limits) -> DataFrame:
    """A stream of raw click records ``(value, seq, arrivalMs)``."""
    return stream_files(spark, path, RAW_RECORD, **limits)


def stream_entry_texts(spark: SparkSession, path: str, bytes_per_batch: int | None = None,
                       files_per_batch: int | None = None) -> DataFrame:
    """A stream of change entries, one JSON text per line.

    With ``files_per_batch=1`` each file is a fetch batch of its own.
    """
    return _bounded(spark, bytes_per_batch, files_per_batch).text(path)


def given_clicks(spark: SparkSession, texts: list[str]) -> DataFrame:
    """Raw records from a list in code, numbered in list order, for trials and tests."""
    rows = [(text, number, None) for number, text in enumerate(texts)]
    return spark.createDataFrame(rows, RAW_RECORD)

"""Small helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.operators.batchlog import delete_folder
from clickflow.session import work_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = str.maketrans(UPPER, LOWER)

# A word: no blank and none of the five ASCII line and tab characters. bytes.split() cuts alike.
WORD = r"[^\x20\x09-\x0D]+"

TEXT_ROWS = 1_000  # rows in an Arrow batch of texts: some are very long, and workers keep their peak
BROADCAST_ROWS = 500_000  # narrow tables of counted size up to this are broadcast, others joined


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of at most ``TEXT_ROWS``, from now on."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) not in range(1, TEXT_ROWS + 1):
        spark.conf.set(name, TEXT_ROWS)


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, every other letter as it is."""
    return F.translate(column, UPPER, LOWER)


_made: ContextVar[list[str] | None] = ContextVar("work tables", default=None)


@contextmanager
def work_tables() -> Iterator[list[str]]:
    """The folders of the tables that ``keep_table`` writes inside the block, and in no other."""
    made: list[str] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


def keep_table(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the cluster's shared folder and read it from there.

    What follows then starts from the files, also after an executor was lost.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    if (made := _made.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_work_tables(spark: SparkSession, made: list[str], but: DataFrame | None = None) -> list[str]:
    """Delete work tables once what was built on them is stored; ``but`` is one that is still needed.

    The tables that stay are returned.
    """
    needed = [name.rsplit("/", 1)[0] for name in (but.inputFiles() if but is not None else [])]
    stays = [path for path in made if any(name.endswith(path.split("://")[-1]) for name in needed)]
    for path in made:
        if path not in stays:
            delete_folder(spark, path)
    return stays


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a narrow side whose row count was taken and is small; else let Spark join it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def replace_columns(df: DataFrame, added: dict[str, Column]) -> DataFrame:
    """Add columns; columns of these names (in any case) that were there are replaced."""
    taken = {name.lower() for name in added}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken],
                     *[value.alias(name) for name, value in added.items()])

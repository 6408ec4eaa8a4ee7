"""Statistics of one text, and labelled rows of them for fitting.

Words are runs of characters other than blank and the five ASCII line and tab characters. A
null or empty text has no words and all counts 0. Whole texts are read whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from clickflow.llm.common import keep_table, text_batches

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
RUN = 5
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words", "upper", "digits", "commas",
    "stops", "shouts", "distinct_words", "twins", "top_word", "line_words", "bars", "letters_alone",
    "longest_word")
SAMPLE_ROWS = 40_000  # the bound on labelled rows that a classifier is fitted on


def ranked(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1]


def in_repeated_runs(ids: np.ndarray, run: int = RUN) -> int:
    """How many words lie in a run of five that occurs at least twice; equality is exact."""
    n = len(ids)
    if n <= run:
        return 0
    kinds = int(ids.max()) + 1
    pairs = ranked(ids[:-1] * kinds + ids[1:])
    fours = ranked(pairs[:-2] * n + pairs[2:])
    _, back, counts = np.unique(fours[:-1] * kinds + ids[run - 1:], return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[back] > 1)
    if not len(again):
        return 0
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, again, 1)
    np.add.at(depth, again + run, -1)
    return int((np.cumsum(depth)[:n] > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], list[float]]:
    """The counts named in ``COUNTS`` and the features named in ``FEATURES``."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        return (0,) * len(COUNTS), [0.0] * len(FEATURES)
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    repeated = in_repeated_runs(ids)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    lower = text.lower()
    upper = (int((points != np.frombuffer(lower.encode("utf-32-le", "replace"), np.uint32)).sum())
             if len(lower) == len(text) else sum(map(str.isupper, text)))
    sizes = np.fromiter(map(len, words), np.int64, n)
    dup_lines = len(lines) - len(set(lines))
    features = [
        np.log1p(n), chars / n, symbols / n, dup_lines / len(lines), repeated / n, upper / chars,
        int(((points >= 48) & (points <= 57)).sum()) / chars, text.count(",") / n, text.count(".") / n,
        text.count("!") / n, len(known) / n, int((ids[1:] == ids[:-1]).sum()) / n,
        int(np.bincount(ids).max()) / n, np.log1p(n / len(lines)), text.count("|") / n,
        int((sizes == 1).sum()) / n, np.log1p(sizes.max())]
    return (n, chars, symbols, dup_lines, repeated), [float(x) for x in features]


def held_out() -> F.Column:
    """Rows never learned from: their id's checksum leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled ids to learn from, one row per id, some ``rows`` of them drawn by a hash."""
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out())
    count = usable.count()
    if count > rows:
        usable = usable.where(
            F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * rows / count))
    return usable.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in labels.columns if c != "doc_id"])


def labelled_texts(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text`` and the label columns; the sampled ids are few, so texts stay in place."""
    text_batches(docs.sparkSession)
    ids = keep_table(labelled_sample(labels, rows), "fit-ids")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def feature_rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        rows = [statistics(text)[1] for text in part["text"]]
        yield part.drop(columns=["text"]).assign(features=rows)


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, label, features``: one row per labelled id that has a document."""
    texts = labelled_texts(docs, labels.select("doc_id", F.col(label).cast("double").alias("label")), rows)
    made = texts.where("label IS NOT NULL").mapInPandas(feature_rows, StructType([
        texts.schema["doc_id"], *StructType.fromDDL("label double, features array<double>").fields]))
    return keep_table(made.groupBy("doc_id").agg(
        F.first("label").alias("label"), F.min("features").alias("features")), "fit-features")

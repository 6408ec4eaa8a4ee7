"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic steps.

Document statistics are standardised and mapped to ``COSINES`` random cosines, whose products
approximate a Gaussian kernel. Each partition sums its part of the normal equations, Spark adds
the parts up row by row, and the driver solves one small system. The remaining labelled rows
calibrate: their scores are counted into ``STEPS`` equal steps, so any number of rows gives at
most that many sums, and adjacent steps are pooled until the share of label 1 never falls.

A third of the labelled rows calibrates, the others fit; held-out rows do neither. Defined
results: a null or empty text is scored by its statistics, all 0; without labels of both kinds
every score is the share of label 1, or 0.5; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

from clickflow.llm.common import replace_columns, table, text_batches
from clickflow.llm.doc_stats import FEATURES, SAMPLE_ROWS, held_out, labelled_features, statistics

COSINES, WIDTH, RIDGE = 256, 3.0, 1.0
STEPS = 500
GOOD_FROM = 0.7
OUTER = 4.0  # standardised values are cut off here


@dataclass
class Classifier:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    shares: np.ndarray | None = None
    share: float = 0.5

    def cosines(self, rows: np.ndarray) -> np.ndarray:
        random = np.random.default_rng(1)
        turn = random.normal(0, 1 / (WIDTH * np.sqrt(rows.shape[1] / 6)), (rows.shape[1], COSINES))
        shift = random.uniform(0, 2 * np.pi, COSINES)
        flat = np.clip((rows - self.centre) / self.scale, -OUTER, OUTER)
        waves = np.sqrt(2 / COSINES) * np.cos(flat @ turn + shift)
        return np.concatenate([waves, flat, np.ones((len(rows), 1))], axis=1)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.cosines(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(rows), self.share)
        return np.interp(self.raw(rows), self.knots, self.shares)


def as_rows(features: pd.Series) -> np.ndarray:
    return np.array(features.tolist(), float).reshape(-1, len(FEATURES))


def standardised(rows: DataFrame) -> Classifier:
    """Mean and deviation of each feature over the fitting rows, in one aggregation."""
    parts = [f(F.col("features")[k]) for k in range(len(FEATURES)) for f in (F.avg, F.stddev_pop)]
    values = rows.agg(*[c.alias(f"v{k}") for k, c in enumerate(parts)]).first()
    numbers = np.array([0.0 if v is None else v for v in values])
    return Classifier(numbers[::2], np.maximum(numbers[1::2], 1e-6))


def normal_equations(rows: DataFrame, model: Classifier) -> np.ndarray:
    """Columns of X'X with X'y as the last one, summed by partition and then by row."""
    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for part in parts:
            x = model.cosines(as_rows(part["features"]))
            own = x.T @ np.column_stack([x, part["label"].to_numpy()])
            total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"line": range(len(total)), "sums": list(total)})

    def added(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": part["line"].iloc[:1], "sums": [np.sum(part["sums"].tolist(), axis=0)]})

    kind = "line int, sums array<double>"
    lines = rows.mapInPandas(partial, kind).groupBy("line").applyInPandas(added, kind).toPandas()
    return np.array(lines.sort_values("line")["sums"].tolist())


def pooled(counts: np.ndarray, goods: np.ndarray) -> np.ndarray:
    """Isotonic shares of label 1 for steps in rising order of score."""
    blocks: list[list[float]] = []
    for n, good in zip(counts, goods):
        blocks.append([n, good, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(width), (good + 0.5) / (n + 1)) for n, good, width in blocks])


def calibrated(rows: DataFrame, model: Classifier) -> Classifier:
    @F.pandas_udf(DoubleType())
    def raw(features: pd.Series) -> pd.Series:
        return pd.Series(model.raw(as_rows(features)))

    step = F.floor(F.least(F.greatest(raw("features"), F.lit(-0.5)), F.lit(1.5)) * (STEPS / 2))
    sums = rows.groupBy(step.alias("step")).agg(
        F.count("*").alias("n"), F.sum("label").alias("good")).orderBy("step").toPandas()
    if len(sums):
        shares = pooled(sums["n"].to_numpy(float), sums["good"].to_numpy(float))
        middle = (sums["step"].to_numpy(float) + 0.5) / (STEPS / 2)
        # a little of the plain order inside a pooled block, so that scores there differ
        model.knots = middle
        model.shares = np.clip(0.98 * np.maximum.accumulate(shares) + 0.02 * (middle + 0.5) / 2, 0, 1)
    else:
        model.knots, model.shares = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Classifier:
    sample = labelled_features(docs, labels, "quality", rows)
    apart = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)) == 0
    fit, rest = sample.where(~apart), sample.where(apart)
    model = standardised(fit)
    kinds = fit.agg(F.avg("label")).first()[0]
    if kinds is None or not 0 < kinds < 1:
        model.share = 0.5 if kinds is None else float(kinds)
        return model
    sums = normal_equations(fit, model)
    size = len(sums)
    model.weights = np.linalg.solve(sums[:, :size] + RIDGE * np.eye(size), sums[:, size])
    return calibrated(rest, model)


def scored(docs: DataFrame, model: Classifier, good_from: float = GOOD_FROM) -> DataFrame:
    """Every document with ``held_out, score, predicted``."""
    text_batches(docs.sparkSession)
    @F.pandas_udf(DoubleType())
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            rows = np.array([statistics(text)[1] for text in texts]).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(rows))

    rows = docs.withColumn("__score", score("text"))
    return replace_columns(rows, {
        "held_out": held_out(), "score": F.col("__score"),
        "predicted": (F.col("__score") >= good_from).cast("int")}).drop("__score")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scored(docs, fitted(docs, table(spark, folder, "labels"))).drop("text")

"""Quality rules: gradient-boosted trees over document statistics, with monotonic constraints.

Trees are fitted to ``labels.quality`` on histograms of a bounded sample of labelled rows (at
most some ``SAMPLE_ROWS``, never those held out), then flattened into numpy node arrays that
score all rows of a batch level by level. For the features in ``FALLING`` a larger value can
never raise the score: a split whose left side would be the lower one is not taken, and each
side's leaves stay on their side of the middle between the two.

A document is rejected by two plain rules (fewer than ``LEAST_WORDS`` words, or more than
``MOST_REPEATED`` percent of words in repeated five-word runs) or by the trees. Defined results:
null and empty texts fail the plain rules; without any usable labels the trees keep everything;
repeated rows get the same verdict; all other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from clickflow.llm.common import replace_columns, table, text_batches
from clickflow.llm.doc_stats import COUNTS, FEATURES, SAMPLE_ROWS, labelled_features, statistics

FALLING = ("symbols", "dup_lines", "repeat_words", "upper", "shouts", "twins", "bars")
TREES, LEVELS, BINS = 60, 4, 32
RATE, SMOOTH, LEAST_ROWS = 0.15, 5.0, 20
KEEP_FROM = 0.5
LEAST_WORDS, MOST_REPEATED = 10, 20


@dataclass
class Trees:
    """All trees' nodes in one array each; a leaf points to itself."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        line = np.arange(len(rows))[:, None]
        for _ in range(LEVELS):
            at = np.where(rows[line, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def best_split(gain_rows, grads, weights, codes, falling, low, high):
    """The best ``(gain, feature, bin, left value, right value)`` of a node's rows, or None."""
    best = None
    total_g, total_w = grads[gain_rows].sum(), weights[gain_rows].sum()
    for feature in range(codes.shape[1]):
        code = codes[gain_rows, feature]
        g = np.cumsum(np.bincount(code, grads[gain_rows], BINS))[:-1]
        w = np.cumsum(np.bincount(code, weights[gain_rows], BINS))[:-1]
        n = np.cumsum(np.bincount(code, minlength=BINS))[:-1]
        left = np.clip(g / (w + SMOOTH), low, high)
        right = np.clip((total_g - g) / (total_w - w + SMOOTH), low, high)
        fits = (n >= LEAST_ROWS) & (len(gain_rows) - n >= LEAST_ROWS)
        if falling[feature]:
            fits &= left >= right
        gain = np.where(fits, g * left - (w + SMOOTH) * left ** 2 / 2
                        + (total_g - g) * right - (total_w - w + SMOOTH) * right ** 2 / 2, -np.inf)
        k = int(gain.argmax())
        if np.isfinite(gain[k]) and (best is None or gain[k] > best[0]):
            best = (gain[k], feature, k, left[k], right[k])
    whole = np.clip(total_g / (total_w + SMOOTH), low, high)
    if best is None or best[0] <= total_g * whole - (total_w + SMOOTH) * whole ** 2 / 2 + 1e-9:
        return None
    return best


def fit_trees(rows: np.ndarray, labels: np.ndarray, names=FEATURES, falling=FALLING) -> Trees:
    """Boosted trees for the log-odds of label 1."""
    inner = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(rows.shape[1])]
    codes = np.stack([np.searchsorted(inner[f], rows[:, f], side="left") for f in range(rows.shape[1])], axis=1)
    must_fall = [name in falling for name in names]
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    odds = np.full(len(rows), start)
    feature, limit, left, right, value, roots = [], [], [], [], [], []

    def leaf(amount: float) -> int:
        feature.append(0), limit.append(np.inf), value.append(amount * RATE)
        left.append(len(left)), right.append(len(right))
        return len(value) - 1

    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-odds))
        grads, weights = labels - chance, chance * (1 - chance)
        amount = grads.sum() / (weights.sum() + SMOOTH)
        roots.append(leaf(amount))
        open_nodes = [(roots[-1], np.arange(len(rows)), -np.inf, np.inf)]
        for _ in range(LEVELS):
            below = []
            for node, mine, low, high in open_nodes:
                split = best_split(mine, grads, weights, codes, must_fall, low, high)
                if split is None or split[2] >= len(inner[split[1]]):
                    continue
                _, f, k, left_value, right_value = split
                feature[node], limit[node] = f, inner[f][k]
                left[node], right[node] = leaf(left_value), leaf(right_value)
                goes_left = codes[mine, f] <= k
                middle = (left_value + right_value) / 2
                bounds = ((middle, high), (low, middle)) if must_fall[f] else ((low, high), (low, high))
                below += [(left[node], mine[goes_left], *bounds[0]), (right[node], mine[~goes_left], *bounds[1])]
            open_nodes = below
        grown = Trees(*[np.array(x) for x in (feature, limit, left, right, value)], np.array(roots[-1:]), 0.0)
        odds += np.log(grown_odds(grown, rows))
    return Trees(*[np.array(x) for x in (feature, limit, left, right, value, roots)], start)


def grown_odds(trees: Trees, rows: np.ndarray) -> np.ndarray:
    chance = trees.score(rows)
    return chance / (1 - chance)


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees | None:
    sample = labelled_features(docs, labels, "quality", rows).orderBy("doc_id").toPandas()
    if sample["label"].nunique() < 2:
        return None
    return fit_trees(np.array(sample["features"].tolist()), sample["label"].to_numpy())


def judged(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """Every document with the counts, ``base_failed``, ``score`` and ``kept``."""
    text_batches(docs.sparkSession)
    added = [*COUNTS, "base_failed", "score", "kept"]
    types = [LongType()] * len(COUNTS) + [BooleanType(), DoubleType(), BooleanType()]

    @F.pandas_udf(StructType([StructField(n, t) for n, t in zip(added, types)]))
    def verdicts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            both = [statistics(text) for text in texts]
            frame = pd.DataFrame([counts for counts, _ in both], columns=list(COUNTS))
            rows = np.array([features for _, features in both]).reshape(-1, len(FEATURES))
            frame["base_failed"] = ((frame["n_words"] < LEAST_WORDS)
                                    | (100 * frame["n_repeat_words"] > MOST_REPEATED * frame["n_words"]))
            frame["score"] = trees.score(rows) if trees else 1.0
            frame["kept"] = ~frame["base_failed"] & (frame["score"] >= KEEP_FROM)
            yield frame

    rows = docs.withColumn("__verdict", verdicts("text"))
    return replace_columns(rows, {n: F.col(f"__verdict.{n}") for n in added}).drop("__verdict")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that neither the plain rules nor the trees reject, columns as they were."""
    texts = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), "text")
    return judged(texts, fitted(docs, labels)).where("kept").select("row.*")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return judged(docs, fitted(docs, table(spark, folder, "labels"))).drop("text")

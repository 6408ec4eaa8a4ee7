"""Toxicity by a classifier chain of linear models over word and prefix counts.

Categories are predicted in order; each model also sees the probabilities of the categories
before it. For fitting, those come out of fold: each row's probability is predicted by a model
that did not see the row, so that a later model meets what it will meet when scoring.

Features are the words of a text and their first four and six letters, hashed into buckets; for
each bucket whether it occurs once, twice, four times, or in every ``DENSE``-th word. Over the
labelled sample the ``FEATURES`` that differ most between toxic and other texts are chosen, and
logistic regressions with a ridge are fitted to them. There is no list of words: the labels know one
mark, so the two first categories of ``CATEGORIES`` are kinds of toxic texts found in the sample, those
that have the feature which most toxic texts have in place of others, and those that have the one that is most
common among the rest. The last category is the label itself.

Defined results: null and empty texts have no words and get the models' base probability; with
labels of one kind only the probabilities are that share; repeated rows score alike; whole texts
are read; of features that tell equally much the lower bucket counts; an empty table gives no rows. All
columns come back but ones named like an added one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clickflow.llm.common import keep_table, table, text_batches
from clickflow.llm.doc_stats import held_out, labelled_texts

CATEGORIES = ("first_kind", "second_kind", "toxic")
WORD = re.compile(r"\w+")
BUCKETS, LEVELS, DENSE = 1 << 17, 4, 100
FEATURES, FOLDS, RIDGE, STEPS = 300, 3, 1.0, 10
SAMPLE_ROWS = 20_000  # the bound on labelled rows that the chain is fitted on
TOXIC_FROM = 0.5
CACHE = 500_000


class Buckets:
    """Counts of hashed words and prefixes of a text, words met before from a bounded cache."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted = wanted  # the only buckets to count, or all
        self.known: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            grams = {"=" + word, *(word[:n] for n in (4, 6) if len(word) >= n)}
            found = {zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams}
            found = tuple(sorted(found if self.wanted is None else found & self.wanted))
            self.known[word] = found
        return found

    def counts(self, text: str | None) -> tuple[int, Counter]:
        words = Counter(WORD.findall((text or "").lower()))
        total: Counter = Counter()
        for word, n in words.items():
            for bucket in self.of(word):
                total[bucket] += n
        return sum(words.values()), total


def levels(n_words: int, count: int) -> list[int]:
    return [k for k, reached in enumerate(
        (True, count >= 2, count >= 4, count > 1 and count * DENSE >= n_words)) if reached]


def text_features(text: str | None, buckets: Buckets) -> tuple[int, list[int]]:
    """The number of words and the numbers ``bucket * LEVELS + level`` that hold."""
    n, counts = buckets.counts(text)
    return n, [b * LEVELS + k for b, count in counts.items() for k in levels(n, count)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``rows`` is 1."""
    weights = np.zeros(rows.shape[1])
    ridge = np.full(rows.shape[1], RIDGE)
    ridge[-1] = 1e-6
    share = np.clip(labels.mean(), 1e-4, 1 - 1e-4)
    weights[-1] = np.log(share / (1 - share))
    if labels.min() == labels.max():
        return weights
    for _ in range(STEPS):
        chance = sigmoid(rows @ weights)
        slope = rows.T @ (labels - chance) - ridge * weights
        curve = (rows * (chance * (1 - chance))[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-3:
            break
    return weights


@dataclass
class Chain:
    chosen: dict[int, int]
    weights: list[np.ndarray] = field(default_factory=list)

    def matrix(self, rows: list[tuple[int, list[int]]]) -> np.ndarray:
        """One column for each chosen feature, one for the length."""
        x = np.zeros((len(rows), len(self.chosen) + 1))
        for k, (n, features) in enumerate(rows):
            x[k, -1] = np.log1p(n) / 5
            for f in features:
                if f in self.chosen:
                    x[k, self.chosen[f]] = 1
        return x

    def fit(self, x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> None:
        for category in range(labels.shape[1]):
            y, full = labels[:, category], np.column_stack([x, np.ones(len(x))])
            unseen = np.zeros(len(x))
            for fold in range(FOLDS):
                mine = folds == fold
                if mine.any() and not mine.all():
                    unseen[mine] = sigmoid(full[mine] @ fit_linear(full[~mine], y[~mine]))
            self.weights.append(fit_linear(full, y))
            x = np.column_stack([x, unseen])

    def score(self, x: np.ndarray) -> np.ndarray:
        for weights in self.weights:
            x = np.column_stack([x, sigmoid(np.column_stack([x, np.ones(len(x))]) @ weights)])
        return x[:, -len(self.weights):]


def labelled_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, toxic, n_words, features`` of the sampled labelled texts."""
    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for part in parts:
            made = [(doc_id, float(toxic), *text_features(text, buckets))
                    for doc_id, text, toxic in zip(part["doc_id"], part["text"], part["toxic"])]
            yield pd.DataFrame(made, columns=["doc_id", "toxic", "n_words", "features"])

    texts = labelled_texts(docs, labels.select("doc_id", "toxic").where("toxic IS NOT NULL"), rows)
    kind = StructType([texts.schema["doc_id"], *StructType.fromDDL(
        "toxic double, n_words bigint, features array<int>").fields])
    return keep_table(texts.mapInPandas(read, kind), "toxic-rows")


def kinds_of_toxic(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The labels of all categories, from the matrix of chosen features (without the length).

    A kind's feature is the one whose share among the toxic texts not yet of a kind exceeds its share among
    other texts by most.
    """
    labels, left = [], toxic > 0
    usual = x[toxic == 0].mean(axis=0) if (toxic == 0).any() else np.zeros(x.shape[1])
    for _ in CATEGORIES[:-1]:
        mine = np.zeros(len(x), bool)
        if x.shape[1] and left.any():
            mine = left & (x[:, (x[left].mean(axis=0) - usual).argmax()] > 0)
        labels.append(mine)
        left = left & ~mine
    return np.column_stack([*labels, toxic > 0]).astype(float)


def telling_features(rows: DataFrame, count: int = FEATURES) -> dict[int, int]:
    """The features with the largest standard score between toxic and other rows."""
    sizes = rows.agg(F.sum("toxic"), F.count("*")).first()
    toxic, total = float(sizes[0] or 0), float(sizes[1])
    if not 0 < toxic < total:
        return {}
    per = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("bad"), F.count("*").cast("double").alias("all")).where("all >= 5")
    share = F.col("all") / total
    score = F.abs(F.col("bad") / toxic - (F.col("all") - F.col("bad")) / (total - toxic)) / F.sqrt(
        (share * (1 - share) + 1 / total) * (1 / toxic + 1 / (total - toxic)))
    best = per.select("feature", score.alias("score")).orderBy(F.desc("score"), "feature").limit(count)
    return {r.feature: k for k, r in enumerate(best.collect())}


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Chain:
    sample = labelled_rows(docs, labels, rows)
    chain = Chain(telling_features(sample))
    wanted = F.array(*[F.lit(f) for f in chain.chosen]) if chain.chosen else F.array().cast("array<int>")
    local = sample.select("doc_id", "toxic", "n_words", F.array_intersect(
        "features", wanted).alias("features")).dropDuplicates(["doc_id"]).orderBy("doc_id").toPandas()
    if not len(local):
        local = pd.DataFrame([(0, 0.0, 0, [])], columns=local.columns)
    folds = np.array([zlib.crc32(b"fold%d" % k) % FOLDS for k in range(len(local))])
    x = chain.matrix(list(zip(local["n_words"], local["features"])))
    chain.fit(x, kinds_of_toxic(x[:, :-1], local["toxic"].to_numpy(float)), folds)
    return chain


def scored(docs: DataFrame, chain: Chain, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Every document with ``p_first, p_second, score`` and ``toxic`` (1 or 0)."""
    text_batches(docs.sparkSession)

    @F.pandas_udf(StructType([StructField(c, DoubleType()) for c in CATEGORIES]))
    def chances(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        buckets = Buckets({feature // LEVELS for feature in chain.chosen})
        for texts in parts:
            x = chain.matrix([text_features(text, buckets) for text in texts])
            yield pd.DataFrame(chain.score(x), columns=list(CATEGORIES))

    added = {"held_out": F.col("held"), "p_first": F.col("chances")[CATEGORIES[0]],
             "p_second": F.col("chances")[CATEGORIES[1]], "score": F.col("chances.toxic"),
             "toxic": (F.col("chances.toxic") >= toxic_from).cast("int")}
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), held_out().alias("held"),
                       chances("text").alias("chances"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added],
                       *[value.alias(name) for name, value in added.items()])


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scored(docs, fitted(docs, table(spark, folder, "labels"))).drop("text")

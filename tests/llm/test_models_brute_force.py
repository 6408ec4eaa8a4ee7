"""The fitted models against the same fits and scores in plain loops over the whole smallest table."""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from clickflow.llm import quality_classifier as op1
from clickflow.llm import quality_rules as op7
from clickflow.llm import toxicity as op8
from clickflow.llm.doc_stats import statistics

TINY = "/root/testdata/sf0.001"


def read(spark, name):
    return spark.read.parquet(f"{TINY}/{name}.parquet")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def isotonic(counts, goods):
    """The blocks of the closest rising steps, by the largest least mean."""
    means = [max(min(sum(goods[i:j + 1]) / sum(counts[i:j + 1]) for j in range(k, len(counts)))
                 for i in range(k + 1)) for k in range(len(counts))]
    shares = []
    for mean in means:
        mine = [k for k, m in enumerate(means) if math.isclose(m, mean, abs_tol=1e-12)]
        shares.append((sum(goods[k] for k in mine) + 0.5) / (sum(counts[k] for k in mine) + 1))
    return shares


def test_quality_scores_equal_a_plain_fit(spark):
    texts = {r.doc_id: r.text for r in read(spark, "documents").collect()}
    labels = {r.doc_id: r.quality for r in read(spark, "labels").collect()
              if r.quality is not None and not held_out(r.doc_id) and r.doc_id in texts}
    apart = {r.doc_id for r in read(spark, "labels").where(
        F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)) == 0).collect()}
    features = {i: np.array(statistics(t)[1], float) for i, t in texts.items()}
    fit = [i for i in labels if i not in apart]
    rows = np.array([features[i] for i in fit])
    centre, scale = rows.mean(axis=0), np.maximum(rows.std(axis=0), 1e-6)
    random = np.random.default_rng(1)
    turn = random.normal(0, 1 / (op1.WIDTH * math.sqrt(rows.shape[1] / 6)), (rows.shape[1], op1.COSINES))
    shift = random.uniform(0, 2 * math.pi, op1.COSINES)

    def mapped(row):
        flat = np.clip((row - centre) / scale, -op1.OUTER, op1.OUTER)
        return np.array([*(math.sqrt(2 / op1.COSINES) * np.cos(flat @ turn + shift)), *flat, 1.0])
    x, y = np.array([mapped(features[i]) for i in fit]), np.array([labels[i] for i in fit], float)
    wide = np.vstack([x, math.sqrt(op1.RIDGE) * np.eye(x.shape[1])])
    weights = np.linalg.lstsq(wide, np.concatenate([y, np.zeros(x.shape[1])]), rcond=None)[0]
    steps = {}
    for i in set(labels) & apart:
        step = math.floor(min(max(mapped(features[i]) @ weights, -0.5), 1.5) * op1.STEPS / 2)
        n, good = steps.get(step, (0, 0))
        steps[step] = n + 1, good + labels[i]
    order = sorted(steps)
    middle = np.array([(k + 0.5) / (op1.STEPS / 2) for k in order])
    shares = np.maximum.accumulate(isotonic([steps[k][0] for k in order], [steps[k][1] for k in order]))
    shares = np.clip(0.98 * shares + 0.02 * (middle + 0.5) / 2, 0, 1)
    found = op1.op1_quality(spark, TINY).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r.held_out == held_out(r.doc_id)
        assert abs(r.score - np.interp(mapped(features[r.doc_id]) @ weights, middle, shares)) < 1e-6
        assert r.predicted == (r.score >= 0.7)


def test_rule_verdicts_equal_walks_through_the_trees(spark):
    docs = read(spark, "documents").select("doc_id", "text")
    trees = op7.fitted(docs, read(spark, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}

    def score(row):
        odds = trees.start
        for node in trees.roots:
            while trees.left[node] != node:  # a leaf points to itself
                node = (trees.left if row[trees.feature[node]] <= trees.limit[node] else trees.right)[node]
            odds += trees.value[node]
        return 1 / (1 + math.exp(-odds))
    for r in op7.judged(docs, trees).collect():
        counts, row = statistics(texts[r.doc_id])
        assert abs(r.score - score(row)) < 1e-9
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= op7.KEEP_FROM)


def test_toxic_scores_equal_a_plain_chain(spark):
    docs = read(spark, "documents").select("doc_id", "text")
    chain = op8.fitted(docs, read(spark, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(chain.weights) == 3 and len(chain.chosen) > 5
    for r in op8.scored(docs, chain).collect():
        n, features = op8.text_features(texts[r.doc_id], op8.Buckets())
        row = [0.0] * len(chain.chosen) + [math.log1p(n) / 5]
        for feature in features:
            if feature in chain.chosen:
                row[chain.chosen[feature]] = 1.0
        for weights in chain.weights:
            row.append(1 / (1 + math.exp(-sum(a * b for a, b in zip([*row, 1.0], weights)))))
        assert np.allclose(row[-3:], [r.p_first, r.p_second, r.score], atol=1e-9)

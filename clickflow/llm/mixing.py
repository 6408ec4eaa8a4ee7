"""Mixing sources to target weights: whole repetitions plus one drawn by a seeded hash.

Sizes are summed per source, each source gets a target, and ``rate = target / size`` is a
source's repetition rate. A document comes ``floor(rate)`` times, and once more if its draw, its own
seeded hash read as a number in [0, 1), is low enough. Over all seeds that happens with the
probability of the rate's fraction, but the draws of a source are not left to chance each: the limit
is put where the words below it, in the order of the draws, come nearest to what the source still
lacks, so a source misses its target by about one document, however few it has. For that, words are
summed by source and draw in ``BINS`` bins; one row per source goes back to the documents.

Defined results: a null text has size 0, a null source is a source of its own and the last, an
empty source has target 0, rows that agree in doc_id and text share one draw, an empty table
gives an empty table; very long texts are counted whole, and equal draws are taken together or not at
all. ``mix`` gives all columns of the input back; only one named ``copy`` gives way to the added one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clickflow.llm.common import WORD, keep_table, small_side, table

SEED = "mix-1"
WEIGHTS = (1, 2, 3)
MOST = 3.0
DRAWS = 16 ** 8
BINS = 1 << 16


def word_count(text: str | Column = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """``(source, words)`` with its target: shares by weight, none above ``most`` times its words.

    The excess of full sources goes to the others by weight until none is above. Put in order
    of ``most * words / weight``, sources fill up one after the other; with the first k full,
    the others would get ``level_k`` per unit of weight. The level rises with k while sources
    are full and falls after, so the largest is the one that holds. One row per source passes
    one task here, whatever the number of documents.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("room", "place")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    return (
        sources.withColumn("place", F.row_number().over(names) - 1)
        .withColumn("weight", weight)
        .withColumn("full", F.col("words") * F.lit(float(most)))
        .withColumn("room", F.col("full") / F.col("weight"))
        .withColumn("level", (
            F.sum("words").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0)))
            / (F.sum("weight").over(everything)
               - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("level", F.max("level").over(everything))
        .select("source", "words", F.least("full", F.col("level") * F.col("weight")).alias("target"))
    )


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the document's id and text."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")),
                      F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(float(DRAWS))


def draw_limits(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with ``whole``, how often each document comes at least, and ``limit``, the bin of
    draws from which on it does not come once more. ``drawn`` has ``source, size, bin``."""
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    lacking = targets.withColumn("whole", F.floor(rate)).withColumn(
        "lacks", F.col("target") - F.col("whole") * F.col("words"))
    so_far = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = drawn.groupBy("source", "bin").agg(F.sum("size").alias("step")) \
        .withColumn("taken", F.sum("step").over(so_far)).withColumnRenamed("source", "__of")
    nearest = F.min(F.struct(F.abs(F.col("taken") - F.col("lacks")).alias("off"), (F.col("bin") + 1).alias("limit")))
    met = lacking.join(steps, F.col("source").eqNullSafe(F.col("__of"))).groupBy("source").agg(
        nearest.alias("nearest")).withColumnRenamed("source", "__of")
    return lacking.join(met, F.col("source").eqNullSafe(F.col("__of")), "left").select(
        "source", "words", "target", "whole",
        F.when(F.col("nearest.off") < F.col("lacks"), F.col("nearest.limit")).otherwise(0).alias("limit"))


def planned(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """``row`` (the whole row), ``size, source_size, target, copies`` for every document."""
    bin_of = F.floor(draw(F.col("row.doc_id"), F.col("row.text"), seed) * BINS)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    sized = rows.withColumn("size", word_count(F.col("row.text"))).withColumn("bin", bin_of)
    drawn = keep_table(sized.select(F.col("row.source").alias("source"), "size", "bin"), "mix-draws")
    sizes = drawn.groupBy("source").agg(F.sum("size").alias("words"))
    targets = keep_table(source_targets(sizes, weights, most), "mix-targets")
    limits = keep_table(draw_limits(drawn, targets), "mix-limits")
    joined = sized.join(small_side(limits, limits.count()), F.col("row.source").eqNullSafe(F.col("source")))
    return joined.select("row", "size", F.col("words").alias("source_size"), "target",
                         (F.col("whole") + (F.col("bin") < F.col("limit")).cast("bigint")).alias("copies"))


def plan_mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """Every document with ``size, source_size, target, copies``, which replace columns of these names."""
    found = planned(docs, seed, weights, most)
    added = ["size", "source_size", "target", "copies"]
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added], *added)


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """The mixed documents, each as often as planned, numbered from 1 in ``copy``."""
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    found = planned(docs, seed, weights, most).where("copies > 0").select("row", copies.alias("copy"))
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "copy"], "copy")


def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = plan_mix(docs)
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"), "copies")


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         floor(('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':'
                                   || md5(coalesce(text, ''))), 1, 8))::BIGINT / {float(DRAWS)} * {BINS}) AS bin
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source),
w AS (SELECT source, words,
        ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
        row_number() OVER (ORDER BY source ASC NULLS LAST) AS place FROM s),
l AS (SELECT *, words * 3.0::DOUBLE AS cap,
        (sum(words::DOUBLE) OVER ()
         - coalesce(sum(words * 3.0::DOUBLE) OVER before, 0)) /
        (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
      FROM w WINDOW before AS (ORDER BY words * 3.0::DOUBLE / weight, place
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, words, least(cap, max(level) OVER () * weight) AS target FROM l),
r AS (SELECT *, floor(CASE WHEN words > 0 THEN target / words ELSE 0 END)::BIGINT AS whole,
        target - whole * words AS lacks FROM t),
n AS (SELECT source, bin, sum(sum(size)) OVER (PARTITION BY source ORDER BY bin) AS taken
      FROM d GROUP BY source, bin),
m AS (SELECT r.source, min({{'off': abs(taken - lacks), 'limit': bin + 1}}) AS nearest
      FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source GROUP BY r.source),
p AS (SELECT r.*, CASE WHEN nearest.off < lacks THEN nearest.limit ELSE 0 END AS top
      FROM r JOIN m ON r.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, words AS source_size, target,
       size * (whole + (bin < top)::BIGINT) AS taken, whole + (bin < top)::BIGINT AS copies
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
"""

"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become words. Of each ``WINDOW - GRAM + 1`` consecutive word k-grams the smallest hash is
a fingerprint, so any run of ``WINDOW`` words that a document shares with an item gives both the
same fingerprint: no shared window is missed. Items of fewer words are one window each; for
each such length the fingerprints are the hashes of all runs of that many words. Documents that
share a fingerprint are hits, and only these are extended: their windows, as texts, are joined
with the items' windows, and the words inside any common window are counted.

Fingerprints of documents are only shuffled when the benchmark is too large to be broadcast.
What is gathered per document is bounded by its own length and by the items.

Defined results: a null text has no words; items without words match nothing; rows that agree in
doc_id and text are judged once and returned as often as they came; items with the same id
count once and a null item id reads ``null``; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.llm.common import ascii_lower, keep_table, small_side, table

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW, GRAM = 10, 5


def words_of(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def runs(words: str, length: int, make) -> Column:
    """``make`` over every run of ``length`` consecutive words, in order."""
    count = F.size(words) - (length - 1)
    return F.when(count > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: make(F.slice(words, i, F.lit(length))))).otherwise(F.array())


def winnowed(grams: str, span: int) -> Column:
    """The smallest of each ``span`` neighbouring hashes, each value once."""
    count = F.size(grams) - (span - 1)
    return F.when(count > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
        lambda i: F.array_min(F.slice(grams, i, F.lit(span)))))).otherwise(F.array())


def fingerprints(rows: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """Rows with ``words`` get the array ``prints``; ``short`` are lengths below the window."""
    rows = rows.withColumn("grams", runs("words", gram, F.xxhash64))
    prints = [winnowed("grams", window - gram + 1)]
    prints += [runs("words", n, lambda run, n=n: F.xxhash64(F.lit(n), run)) for n in short]
    joined = F.array_distinct(F.concat(*prints)) if short else prints[0]
    return rows.withColumn("prints", joined).drop("grams")


def windows(lengths: list[int]) -> Column:
    """Every run of each length as ``(first, length, run)``, positions counted from 1."""
    def of(length: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("words") - (length - 1), F.lit(1))),
            lambda i: F.struct(i.alias("first"), F.lit(length).alias("length"), F.when(
                F.size("words") >= length,
                F.array_join(F.slice("words", i, F.lit(length)), " ")).alias("run")))
    return F.concat(*[of(length) for length in lengths])


def text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  gram: int = GRAM) -> DataFrame:
    """``doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        words_of("text").alias("words")).where(F.size("words") > 0)
    items = keep_table(items.withColumn("length", F.least(F.size("words"), F.lit(window))), "leak-items")
    short = sorted(r.length for r in items.where(F.col("length") < window).select("length").distinct().collect())
    whole = fingerprints(items.where(F.col("length") == window), [], window, gram).select(
        F.explode("prints").alias("print"))
    brief = items.where(F.col("length") < window).select(F.xxhash64("length", "words").alias("print"))
    known = keep_table(whole.union(brief).distinct(), "leak-prints")

    texts = docs.select("doc_id", text_key().alias("text_key"), "text")
    read = texts.select("doc_id", "text_key", words_of("text").alias("words"))
    read = fingerprints(read, short, window, gram).select(
        "doc_id", "text_key", F.size("words").cast("bigint").alias("n_words"),
        F.posexplode_outer("prints").alias("place", "print"))
    marked = known.withColumn("hit", F.lit(True))
    found = read.join(small_side(marked, known.count()), "print", "left").groupBy("doc_id", "text_key").agg(
        F.max("n_words").alias("n_words"), F.coalesce(F.max("hit"), F.lit(False)).alias("hit"),
        F.sum((F.coalesce("place", F.lit(0)) == 0).cast("bigint")).alias("rows"))
    found = keep_table(found, "leak-found")

    hits = found.where("hit").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    lengths = [*short, window]
    item_runs = keep_table(items.select("item", "words", "length").select(
        "item", "length", F.explode(windows(lengths)).alias("w")).where(
            "w.length = length AND w.run IS NOT NULL").select("item", "w.run").distinct(), "leak-runs")
    extended = (
        texts.join(small_side(hits, hits.count()), F.col("doc_id").eqNullSafe(F.col("id"))
                   & (F.col("text_key") == F.col("key")))
        .select("id", "key", words_of("text").alias("words"))
        .select("id", "key", F.explode(windows(lengths)).alias("w")).select("id", "key", "w.*")
        .join(small_side(item_runs, item_runs.count()), "run")
        .groupBy("id", "key").agg(
            F.collect_set(F.struct("first", "length")).alias("spans"), F.collect_set("item").alias("items")))
    covered = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["first"], s["first"] + s["length"] - 1))))
    counted = keep_table(extended.select(
        "id", "key", F.size(covered).cast("bigint").alias("hit_words"),
        F.size("items").cast("bigint").alias("hit_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("digest")), "leak-counted")
    n_hit = F.coalesce("hit_words", F.lit(0).cast("bigint"))
    return (
        found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
        .join(counted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
        .select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
                F.coalesce("hit_items", F.lit(0).cast("bigint")).alias("n_items"),
                F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                (n_hit > 0).alias("contaminated")))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that share no window with the benchmark, all their columns as they were."""
    leaks = keep_table(contamination(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct(), "leak-rows")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("of"), text_key().alias("text_key"))
    return rows.join(small_side(leaks, leaks.count()), F.col("of").eqNullSafe(F.col("id"))
                     & (F.col("text_key") == F.col("key")), "left_anti").select("row.*")


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents").select("doc_id", "text"),
                          table(spark, folder, "benchmark").select("item_id", "text"))
    return found.drop("text_key")


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM benchmark),
n AS (SELECT DISTINCT least(len(w), {WINDOW})::BIGINT AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, least(len(w), {WINDOW})::BIGINT AS n,
         unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS run FROM bi),
di AS (SELECT row, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM d CROSS JOIN n),
dw AS (SELECT row, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS run FROM di),
m AS (SELECT row, i, dw.n, item FROM dw JOIN bw USING (run)),
c AS (SELECT row, count(DISTINCT p)::BIGINT AS n_hit
      FROM (SELECT row, unnest(range(i, i + n)) AS p FROM m) GROUP BY row),
t AS (SELECT row, count(*)::BIGINT AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT row, item FROM m) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN t USING (row)
"""

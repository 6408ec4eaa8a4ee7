"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it as context, and only
its own text trainable. What follows the last assistant turn, or a conversation without one,
gives one more example with nothing to train, so no turn is lost.

A turn is written ``<s>[role]text</s>``. Inside roles and texts, backslash, ``<``, ``[`` and
``]`` are written as a backslash and a letter, so no control string can come from a text. Each
backslash there is followed by its letter, which makes the way back exact.

Defined results: null roles and texts are empty, turns go by (turn, role, text) with null turn
numbers first, repeated rows are turns of their own, rows without conv_id are one conversation,
an empty table gives no example. One example holds one conversation's turns up to its target:
that is the unit of the output, and the only thing put together per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.llm.common import table

BEGIN, END = "<s>", "</s>"
TARGET_ROLE = "assistant"
CODES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"), ("]", "\\e"))


def escape(text: Column) -> Column:
    for mark, code in CODES:
        text = F.replace(text, F.lit(mark), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for mark, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(mark))
    return text


def expand(conversations: DataFrame) -> DataFrame:
    """Rows by turn to ``(conv_id, example, formatted, loss_start, loss_end)``.

    ``example`` counts from 0. The loss mask is the code points from ``loss_start`` up to
    before ``loss_end``; both are null where nothing is trained.
    """
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    written = turns.select(
        "conv_id",
        F.transform("turns", lambda t: (t["role"] == TARGET_ROLE)).alias("trained"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.transform("turns", lambda t: F.concat(
            F.lit(BEGIN + "["), escape(t["role"]), F.lit("]"), escape(t["text"]),
            F.lit(END))).alias("pieces"))
    ends = F.filter(F.sequence(F.lit(1), F.size("pieces")),
                    lambda i: F.element_at("trained", i) | (i == F.size("pieces")))
    examples = written.select("*", F.posexplode(ends).alias("example", "last"))
    text = F.array_join(F.slice("pieces", F.lit(1), F.col("last")), "")
    stop = F.when(F.element_at("trained", F.col("last")), F.length("formatted") - len(END))
    return (
        examples.withColumn("formatted", text)
        .select("conv_id", F.col("example").cast("bigint").alias("example"), "formatted",
                (stop - F.element_at("lengths", F.col("last"))).cast("bigint").alias("loss_start"),
                stop.cast("bigint").alias("loss_end")))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example as an array of ``(role, text)``."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    shape = r"(?s)^<s>\[([^\]]*)\](.*)$"
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, shape, 1)).alias("role"),
        unescape(F.regexp_extract(p, shape, 2)).alias("text")))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, TARGET_ROLE, tricky)], given.schema)
    examples = expand(given.unionByName(extra))
    loss = F.coalesce(unescape(F.col("formatted").substr(
        F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))), F.lit(""))
    read = examples.select("conv_id", "example", "formatted", loss.alias("loss")).groupBy("conv_id").agg(
        F.max(F.struct("example", "formatted"))["formatted"].alias("whole"),
        F.sort_array(F.collect_list(F.struct("example", "loss"))).alias("losses"),
        F.sum(F.length("formatted")).alias("formatted_chars"))
    read = read.select(
        "conv_id", "formatted_chars", read_turns(F.col("whole")).alias("turns"),
        F.array_join(F.transform("losses", lambda x: x["loss"]), "").alias("loss"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(9 + length(role) + length(text)
          + length(regexp_replace(role || text, '[^\\<\[\]]', '', 'g'))) OVER w AS upto
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                      ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

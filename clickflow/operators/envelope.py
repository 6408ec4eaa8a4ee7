"""Click envelopes: building them, parsing them, and telling bad ones apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from clickflow.functions.calendar import FIRST_MS, LAST_MS
from clickflow.functions.text import to_long
from clickflow.schemas import CLICK_FIELDS, ENVELOPE_TEXT, text_struct

CORRUPT = "_unparsed"


def parse_json(text, schema: StructType) -> Column:
    """A struct read from JSON text; the field ``_unparsed`` holds the text if it is no object.

    Unquoted names and single quotes are accepted.
    """
    wanted = StructType(list(schema.fields)).add(CORRUPT, StringType())
    options = {
        "allowUnquotedFieldNames": "true",
        "allowSingleQuotes": "true",
        "columnNameOfCorruptRecord": CORRUPT,
    }
    return F.from_json(text, wanted, options)


def parse_once(df: DataFrame, text: str, schema: StructType, name: str) -> DataFrame:
    """Adds the parsed struct as a column that the optimizer cannot copy.

    A later filter on a plain parsed column would be moved below it and parse every record
    again for each field it looks at; it cannot be moved below a generated row.
    """
    return df.select("*", F.explode(F.array(parse_json(F.col(text), schema))).alias(name))


def build_envelopes(clicks: DataFrame, body: str, sent_ms: str | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Wraps raw click text as ``{count, message, timeStamp}`` JSON in a column ``value``.

    The send time is a column of epoch milliseconds; without one it is the current time.
    """
    at = F.col(sent_ms) if sent_ms else F.unix_millis(F.current_timestamp())
    envelope = F.struct(
        F.lit(1).alias("count"),
        F.col(body).alias("message"),
        at.cast("bigint").alias("timeStamp"),
    )
    return clicks.select(*keep, F.to_json(envelope).alias("value"))


def parse_envelopes(raw: DataFrame, value: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope text to ``message``, ``count``, ``timeStamp``; unusable fields are null."""
    rows = raw.select(*keep, F.col(value).alias("_raw"))
    return (
        parse_once(rows, "_raw", ENVELOPE_TEXT, "_envelope")
        .select(
            *keep, "_raw",
            F.col("_envelope.message").alias("message"),
            to_long("_envelope.count").alias("count"),
            to_long("_envelope.timeStamp").alias("timeStamp"),
            (F.col("_envelope").isNull() | F.col(f"_envelope.{CORRUPT}").isNotNull())
            .alias("_outerBad"),
        )
    )


def parse_click_text(df: DataFrame, message: str = "message",
                     fields: list[str] = CLICK_FIELDS) -> DataFrame:
    """Adds ``clickLog``, the text fields of a click, null where the JSON has none."""
    return (
        parse_once(df, message, text_struct(fields), "_click")
        .withColumn("_innerBad",
                    F.col("_click").isNull() | F.col(f"_click.{CORRUPT}").isNotNull())
        .withColumn("clickLog", F.struct(*[F.col(f"_click.{n}").alias(n) for n in fields]))
        .drop("_click")
    )


def bad_reason() -> Column:
    """Why a parsed record cannot be used, null for a good one."""
    return (
        F.when(F.col("_outerBad"), "envelope is not a JSON object")
        .when(F.col("message").isNull(), "message is missing")
        .when(F.col("_innerBad"), "message is not a JSON object")
        .when(F.col("count").isNull(), "count is missing or no number")
        .when(F.col("timeStamp").isNull(), "timeStamp is missing or no number")
        .when(~F.col("timeStamp").between(FIRST_MS, LAST_MS), "timeStamp is out of range")
    )


def parse_messages(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ("seq",),
                   mode: str = "quarantine", fields: list[str] = CLICK_FIELDS) -> DataFrame:
    """Raw envelope text to ``(clickLog, count, timeStamp)`` with a ``badReason``.

    Name the click ``fields`` that are needed and the others are not taken out of the text.
    ``mode="failfast"`` stops the job at the first bad record instead of marking it.
    """
    if mode not in ("quarantine", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    parsed = parse_click_text(parse_envelopes(raw, value, keep), fields=fields)
    reason = bad_reason()
    if mode == "failfast":
        stop = F.raise_error(F.concat(reason, F.lit(": "), F.coalesce("_raw", F.lit("null"))))
        parsed = parsed.where(F.when(reason.isNotNull(), stop.cast("boolean")).otherwise(True))
    return parsed.select(*keep, "clickLog", "count", "timeStamp",
                         F.col("_raw").alias("raw"), reason.alias("badReason"))


def good_messages(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("badReason").isNull()).drop("badReason", "raw")


def bad_messages(messages: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The quarantine side: untouched text and the reason."""
    return messages.where(F.col("badReason").isNotNull()).select(*keep, "raw", "badReason")


def flatten_messages(messages: DataFrame, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Messages to flat clicks: their text fields, ``count`` and ``timestamp``."""
    return messages.select(*keep, "clickLog.*", "count", F.col("timeStamp").alias("timestamp"))

"""Database change entries: filters, flattening to one record per row, and topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickflow.operators.envelope import CORRUPT, parse_once
from clickflow.operators.numbering import number_in_order
from clickflow.schemas import CHANGE_ENTRY, CHANGE_RECORD
from clickflow.session import keep_table

# Entry types that only mark transactions.
TRANSACTION_MARKERS = ["TRANSACTIONBEGIN", "TRANSACTIONEND"]

# The subscription that takes in every table.
ALL_TABLES = r".*\..*"


def parse_entries(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON change entries to their fields; ``badReason`` tells which could not be read."""
    texts = raw.select(*keep, F.col(value).alias("raw"))
    rows = parse_once(texts, "raw", CHANGE_ENTRY, "_entry")
    unread = F.col("_entry").isNull() | F.col(f"_entry.{CORRUPT}").isNotNull()
    reason = (F.when(unread, "entry is not a JSON object")
              .when(F.col("_entry.entryType").isNull(), "entryType is missing")
              .when(~F.col("_entry.entryType").isin(TRANSACTION_MARKERS)
                    & F.col("_entry.header").isNull(), "header is missing")
              .when(~F.col("_entry.entryType").isin(TRANSACTION_MARKERS)
                    & F.col("_entry.header.schemaName").isNull(), "schemaName is missing")
              .when(~F.col("_entry.entryType").isin(TRANSACTION_MARKERS)
                    & F.col("_entry.header.tableName").isNull(), "tableName is missing"))
    return rows.select(*keep, "raw", *[F.col(f"_entry.{n}").alias(n) for n in CHANGE_ENTRY.names],
                       reason.alias("badReason"))


def good_entries(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("badReason").isNull()).drop("badReason", "raw")


def bad_entries(entries: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return entries.where(F.col("badReason").isNotNull()).select(*keep, "raw", "badReason")


def drop_transaction_markers(entries: DataFrame) -> DataFrame:
    kind = F.col("entryType")
    return entries.where(kind.isNull() | ~kind.isin(TRANSACTION_MARKERS))


def subscribe(entries: DataFrame, pattern: str = ALL_TABLES) -> DataFrame:
    """Entries whose ``schema.table`` matches a pattern as a whole."""
    name = F.concat_ws(".", "header.schemaName", "header.tableName")
    return entries.where(name.rlike(f"^(?:{pattern})$"))


def number_batches(entries: DataFrame, batch: str = "batchId") -> DataFrame:
    """Adds ``emptyCount``: 1 for the first fetch batch that held entries, 2 for the next, ...

    Markers and unreadable entries count as entries, so number the raw texts, before anything
    is parsed or dropped. Only the distinct batch ids are numbered, once, in a table of their
    own. Entries without a batch id stay and get no number.
    """
    ids = entries.select(batch).where(F.col(batch).isNotNull()).distinct()
    numbers = number_in_order(keep_table(ids, "batch-ids"), batch, "emptyCount")
    numbers = numbers.withColumn("emptyCount", F.col("emptyCount").cast("int"))
    return entries.join(keep_table(numbers, "batch-numbers"), batch, "left")


def row_image() -> Column:
    """A deleted row as it was before; any other row as it is after."""
    return (F.when(F.col("eventType") == "DELETE", F.col("_row.beforeColumns"))
            .otherwise(F.col("_row.afterColumns")))


def column_values(columns: Column) -> Column:
    """Every column of a row, changed or not, with the changed mark as ``isValid``."""
    return F.transform(columns, lambda c: F.struct(
        c["name"].alias("columnName"), c["value"].alias("columnValue"),
        c["updated"].alias("isValid")))


def flatten_entries(entries: DataFrame) -> DataFrame:
    """One record per row image, in the eight fields of a change record, plus ``rowIndex``."""
    rows = drop_transaction_markers(entries).select(
        "header", "eventType", "emptyCount", F.posexplode("rowDatas").alias("rowIndex", "_row"))
    return rows.select(
        F.col("header.logfileName").alias("logFileName"),
        F.col("header.logfileOffset").alias("logFileOffset"),
        F.col("header.schemaName").alias("dbName"),
        F.col("header.tableName").alias("tableName"),
        "eventType",
        column_values(row_image()).alias("columnValueList"),
        "emptyCount",
        F.col("header.executeTime").alias("timestamp"),
        "rowIndex")


def topic_records(records: DataFrame, key: str = "position") -> DataFrame:
    """Change records as ``(key, value)`` topic records, the value being JSON.

    ``key="position"`` hashes log file, offset and row index, so a replay sends the same key;
    ``key="random"`` gives each record a random UUID.
    """
    if key not in ("position", "random"):
        raise ValueError(f"unknown key {key!r}")
    position = F.sha2(F.concat_ws(":", "logFileName", "logFileOffset", "rowIndex"), 256)
    return records.select(
        (position if key == "position" else F.uuid()).alias("key"),
        F.to_json(F.struct(*CHANGE_RECORD.names)).alias("value"))

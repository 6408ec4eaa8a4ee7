"""Record shapes shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

# Field names of the click record, in record order.
CLICK_FIELDS = [
    "channelID", "categoryID", "produceID", "country", "province", "city",
    "network", "source", "browserType", "entryTime", "leaveTime", "userID",
]

# Field names of the envelope around a click.
ENVELOPE_FIELDS = ["count", "message", "timeStamp"]

# Columns of the widened click, in record order.
WIDE_COLUMNS = CLICK_FIELDS + [
    "count", "timestamp", "address", "yearMonth", "yearMonthDay", "yearMonthDayHour",
    "isNew", "isHourNew", "isDayNew", "isMonthNew",
]


def text_struct(names) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


ENVELOPE_TEXT = text_struct(ENVELOPE_FIELDS)

# A raw topic record as the engine reads it: text, arrival number, broker time if there is one.
RAW_RECORD = StructType([
    StructField("value", StringType()),
    StructField("seq", LongType()),
    StructField("arrivalMs", LongType()),
])

USER_HISTORY = StructType([
    StructField("userid", StringType()),
    StructField("channelid", StringType()),
    StructField("lastVisitedTime", LongType()),
])

CELL_LOG = StructType([
    StructField("rowkey", StringType()),
    StructField("family", StringType()),
    StructField("column", StringType()),
    StructField("value", StringType()),
    StructField("seq", LongType()),
    StructField("op", StringType()),
])

CHANGE_COLUMN = StructType([
    StructField("name", StringType()),
    StructField("value", StringType()),
    StructField("updated", BooleanType()),
])

ROW_IMAGES = StructType([
    StructField("beforeColumns", ArrayType(CHANGE_COLUMN)),
    StructField("afterColumns", ArrayType(CHANGE_COLUMN)),
])

CHANGE_HEADER = StructType([
    StructField("logfileName", StringType()),
    StructField("logfileOffset", LongType()),
    StructField("schemaName", StringType()),
    StructField("tableName", StringType()),
    StructField("executeTime", LongType()),
])

CHANGE_ENTRY = StructType([
    StructField("entryType", StringType()),
    StructField("header", CHANGE_HEADER),
    StructField("eventType", StringType()),
    StructField("rowDatas", ArrayType(ROW_IMAGES)),
])

COLUMN_VALUE = StructType([
    StructField("columnName", StringType()),
    StructField("columnValue", StringType()),
    StructField("isValid", BooleanType()),
])

CHANGE_RECORD = StructType([
    StructField("logFileName", StringType()),
    StructField("logFileOffset", LongType()),
    StructField("dbName", StringType()),
    StructField("tableName", StringType()),
    StructField("eventType", StringType()),
    StructField("columnValueList", ArrayType(COLUMN_VALUE)),
    StructField("emptyCount", IntegerType()),
    StructField("timestamp", LongType()),
])

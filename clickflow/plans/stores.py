"""Queries on keyed cells and change records, each with the SQL that must agree with it."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickflow.operators import cells, changes
from clickflow.schemas import CHANGE_RECORD
from clickflow.session import work_folder
from clickflow.sources import tables

COLUMNS = ["status", "priority", "note", "absent"]


def _cell_log(spark, folder):
    puts = cells.put_rows(tables.load_order_puts(spark, folder))
    late = F.col("seq") * 2 + 1
    puts = puts.withColumn("seq", F.col("seq") * 2)
    deletes = cells.delete_rows(tables.load_order_deletes(spark, folder))
    return puts.unionByName(deletes.withColumn("seq", late))


def _keys(spark, folder):
    """Every customer's row key, with or without orders."""
    return tables.read_table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("rowkey"))


def kv_put_cell(spark, folder):
    """Single-column puts onto rows that hold other columns already."""
    base = cells.put_rows(tables.load_order_puts(spark, folder))
    orders = tables.read_table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("rowkey"),
        F.concat(F.lit("seen "), "o_orderkey").alias("value"),
        (F.col("o_orderkey") + 1000000000).alias("seq"))
    log = base.unionByName(cells.put_cells(orders, "status"))
    return cells.current_cells(log).select("rowkey", "column", "value")


def kv_put_row(spark, folder):
    log = cells.put_rows(tables.load_order_puts(spark, folder))
    return cells.current_cells(log).select("rowkey", "column", "value")


def kv_put_row_rejected(spark, folder):
    return cells.rejected_puts(tables.load_order_puts(spark, folder)).select("rowkey", "seq")


def kv_delete(spark, folder):
    return cells.current_cells(_cell_log(spark, folder)).select("rowkey", "column", "value")


def kv_get_cell(spark, folder):
    requests = _keys(spark, folder).select(
        "rowkey", F.explode(F.array(F.lit("note"), F.lit("absent"))).alias("column"))
    return cells.get_cell(requests, _cell_log(spark, folder))


def kv_get_row(spark, folder):
    rows = cells.get_row(_keys(spark, folder), _cell_log(spark, folder), COLUMNS)
    return rows.select("rowkey", F.explode_outer("values").alias("column", "value"))


def kv_open_table(spark, folder):
    """The log written to a new table and read back, with a second write that changes nothing."""
    table = cells.open_table(spark, work_folder(spark, "cells"))
    log = _cell_log(spark, folder)
    table.write(log)
    table.write(log.where("column = 'status'"))
    again = cells.open_table(spark, table.path)
    return cells.current_cells(again.log()).select("rowkey", "column", "value")


def _batched_table(spark, folder):
    """The log in three batches, the last one written twice, as after a restart."""
    table = cells.open_table(spark, work_folder(spark, "cells"))
    log = _cell_log(spark, folder)
    for number in (0, 1, 2, 2):
        table.write(log.where(F.pmod(F.col("seq"), F.lit(3)) == number), number)
    return table


def kv_fold(spark, folder):
    """The cells after the first batches were folded, beside what they were folded from, and all after it."""
    table = _batched_table(spark, folder)
    table.fold(1)
    table.fold()
    table.fold()
    return cells.current_cells(table.log()).select("rowkey", "column", "value")


def kv_point_get(spark, folder):
    """Rows of every fiftieth customer, from the buckets that hold these."""
    table = _batched_table(spark, folder)
    table.fold(1)
    keys = _keys(spark, folder).where("CAST(rowkey AS BIGINT) % 50 = 7")
    rows = cells.get_row(keys, table.log_of(keys), COLUMNS)
    return rows.select("rowkey", F.explode_outer("values").alias("column", "value"))


def _entries(spark, folder):
    return changes.number_batches(tables.load_change_entries(spark, folder))


def cdc_transaction_filter(spark, folder):
    kept = changes.drop_transaction_markers(tables.load_change_entries(spark, folder))
    return kept.select("batchId", F.col("header.logfileOffset").alias("position"), "entryType")


def cdc_table_filter(spark, folder):
    entries = tables.load_change_entries(spark, folder)
    kept = changes.subscribe(entries, r"shop\.orders")
    return kept.select("batchId", F.col("header.logfileOffset").alias("position"), "entryType",
                       F.col("header.schemaName").alias("dbName"),
                       F.col("header.tableName").alias("tableName"))


def cdc_batch_sequence(spark, folder):
    """Numbered fetch batches; the entries of every seventh lack the batch id."""
    entries = tables.load_change_entries(spark, folder).withColumn(
        "batchId", F.when(F.col("batchId") % 14 != 0, F.col("batchId")))
    return changes.number_batches(entries).groupBy("batchId", "emptyCount").agg(
        F.count(F.lit(1)).cast("bigint").alias("entries"))


def spread_columns(records):
    """Change records with one row per listed column."""
    scalars = [n for n in CHANGE_RECORD.names if n != "columnValueList"]
    return records.select(*scalars, F.explode("columnValueList").alias("c")).select(
        *scalars, "c.columnName", "c.columnValue", F.col("c.isValid").cast("int").alias("isValid"))


def cdc_flatten(spark, folder):
    return spread_columns(changes.flatten_entries(_entries(spark, folder)))


def cdc_topic_records(spark, folder):
    """Topic records read back from their JSON, with their replay-safe key."""
    sent = changes.topic_records(changes.flatten_entries(_entries(spark, folder)))
    back = sent.select("key", F.from_json("value", CHANGE_RECORD).alias("r"))
    return back.select("key", "r.*").select(
        "key", "logFileName", "logFileOffset", "emptyCount",
        F.size("columnValueList").alias("columns"))


def load_entry_texts(spark, folder):
    """Change entries as JSON text, some cut off, some without schema, some without table."""
    entries = tables.load_change_entries(spark, folder)
    text = F.to_json(F.struct("entryType", "header", "eventType", "rowDatas"))
    offset = F.col("header.logfileOffset")
    digit = (offset / 10) % 6
    cut = (F.when(digit == 0, F.left(text, F.length(text) - 1))
           .when(digit == 5, F.regexp_replace(text, '"schemaName":"[a-z]*",', ""))
           .when(digit == 4, F.regexp_replace(text, '"tableName":"[a-z_]*",', "")).otherwise(text))
    return entries.select("batchId", offset.alias("position"), cut.alias("value"))


def cdc_decode(spark, folder):
    texts = changes.number_batches(load_entry_texts(spark, folder))
    parsed = changes.parse_entries(texts, keep=("emptyCount",))
    return spread_columns(changes.flatten_entries(changes.good_entries(parsed)))


def cdc_bad_entries(spark, folder):
    parsed = changes.parse_entries(load_entry_texts(spark, folder), keep=("position",))
    return changes.bad_entries(parsed, keep=("position",)).groupBy("position", "badReason").agg(
        F.count(F.lit(1)).cast("bigint").alias("entries"))


QUERIES = {f.__name__: f for f in [
    kv_put_cell, kv_put_row, kv_put_row_rejected, kv_get_cell, kv_get_row, kv_delete,
    kv_open_table, kv_fold, kv_point_get,
    cdc_transaction_filter, cdc_table_filter, cdc_batch_sequence,
    cdc_flatten, cdc_topic_records, cdc_decode, cdc_bad_entries,
]}


# --- The same results in SQL ------------------------------------------------------------

PUTS = """
wide AS (
  SELECT CAST(o_custkey AS VARCHAR) AS rowkey, o_orderkey AS k, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 4 = 0 THEN ''
              ELSE CAST(o_orderkey AS VARCHAR) END AS note
  FROM orders),
puts AS (
  SELECT rowkey, k, 'status' AS "column", o_orderstatus AS value FROM wide WHERE note IS NOT NULL
  UNION ALL
  SELECT rowkey, k, 'priority', o_orderpriority FROM wide WHERE note IS NOT NULL
  UNION ALL
  SELECT rowkey, k, 'note', note FROM wide WHERE note IS NOT NULL)"""

VISIBLE = """
latest AS (
  SELECT rowkey, "column", arg_max(value, k) AS value, max(k) AS k FROM puts GROUP BY 1, 2),
gone AS (
  SELECT CAST(o_custkey AS VARCHAR) AS rowkey, max(o_orderkey) AS k FROM orders
  WHERE o_orderpriority = '5-LOW' GROUP BY 1),
visible AS (
  SELECT latest.rowkey, "column", value FROM latest LEFT JOIN gone USING (rowkey)
  WHERE gone.k IS NULL OR latest.k > gone.k),
keys AS (SELECT CAST(c_custkey AS VARCHAR) AS rowkey FROM customer)"""

ENTRIES = """
base AS (
  SELECT o_orderkey AS k, (o_orderkey - o_orderkey % 100) // 50 AS "batchId", o_orderstatus,
         o_orderpriority, epoch_us(o_orderdate) // 1000 AS ms,
         CASE WHEN o_orderkey % 3 = 0 THEN 'audit' ELSE 'shop' END AS "dbName",
         CASE WHEN o_orderkey % 2 = 0 THEN 'orders' ELSE 'orders_old' END AS "tableName"
  FROM orders),
kinds AS (
  SELECT *, 'ROWDATA' AS "entryType" FROM base WHERE k % 1000 < 900
  UNION ALL
  SELECT *, 'TRANSACTIONBEGIN' FROM base WHERE k % 1000 >= 900 OR k % 5 = 0
  UNION ALL
  SELECT *, 'TRANSACTIONEND' FROM base WHERE k % 1000 >= 900 OR k % 5 = 0)"""

NUMBERED = """
numbered AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY "batchId") AS INTEGER) AS "emptyCount" FROM {source})"""

RECORDS = """
records AS (
  SELECT *, 'log.' || (k % 7) AS "logFileName", k * 10 AS "logFileOffset",
    CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'O' THEN 'INSERT' ELSE 'UPDATE' END AS "eventType"
  FROM numbered JOIN (VALUES (1), (2)) AS lines(line)
    ON line <= CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '5-LOW' THEN 0 ELSE 1 END
  WHERE "entryType" = 'ROWDATA')"""

SPREAD = """
SELECT "logFileName", "logFileOffset", "dbName", "tableName", "eventType", "emptyCount",
       ms AS "timestamp", names.n AS "columnName",
       CASE names.n WHEN 'id' THEN CAST(k AS VARCHAR) WHEN 'line' THEN CAST(line AS VARCHAR)
            ELSE CASE WHEN "eventType" = 'DELETE' THEN 'old' ELSE o_orderstatus END END
         AS "columnValue",
       CAST(names.n = 'status' AND "eventType" <> 'DELETE' AS INTEGER) AS "isValid"
FROM records CROSS JOIN (VALUES ('id'), ('line'), ('status')) AS names(n)"""

SEQUENCE = """
SELECT "batchId", "emptyCount", CAST(count(*) AS BIGINT) AS entries FROM numbered
GROUP BY 1, 2"""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


def _numbered(source: str = "kinds") -> str:
    return NUMBERED.replace("{source}", source)


READABLE = """
numbered AS (SELECT * FROM counted WHERE k % 6 NOT IN (0, 4, 5))"""

UNNAMED = """
unnamed AS (SELECT * REPLACE (CASE WHEN "batchId" % 14 <> 0 THEN "batchId" END AS "batchId") FROM kinds),
numbered AS (
  SELECT *, CASE WHEN "batchId" IS NOT NULL THEN CAST(dense_rank() OVER (
    ORDER BY "batchId" NULLS LAST) AS INTEGER) END AS "emptyCount" FROM unnamed)"""

ORACLES = {
    "kv_put_cell": _with(PUTS, """
every AS (
  SELECT * FROM puts UNION ALL
  SELECT CAST(o_custkey AS VARCHAR), o_orderkey + 1000000000, 'status', 'seen ' || o_orderkey
  FROM orders)""", then="""
SELECT rowkey, "column", arg_max(value, k) AS value FROM every GROUP BY 1, 2"""),
    "kv_put_row": _with(PUTS, then="""
SELECT rowkey, "column", arg_max(value, k) AS value FROM puts GROUP BY 1, 2"""),
    "kv_put_row_rejected": """
SELECT CAST(o_custkey AS VARCHAR) AS rowkey, o_orderkey AS seq FROM orders
WHERE o_orderstatus = 'P'""",
    "kv_delete": _with(PUTS, VISIBLE, then="SELECT * FROM visible"),
    "kv_get_cell": _with(PUTS, VISIBLE, then="""
SELECT asked.rowkey, asked."column", coalesce(value, '') AS value
FROM (SELECT rowkey, n AS "column" FROM keys CROSS JOIN (VALUES ('note'), ('absent')) AS c(n)) asked
LEFT JOIN visible ON visible.rowkey = asked.rowkey AND visible."column" = asked."column\""""),
    "kv_get_row": _with(PUTS, VISIBLE, then="""
SELECT keys.rowkey, "column", value FROM keys
LEFT JOIN (SELECT * FROM visible WHERE value <> '') shown USING (rowkey)"""),
    "kv_open_table": _with(PUTS, VISIBLE, then="SELECT * FROM visible"),
    "kv_fold": _with(PUTS, VISIBLE, then="SELECT * FROM visible"),
    "kv_point_get": _with(PUTS, VISIBLE, then="""
SELECT keys.rowkey, "column", value FROM keys
LEFT JOIN (SELECT * FROM visible WHERE value <> '') shown USING (rowkey)
WHERE CAST(keys.rowkey AS BIGINT) % 50 = 7"""),
    "cdc_transaction_filter": _with(ENTRIES, then="""
SELECT "batchId", k * 10 AS position, "entryType" FROM kinds WHERE "entryType" = 'ROWDATA'"""),
    "cdc_table_filter": _with(ENTRIES, then="""
SELECT "batchId", k * 10 AS position, "entryType", "dbName", "tableName" FROM kinds
WHERE "dbName" = 'shop' AND "tableName" = 'orders'"""),
    "cdc_batch_sequence": _with(ENTRIES, UNNAMED, then=SEQUENCE),
    "cdc_flatten": _with(ENTRIES, _numbered(), RECORDS, then=SPREAD),
    "cdc_topic_records": _with(ENTRIES, _numbered(), RECORDS, then="""
SELECT sha256("logFileName" || ':' || "logFileOffset" || ':' || (line - 1)) AS key,
       "logFileName", "logFileOffset", "emptyCount", CAST(3 AS INTEGER) AS columns
FROM records"""),
    "cdc_decode": _with(
        ENTRIES, _numbered().replace("numbered AS", "counted AS"), READABLE, RECORDS, then=SPREAD),
    "cdc_bad_entries": _with(ENTRIES, then="""
SELECT k * 10 AS position, CASE k % 6 WHEN 0 THEN 'entry is not a JSON object'
         WHEN 5 THEN 'schemaName is missing' ELSE 'tableName is missing' END AS "badReason",
       CAST(count(*) AS BIGINT) AS entries
FROM kinds WHERE k % 6 = 0 OR (k % 6 IN (4, 5) AND "entryType" = 'ROWDATA') GROUP BY 1, 2"""),
}

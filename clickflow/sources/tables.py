"""Clicks, envelopes, cells and change entries read from the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickflow.functions.text import to_text
from clickflow.schemas import CLICK_FIELDS


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def epoch_ms(value: str | Column) -> Column:
    """A zone-less timestamp as epoch milliseconds, rounded down."""
    column = F.col(value) if isinstance(value, str) else value
    return F.unix_millis(column.cast("timestamp"))


def as_clicks(rows: DataFrame, seq: Column, ms: Column, **fields: Column) -> DataFrame:
    """Flat clicks with count 1; click fields that are not given are null."""
    text = [fields[n].alias(n) if n in fields else F.expr(f"CAST(NULL AS STRING) AS {n}")
            for n in CLICK_FIELDS]
    return rows.select(
        seq.cast("bigint").alias("seq"), *text,
        F.lit(1).cast("bigint").alias("count"), ms.alias("timestamp"))


def event_clicks(events: DataFrame) -> DataFrame:
    """The event stream as clicks: in time order, one month."""
    return as_clicks(
        events, F.col("event_id"), epoch_ms("ts"),
        userID=to_text("user_id"), channelID=F.col("event_type"),
        produceID=F.get_json_object("props", "$.k"))


def order_clicks(orders: DataFrame, customer: DataFrame | None = None,
                 nation: DataFrame | None = None, region: DataFrame | None = None) -> DataFrame:
    """Orders as clicks: several years, often going back in time within a visitor.

    The place columns come from the customer's nation and region when those are given.
    """
    place = {}
    rows = orders
    if customer is not None:
        rows = (
            rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        place = {"country": F.col("r_name"), "province": F.col("n_name"),
                 "city": F.col("c_mktsegment")}
    return as_clicks(
        rows, F.col("o_orderkey"), epoch_ms("o_orderdate"),
        userID=to_text("o_custkey"), channelID=F.col("o_orderpriority"), **place)


def load_event_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return event_clicks(read_table(spark, folder, "events"))


def load_order_clicks(spark: SparkSession, folder: str, places: bool = False) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    if not places:
        return order_clicks(orders)
    return order_clicks(orders, *[read_table(spark, folder, name)
                                  for name in ("customer", "nation", "region")])


def click_body(*fields: str) -> Column:
    """The click's own JSON text, holding the named fields."""
    return F.to_json(F.struct(*[F.col(n) for n in fields]))


def event_bodies(events: DataFrame) -> DataFrame:
    """Each event as the JSON body a page would report: ``(seq, body, timestamp)``."""
    return event_clicks(events).select(
        "seq", click_body("channelID", "produceID", "userID").alias("body"), "timestamp")


def load_event_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return event_bodies(read_table(spark, folder, "events"))


def load_damaged_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return damaged_envelopes(load_event_bodies(spark, folder))


def damaged_envelopes(rows: DataFrame) -> DataFrame:
    """Event envelopes of which seven in ten are damaged or unusual, by last digit of ``seq``."""
    body = F.replace(F.replace("body", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    ms = to_text("timestamp")

    def envelope(count: str | None, message: Column | None, at: Column | None) -> Column:
        parts = []
        if count is not None:
            parts.append(F.lit(f'"count":{count}'))
        if message is not None:
            parts.append(F.concat(F.lit('"message":"'), message, F.lit('"')))
        if at is not None:
            parts.append(F.concat(F.lit('"timeStamp":'), at))
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    digit = F.col("seq") % 10
    value = (
        F.when(digit == 0, F.concat(F.lit("broken "), "body"))
        .when(digit == 1, envelope("1", F.lit("no object"), ms))
        .when(digit == 2, envelope("1", None, ms))
        .when(digit == 3, envelope(None, body, ms))
        .when(digit == 4, envelope("1", body, None))
        .when(digit == 5, envelope('"5"', body, ms))
        .when(digit == 6, envelope('"many"', body, ms))
        .otherwise(envelope("1", body, ms))
    )
    return rows.select("seq", value.alias("value"))


def load_change_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as database change entries in numbered fetch batches.

    Every second batch number stays unused, as an empty fetch would. Each order gives a row
    entry; every fifth also opens and closes a transaction around it. Orders whose key ends
    in 900 to 999 give transaction markers only, so some batches hold no row entry at all.
    Rows per entry: none for low-priority orders, two for urgent ones, else one.
    """
    orders = read_table(spark, folder, "orders")
    key = F.col("o_orderkey")

    def column(name: str, value: Column, updated: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"), updated.alias("updated"))

    def image(state: Column, changed: Column, line: int) -> Column:
        return F.array(
            column("id", to_text("o_orderkey"), F.lit(False)),
            column("line", F.lit(str(line)), F.lit(False)),
            column("status", state, changed))

    def images(line: int) -> Column:
        return F.struct(
            image(F.lit("old"), F.lit(False), line).alias("beforeColumns"),
            image(F.col("o_orderstatus"), F.lit(True), line).alias("afterColumns"))

    rows = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.array(images(1), images(2)))
        .when(F.col("o_orderpriority") == "5-LOW", F.slice(F.array(images(1)), 1, 0))
        .otherwise(F.array(images(1)))
    )
    event = (F.when(F.col("o_orderstatus") == "F", "DELETE")
             .when(F.col("o_orderstatus") == "O", "INSERT").otherwise("UPDATE"))
    header = F.struct(
        F.concat(F.lit("log."), to_text(key % 7)).alias("logfileName"),
        (key * 10).cast("bigint").alias("logfileOffset"),
        F.when(key % 3 == 0, "audit").otherwise("shop").alias("schemaName"),
        F.when(key % 2 == 0, "orders").otherwise("orders_old").alias("tableName"),
        epoch_ms("o_orderdate").alias("executeTime"))
    no_rows = F.slice(F.array(images(1)), 1, 0)

    def entry(kind: str, event_type: Column, row_datas: Column) -> Column:
        return F.struct(F.lit(kind).alias("entryType"), header.alias("header"),
                        event_type.alias("eventType"), row_datas.alias("rowDatas"))

    begin = entry("TRANSACTIONBEGIN", F.lit(None).cast("string"), no_rows)
    end = entry("TRANSACTIONEND", F.lit(None).cast("string"), no_rows)
    data = entry("ROWDATA", event, rows)
    entries = (
        F.when(key % 1000 >= 900, F.array(begin, end))
        .when(key % 5 == 0, F.array(begin, data, end))
        .otherwise(F.array(data))
    )
    batch = (key - key % 100) / 50
    return orders.select(batch.cast("bigint").alias("batchId"), F.explode(entries).alias("e")) \
        .select("batchId", "e.*")


def load_order_puts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as multi-column puts on their customer's row, some with a missing value."""
    note = (F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
            .when(F.col("o_orderkey") % 4 == 0, F.lit(""))
            .otherwise(to_text("o_orderkey")))
    return read_table(spark, folder, "orders").select(
        to_text("o_custkey").alias("rowkey"),
        F.create_map(F.lit("status"), F.col("o_orderstatus"),
                     F.lit("priority"), F.col("o_orderpriority"),
                     F.lit("note"), note).alias("values"),
        F.col("o_orderkey").alias("seq"))


def load_order_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Low-priority orders as deletions of their customer's row, just after the order's own put."""
    orders = read_table(spark, folder, "orders").where("o_orderpriority = '5-LOW'")
    return orders.select(to_text("o_custkey").alias("rowkey"), F.col("o_orderkey").alias("seq"))

"""Batch click queries over the given tables, each with the SQL that must agree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickflow import functions as C
from clickflow.operators import envelope, metrics, numbering, totals, visitors, widen
from clickflow.schemas import CLICK_FIELDS, WIDE_COLUMNS
from clickflow.session import keep_table
from clickflow.sources import kafka, tables


def flagged_events(spark: SparkSession, folder: str, hot=None) -> DataFrame:
    clicks = tables.load_event_clicks(spark, folder)
    return visitors.visitor_flags(clicks, hot or visitors.hot_visitors(clicks))


def flagged_orders(spark: SparkSession, folder: str, hot=None, places=False) -> DataFrame:
    clicks = tables.load_order_clicks(spark, folder, places)
    return visitors.visitor_flags(
        clicks, hot or visitors.hot_visitors(tables.load_order_clicks(spark, folder)))


FLAG_COLUMNS = ["seq", "userID", "channelID", "isNew", "isHourNew", "isDayNew", "isMonthNew"]


def new_visitor_flags(spark, folder):
    return flagged_events(spark, folder).select(*FLAG_COLUMNS)


def new_visitor_flags_orders(spark, folder):
    return flagged_orders(spark, folder).select(*FLAG_COLUMNS)


def new_visitor_flags_split(spark, folder):
    """As above, with the splitting of big visitors forced onto small ones."""
    clicks = tables.load_order_clicks(spark, folder)
    hot = visitors.hot_visitors(
        clicks, fraction=1.0, hot_share=1 / 4096, least_rows=2, limits=64)
    return visitors.visitor_flags(clicks, hot).select(*FLAG_COLUMNS)


def new_visitor_flags_incremental(spark, folder):
    """As above, in two batches with the history of the first handed to the second."""
    clicks = tables.load_order_clicks(spark, folder)
    first, second = clicks.where("seq % 20000 < 10000"), clicks.where("seq % 20000 >= 10000")
    nothing = spark.createDataFrame([], "userid string, channelid string, lastVisitedTime bigint")
    one = visitors.flags_with_history(first, nothing)
    history = visitors.update_history(nothing, first)
    two = visitors.flags_with_history(second, history, visitors.hot_visitors(second))
    return one.select(*FLAG_COLUMNS).unionByName(two.select(*FLAG_COLUMNS))


def topic_order(spark, folder):
    """Flags of topic records from three partitions, many at one time and with equal offsets."""
    events = tables.load_event_clicks(spark, folder)
    records = events.select(
        F.to_json(F.struct("channelID", "userID")).alias("body"), "seq",
        F.timestamp_millis(F.col("timestamp") - F.col("timestamp") % 7200000).alias("timestamp"),
        (F.col("seq") % 3).cast("int").alias("partition"),
        (F.lit(2 ** 20 - 50) + F.floor(F.col("seq") / 3)).alias("offset"))
    value = F.to_json(F.struct(F.lit(1).alias("count"), F.col("body").alias("message"),
                               F.unix_millis("timestamp").alias("timeStamp")))
    raw = kafka.number_topic_records(records.withColumn("value", value.cast("binary")))
    messages = envelope.parse_messages(raw, keep=("seq",), fields=["channelID", "userID"])
    clicks = envelope.flatten_messages(envelope.good_messages(messages), ("seq",))
    hot = visitors.hot_visitors(clicks, fraction=1.0, hot_share=1 / 64, limits=16)
    return visitors.visitor_flags(clicks, hot).select(
        F.col("seq").cast("string").alias("arrival"), "isNew", "isHourNew", "isDayNew", "isMonthNew")


def user_history(spark, folder):
    return visitors.user_history(tables.load_order_clicks(spark, folder))


def click_address(spark, folder):
    clicks = tables.load_order_clicks(spark, folder, places=True)
    return widen.with_address(clicks).select("seq", "address")


def click_periods(spark, folder):
    clicks = tables.load_event_clicks(spark, folder)
    return widen.with_periods(clicks).select("seq", "yearMonth", "yearMonthDay",
                                             "yearMonthDayHour")


def click_wide(spark, folder):
    return widen.wide_clicks(flagged_events(spark, folder), keep=("seq",))


def click_wide_orders(spark, folder):
    return widen.wide_clicks(flagged_orders(spark, folder, places=True), keep=("seq",))


def hot_projection(spark, folder):
    clicks = tables.load_event_clicks(spark, folder)
    return metrics.hot_projection(clicks)


def pvuv_fanout(spark, folder):
    return metrics.pvuv_fan_out(flagged_events(spark, folder), keep=("seq",))


def pvuv_hour_projection(spark, folder):
    return metrics.pvuv_fan_out(flagged_events(spark, folder), ("hour",), keep=("seq",))


def freshness_fanout(spark, folder):
    return metrics.freshness_fan_out(flagged_orders(spark, folder), keep=("seq",))


def channel_pvuv(spark, folder):
    return metrics.channel_pvuv(flagged_events(spark, folder))


def channel_pvuv_orders(spark, folder):
    return metrics.channel_pvuv(flagged_orders(spark, folder))


def channel_pvuv_hour(spark, folder):
    return metrics.channel_pvuv(flagged_events(spark, folder), grains=("hour",))


def channel_freshness(spark, folder):
    return metrics.channel_freshness(flagged_events(spark, folder))


def channel_freshness_orders(spark, folder):
    return metrics.channel_freshness(flagged_orders(spark, folder))


def channel_hot(spark, folder):
    return metrics.channel_hot(tables.load_event_clicks(spark, folder))


def channel_pvuv_windows(spark, folder):
    return metrics.channel_pvuv_windows(flagged_events(spark, folder))


def channel_freshness_windows(spark, folder):
    return metrics.channel_freshness_windows(flagged_events(spark, folder))


def channel_hot_windows(spark, folder):
    return metrics.channel_hot_windows(tables.load_event_clicks(spark, folder))


def channel_hot_last_window(spark, folder):
    return metrics.last_window(channel_hot_windows(spark, folder))


def running_totals(spark, folder):
    """Totals after three batches of fired windows, each added to the totals before it."""
    windows = keep_table(metrics.channel_pvuv_windows(flagged_orders(spark, folder)), "windows")
    part = F.pmod(F.xxhash64("windowStart"), F.lit(3))
    total = totals.add_totals("channel_pvuv", windows.where(part == 0))
    for number in (1, 2):
        total = totals.add_totals("channel_pvuv", total, windows.where(part == number))
    return total


def running_totals_by_window(spark, folder):
    """Views and unique visitors as they stand after each window's write."""
    windows = keep_table(metrics.channel_pvuv_windows(flagged_events(spark, folder)), "windows")
    return totals.totals_by_window("channel_pvuv", windows)


def click_envelope(spark, folder):
    bodies = tables.load_event_bodies(spark, folder)
    return envelope.build_envelopes(bodies, "body", "timestamp", keep=("seq",))


def round_robin_partition(spark, folder):
    clicks = tables.load_event_clicks(spark, folder)
    return numbering.round_robin_partition(clicks.select("seq"), "seq", 3)


def parse_envelope(spark, folder):
    return (
        envelope.parse_envelopes(tables.load_damaged_envelopes(spark, folder), keep=("seq",))
        .select("seq", "message", "count", F.col("timeStamp").alias("sentMs"))
    )


def parse_click_log(spark, folder):
    messages = envelope.parse_messages(tables.load_damaged_envelopes(spark, folder))
    return envelope.flatten_messages(envelope.good_messages(messages))


def bad_records(spark, folder):
    messages = envelope.parse_messages(tables.load_damaged_envelopes(spark, folder))
    return envelope.bad_messages(messages).groupBy("badReason").agg(
        F.count(F.lit(1)).cast("bigint").alias("records"))


def event_time(spark, folder):
    """Event time with a broker time up to 1.2 s before or after the click's own."""
    clicks = tables.load_event_clicks(spark, folder)
    arrival = F.when(F.col("seq") % 4 != 0, F.col("timestamp") + (F.col("seq") % 25 - 12) * 100)
    return clicks.withColumn("arrivalMs", arrival).select(
        "seq", C.event_time("timestamp", "arrivalMs").alias("eventMs"))


def scalar_suite(spark, folder):
    clicks = tables.load_order_clicks(spark, folder, places=True)
    digit = F.col("seq") % 5
    text = (F.when(digit == 0, F.lit(" \t ")).when(digit == 1, F.lit(""))
            .when(digit == 2, F.concat(F.lit(" "), "city", F.lit(" ")))
            .when(digit == 3, F.concat(C.to_text("seq"), F.when(
                F.col("seq") % 2 == 0, ".99999999999999999999").otherwise(""))))
    shift = F.when(F.col("seq") % 3 == 0, 86400000).when(F.col("seq") % 3 == 1, 0).otherwise(-86400000)
    rows = clicks.withColumn("text", text).withColumn("other", F.col("timestamp") - shift)
    mapping = F.when(digit < 3, F.create_map(F.lit("city"), F.col("city"))) \
        .otherwise(F.create_map(F.lit("other"), F.col("city")))
    return rows.select(
        "seq",
        C.period_text("timestamp", "yyyyMMdd").alias("dayText"),
        C.compare_date("timestamp", "other", "yyyyMM").alias("laterMonth"),
        C.compare_date("timestamp", "other", "yyyyMMdd").alias("laterDay"),
        F.concat_ws(":", "userID", "channelID").alias("rowKey"),
        C.join_text("city", "network", "source").alias("joined"),
        C.is_blank("text").cast("int").alias("blank"),
        C.is_not_blank("text").cast("int").alias("notBlank"),
        C.to_long("text").alias("asLong"),
        C.to_text("timestamp").alias("asText"),
        F.greatest("timestamp", "other").alias("later"),
        C.map_get_or(mapping, "city").alias("mapped"),
    )


QUERIES = {f.__name__: f for f in [
    channel_pvuv, channel_pvuv_orders, channel_pvuv_hour, channel_pvuv_windows,
    channel_freshness, channel_freshness_orders, channel_freshness_windows,
    channel_hot, channel_hot_windows, channel_hot_last_window, running_totals,
    running_totals_by_window,
    new_visitor_flags, new_visitor_flags_orders, new_visitor_flags_split,
    new_visitor_flags_incremental, topic_order, user_history,
    click_wide, click_wide_orders, click_address, click_periods,
    hot_projection, pvuv_fanout, pvuv_hour_projection, freshness_fanout,
    click_envelope, round_robin_partition, parse_envelope, parse_click_log, bad_records,
    event_time, scalar_suite,
]}


# --- The same results in SQL ------------------------------------------------------------

EVENTS = """
clicks AS (
  SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS "userID", event_type AS "channelID",
         json_extract_string(props, '$.k') AS "produceID",
         CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS province,
         CAST(NULL AS VARCHAR) AS city, CAST(1 AS BIGINT) AS "count",
         epoch_us(ts) // 1000 AS ms
  FROM events)"""

ORDERS = """
clicks AS (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS "userID",
         o_orderpriority AS "channelID", CAST(NULL AS VARCHAR) AS "produceID",
         r_name AS country, n_name AS province, c_mktsegment AS city,
         CAST(1 AS BIGINT) AS "count", epoch_us(o_orderdate) // 1000 AS ms
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FLAGS = """
dated AS (
  SELECT *, make_timestamp(ms * 1000) AS ts,
         lag(make_timestamp(ms * 1000)) OVER (
           PARTITION BY "userID", "channelID" ORDER BY seq) AS past
  FROM clicks),
flagged AS (
  SELECT *,
    CAST(past IS NULL AS INTEGER) AS "isNew",
    CAST(past IS NULL OR strftime(ts, '%Y%m%d%H') > strftime(past, '%Y%m%d%H') AS INTEGER)
      AS "isHourNew",
    CAST(past IS NULL OR strftime(ts, '%Y%m%d') > strftime(past, '%Y%m%d') AS INTEGER)
      AS "isDayNew",
    CAST(past IS NULL OR strftime(ts, '%Y%m') > strftime(past, '%Y%m') AS INTEGER)
      AS "isMonthNew",
    strftime(ts, '%Y%m%d%H') AS hour_text, strftime(ts, '%Y%m%d') AS day_text,
    strftime(ts, '%Y%m') AS month_text, ms // 3000 * 3000 AS "windowStart"
  FROM dated)"""

PVUV = """
spread AS (
  SELECT seq, "windowStart", "channelID" AS "channelId", hour_text AS "yearMonthDayHour",
         "count" AS pv, CAST("isHourNew" AS BIGINT) AS uv FROM flagged
  UNION ALL
  SELECT seq, "windowStart", "channelID", day_text, "count", "isDayNew" FROM flagged
  UNION ALL
  SELECT seq, "windowStart", "channelID", month_text, "count", "isMonthNew" FROM flagged)"""

FRESHNESS = """
spread AS (
  SELECT seq, "windowStart", "channelID" AS "channelId", hour_text AS date,
         CAST("isNew" AS BIGINT) AS "newCount",
         CAST("isNew" = 0 AND "isHourNew" = 1 AS BIGINT) AS "oldCount" FROM flagged
  UNION ALL
  SELECT seq, "windowStart", "channelID", day_text, "isNew",
         CAST("isNew" = 0 AND "isDayNew" = 1 AS BIGINT) FROM flagged
  UNION ALL
  SELECT seq, "windowStart", "channelID", month_text, "isNew",
         CAST("isNew" = 0 AND "isMonthNew" = 1 AS BIGINT) FROM flagged)"""

SUM_PVUV = """CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(uv) AS BIGINT) AS uv"""
SUM_FRESHNESS = """CAST(sum("newCount") AS BIGINT) AS "newCount",
       CAST(sum("oldCount") AS BIGINT) AS "oldCount\""""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then


def _pvuv(source: str, keys: str, where: str = "") -> str:
    return _with(source, FLAGS, PVUV,
                 then=f"SELECT {keys}, {SUM_PVUV} FROM spread {where} GROUP BY {keys}")


def _freshness(source: str, keys: str) -> str:
    return _with(source, FLAGS, FRESHNESS,
                 then=f"SELECT {keys}, {SUM_FRESHNESS} FROM spread GROUP BY {keys}")


def _flags(source: str) -> str:
    return _with(source, FLAGS, then="SELECT " + ", ".join(f'"{n}"' for n in FLAG_COLUMNS)
                 + " FROM flagged")


def _wide(source: str) -> str:
    missing = [n for n in CLICK_FIELDS if n not in
               ("channelID", "produceID", "country", "province", "city", "userID")]
    special = {
        "timestamp": 'ms AS "timestamp"',
        "address": "coalesce(country, 'null') || coalesce(province, 'null')"
                   " || coalesce(city, 'null') AS address",
        "yearMonth": 'month_text AS "yearMonth"',
        "yearMonthDay": 'day_text AS "yearMonthDay"',
        "yearMonthDayHour": 'hour_text AS "yearMonthDayHour"',
        **{n: f'CAST(NULL AS VARCHAR) AS "{n}"' for n in missing},
    }
    columns = ["seq"] + [special.get(n, f'"{n}"') for n in WIDE_COLUMNS]
    return _with(source, FLAGS, then="SELECT " + ", ".join(columns) + " FROM flagged")


BODY = """'{"channelID":"' || "channelID" || '","produceID":"' || "produceID"
  || '","userID":"' || "userID" || '"}'"""

PARSED = f"""
bodies AS (SELECT *, {BODY} AS body, seq % 10 AS digit FROM clicks),
parsed AS (
  SELECT seq, "channelID", "produceID", "userID", digit,
    CASE WHEN digit IN (0, 2) THEN NULL WHEN digit = 1 THEN 'no object' ELSE body END AS message,
    CASE WHEN digit IN (0, 3, 6) THEN NULL WHEN digit = 5 THEN 5 ELSE 1 END AS n,
    CASE WHEN digit IN (0, 4) THEN NULL ELSE ms END AS sent
  FROM bodies)"""

HOT_WINDOWS = """
windows AS (
  SELECT ms // 3000 * 3000 AS "windowStart", "channelID" AS "channelId",
         CAST(sum("count") AS BIGINT) AS visited
  FROM clicks GROUP BY 1, 2)"""

ORACLES = {
    "channel_pvuv": _pvuv(EVENTS, '"channelId", "yearMonthDayHour"'),
    "channel_pvuv_orders": _pvuv(ORDERS, '"channelId", "yearMonthDayHour"'),
    "channel_pvuv_hour": _pvuv(EVENTS, '"channelId", "yearMonthDayHour"',
                               'WHERE length("yearMonthDayHour") = 10'),
    "channel_pvuv_windows": _pvuv(EVENTS, '"windowStart", "channelId", "yearMonthDayHour"'),
    "channel_freshness": _freshness(EVENTS, '"channelId", date'),
    "channel_freshness_orders": _freshness(ORDERS, '"channelId", date'),
    "channel_freshness_windows": _freshness(EVENTS, '"windowStart", "channelId", date'),
    "channel_hot": _with(EVENTS, then="""
SELECT "channelID" AS "channelId", CAST(sum("count") AS BIGINT) AS visited
FROM clicks GROUP BY 1"""),
    "channel_hot_windows": _with(EVENTS, HOT_WINDOWS, then="SELECT * FROM windows"),
    "channel_hot_last_window": _with(EVENTS, HOT_WINDOWS, then="""
SELECT "channelId", arg_max(visited, "windowStart") AS visited FROM windows GROUP BY 1"""),
    "running_totals": _pvuv(ORDERS, '"channelId", "yearMonthDayHour"'),
    "running_totals_by_window": _with(EVENTS, FLAGS, PVUV, f"""
windows AS (
  SELECT "windowStart", "channelId", "yearMonthDayHour", {SUM_PVUV} FROM spread GROUP BY 1, 2, 3)""", then="""
SELECT "windowStart", "channelId", "yearMonthDayHour", CAST(sum(pv) OVER past AS BIGINT) AS pv,
       CAST(sum(uv) OVER past AS BIGINT) AS uv
FROM windows WINDOW past AS (PARTITION BY "channelId", "yearMonthDayHour" ORDER BY "windowStart")"""),
    "new_visitor_flags": _flags(EVENTS),
    "new_visitor_flags_orders": _flags(ORDERS),
    "new_visitor_flags_split": _flags(ORDERS),
    "new_visitor_flags_incremental": _with("""
clicks AS (
  SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS "userID",
         o_orderpriority AS "channelID", CAST(1 AS BIGINT) AS "count",
         epoch_us(o_orderdate) // 1000 AS ms
  FROM orders),
arrived AS (SELECT *, o.seq AS id, (o.seq % 20000 >= 10000) AS second FROM clicks o),
dated AS (
  SELECT *, make_timestamp(ms * 1000) AS ts,
         lag(make_timestamp(ms * 1000)) OVER (
           PARTITION BY "userID", "channelID" ORDER BY second, seq) AS past
  FROM arrived)""", FLAGS[FLAGS.index("flagged AS"):].join(["\n", ""]),
        then="SELECT " + ", ".join(f'"{n}"' for n in FLAG_COLUMNS) + " FROM flagged"),
    "user_history": _with(ORDERS, then="""
SELECT "userID" AS userid, "channelID" AS channelid, arg_max(ms, seq) AS "lastVisitedTime"
FROM clicks GROUP BY 1, 2"""),
    "click_wide": _wide(EVENTS),
    "click_wide_orders": _wide(ORDERS),
    "click_address": _with(ORDERS, then="""
SELECT seq, country || province || city AS address FROM clicks"""),
    "click_periods": _with(EVENTS, FLAGS, then="""
SELECT seq, month_text AS "yearMonth", day_text AS "yearMonthDay",
       hour_text AS "yearMonthDayHour" FROM flagged"""),
    "hot_projection": _with(EVENTS, then="""
SELECT "channelID" AS "channelId", "count" AS visited FROM clicks"""),
    "pvuv_fanout": _with(EVENTS, FLAGS, PVUV, then="""
SELECT seq, "channelId", "yearMonthDayHour", pv, uv FROM spread"""),
    "pvuv_hour_projection": _with(EVENTS, FLAGS, PVUV, then="""
SELECT seq, "channelId", "yearMonthDayHour", pv, uv FROM spread
WHERE length("yearMonthDayHour") = 10"""),
    "freshness_fanout": _with(ORDERS, FLAGS, FRESHNESS, then="""
SELECT seq, "channelId", date, "newCount", "oldCount" FROM spread"""),
    "click_envelope": _with(EVENTS, then=f"""
SELECT seq, '{{"count":1,"message":"' || replace({BODY}, '"', '\\"') || '","timeStamp":'
  || ms || '}}' AS value FROM clicks"""),
    "round_robin_partition": """
SELECT seq, CAST(((rn - 1) % 65536 + 1) % 3 AS INTEGER) AS partition
FROM (SELECT event_id AS seq, row_number() OVER (ORDER BY event_id) AS rn FROM events)""",
    "parse_envelope": _with(EVENTS, PARSED, then="""
SELECT seq, message, CAST(n AS BIGINT) AS "count", CAST(sent AS BIGINT) AS "sentMs" FROM parsed"""),
    "parse_click_log": _with(EVENTS, PARSED, then="SELECT seq, " + ", ".join(
        f'"{n}"' if n in ("channelID", "produceID", "userID")
        else f'CAST(NULL AS VARCHAR) AS "{n}"' for n in CLICK_FIELDS)
        + ', CAST(n AS BIGINT) AS "count", sent AS "timestamp" FROM parsed'
        + " WHERE digit IN (5, 7, 8, 9)"),
    "bad_records": """
SELECT reasons.reason AS "badReason", CAST(count(*) AS BIGINT) AS records
FROM events JOIN (VALUES
  (0, 'envelope is not a JSON object'), (1, 'message is not a JSON object'),
  (2, 'message is missing'), (3, 'count is missing or no number'),
  (4, 'timeStamp is missing or no number'), (6, 'count is missing or no number')
) AS reasons(digit, reason) ON event_id % 10 = digit
GROUP BY 1""",
    "event_time": _with(EVENTS, then="""
SELECT seq, CASE WHEN seq % 4 <> 0 THEN greatest(ms, ms + (seq % 25 - 12) * 100) ELSE ms END
  AS "eventMs" FROM clicks"""),
    "topic_order": _with("""
clicks AS (
  SELECT CAST(user_id AS VARCHAR) AS "userID", event_type AS "channelID", event_id AS seq,
         epoch_us(ts) // 1000 // 7200000 * 7200000 AS ms FROM events),
sent AS (
  SELECT *, seq % 3 AS part, 1048526 + seq // 3 AS "offset",
         make_timestamp(ms * 1000) AS moment FROM clicks),
dated AS (
  SELECT *, lag(moment) OVER (PARTITION BY "userID", "channelID" ORDER BY ms, part, "offset") AS past FROM sent)""",
                         then="""
SELECT ms || lpad(CAST(part AS VARCHAR), 5, '0') || lpad(CAST("offset" AS VARCHAR), 19, '0') AS arrival,
  CAST(past IS NULL AS INTEGER) AS "isNew",
  CAST(past IS NULL OR strftime(moment, '%Y%m%d%H') > strftime(past, '%Y%m%d%H') AS INTEGER) AS "isHourNew",
  CAST(past IS NULL OR strftime(moment, '%Y%m%d') > strftime(past, '%Y%m%d') AS INTEGER) AS "isDayNew",
  CAST(past IS NULL OR strftime(moment, '%Y%m') > strftime(past, '%Y%m') AS INTEGER) AS "isMonthNew"
FROM dated"""),
    "scalar_suite": _with(ORDERS, then="""
SELECT seq,
  strftime(make_timestamp(ms * 1000), '%Y%m%d') AS "dayText",
  CAST(strftime(make_timestamp(ms * 1000), '%Y%m')
       > strftime(make_timestamp(other * 1000), '%Y%m') AS INTEGER) AS "laterMonth",
  CAST(strftime(make_timestamp(ms * 1000), '%Y%m%d')
       > strftime(make_timestamp(other * 1000), '%Y%m%d') AS INTEGER) AS "laterDay",
  "userID" || ':' || "channelID" AS "rowKey",
  city || 'nullnull' AS joined,
  CAST(seq % 5 IN (0, 1, 4) AS INTEGER) AS blank,
  CAST(seq % 5 IN (2, 3) AS INTEGER) AS "notBlank",
  CASE WHEN seq % 5 = 3 THEN CAST(seq AS BIGINT) END AS "asLong",
  CAST(ms AS VARCHAR) AS "asText",
  greatest(ms, other) AS later,
  CASE WHEN seq % 5 < 3 THEN city ELSE '' END AS mapped
FROM (SELECT *, ms - CASE seq % 3 WHEN 0 THEN 86400000 WHEN 1 THEN 0 ELSE -86400000 END AS other
      FROM clicks)"""),
}

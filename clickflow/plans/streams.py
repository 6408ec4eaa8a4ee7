"""Streaming queries run to the end of the given tables, each with the SQL that must agree.

A window only fires once the watermark has passed its end, so the newest windows of a finite
run stay open; the SQL leaves out exactly those.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickflow.operators import envelope, metrics, widen
from clickflow.operators.history import VisitorHistory
from clickflow.operators.totals import Ledger
from clickflow.operators.visitors import VISITOR_KEY
from clickflow.plans import clicks as batch
from clickflow.plans import stores
from clickflow.session import keep_table, setting, work_folder
from clickflow.sources import files, tables
from clickflow.streaming import job
from clickflow.streaming.visitors import state_history


def raw_records(events):
    """Events as raw records: enveloped, numbered, with the broker's time half a second later."""
    clicks = tables.event_clicks(events)
    bodies = clicks.withColumn("body", tables.click_body("channelID", "produceID", "userID")) \
        .withColumn("arrivalMs", F.col("timestamp") + 500)
    return envelope.build_envelopes(bodies, "body", "timestamp", keep=("seq", "arrivalMs"))


def event_part():
    """Thirds of the events' month."""
    return F.floor((F.dayofmonth("ts") - 1) / 11)


def order_part(orders):
    """Thirds of the orders by their key, which is their order of arrival."""
    third = orders.agg(F.max("o_orderkey")).first()[0] // 3 + 1
    return F.floor(F.col("o_orderkey") / third)


def _fed(spark, folder, name, part, run, parts=3):
    """Gives a table to a job in parts, one run of the job from its checkpoint for each."""
    out = work_folder(spark, f"fed-{name}")
    rows = tables.read_table(spark, folder, name)
    for number in range(parts):
        rows.where(part == number).write.mode("append").parquet(f"{out}/input")
        stream = files.stream_files(spark, f"{out}/input", rows.schema)
        run(stream, out).awaitTermination()
    return out


def stream_parse(spark, folder):
    """Raw records parsed to flat clicks on a stream, in three runs."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_file_sink(
        job.parse_raw(raw_records(stream)), f"{out}/rows", f"{out}/checkpoint", None))
    return spark.read.parquet(f"{out}/rows")


def stream_new_visitor_flags(spark, folder):
    """Flags of three batches, each looked up in the history the ones before it left."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_flag_job(
        tables.event_clicks(stream).select("seq", "userID", "channelID", "timestamp"), out,
        f"{out}/checkpoint", lambda flagged: flagged.select(*batch.FLAG_COLUMNS), None))
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


def _over_windows(spark, folder, table):
    """Windows that are over after three batches of the large-batch job."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_bulk_click_job(
        tables.event_clicks(stream), out, f"{out}/checkpoint", (table,), None))
    return job.ClickBatches(spark, out, (table,)).over_windows(table)


def stream_pvuv(spark, folder):
    """The whole chain from raw records; the broker's time decides the window."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_raw_click_job(
        raw_records(stream), out, f"{out}/checkpoint", trigger=None))
    return job.ClickBatches(spark, out, ("channel_pvuv",)).over_windows("channel_pvuv")


def stream_freshness(spark, folder):
    return _over_windows(spark, folder, "channel_freshness")


def stream_hot(spark, folder):
    return _over_windows(spark, folder, "channel")


def stream_hot_last_window(spark, folder):
    return metrics.last_window(_over_windows(spark, folder, "channel"))


# Eight days of events per step; a tenth of the clicks comes one step late, a tenth two.
STEPS = 6


def _write_steps(spark, folder, out, digit="event_id % 10"):
    """Events written in steps, each later than the one before, with some clicks held back."""
    events = tables.read_table(spark, folder, "events")
    digit = F.expr(digit)
    held = F.when(digit == 0, 1).when(digit == 1, 2).otherwise(0)
    step = F.floor((F.dayofmonth("ts") - 1) / 8) + held
    for number in range(STEPS):
        events.where(step == number).write.mode("append").parquet(out)
        yield events.schema


def _stepped_ledger(spark, folder, fold=False, start=job.start_click_job):
    """Writes a step, runs a click job to its end, and so on, each run from the checkpoint."""
    out = work_folder(spark, "steps")
    ledger = Ledger(spark, f"{out}/ledger")
    for number, schema in enumerate(_write_steps(spark, folder, f"{out}/input")):
        stream = files.stream_files(spark, f"{out}/input", schema)
        query = start(
            tables.event_clicks(stream), ledger.folder, f"{out}/checkpoint",
            ("channel_pvuv", "channel_freshness", "channel"), None)
        query.awaitTermination()
        if fold and number % 2:
            ledger.fold(number)
    return ledger


def stream_late_rows(spark, folder):
    """Late clicks are missing from the windows but still make their visitors known."""
    return _stepped_ledger(spark, folder).windows("channel_pvuv")


def stream_totals(spark, folder):
    """Running totals after restarts and folding old batches three times."""
    return _stepped_ledger(spark, folder, fold=True).totals("channel_pvuv")


def stream_batch_counts(spark, folder):
    """Good, bad and late records of each batch, counted in the pass that sums the windows."""
    out = work_folder(spark, "counts")
    for schema in _write_steps(spark, folder, f"{out}/input", "floor(event_id / 10) % 10"):
        events = files.stream_files(spark, f"{out}/input", schema)
        job.start_raw_click_job(tables.damaged_envelopes(tables.event_bodies(events)), f"{out}/ledger",
                                f"{out}/checkpoint", trigger=None).awaitTermination()
    return job.ClickBatches(spark, f"{out}/ledger", ("channel_pvuv",)).counts()


def stream_bulk_late_rows(spark, folder):
    """The large-batch job on the same late clicks."""
    ledger = _stepped_ledger(spark, folder, start=job.start_bulk_click_job)
    return ledger.windows("channel_freshness")


def stream_bulk_totals(spark, folder):
    """The large-batch job over all events, in three batches."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_bulk_click_job(
        tables.event_clicks(stream), out, f"{out}/checkpoint", trigger=None))
    return Ledger(spark, out).totals("channel_pvuv")


def stream_click_wide(spark, folder):
    """The 22 columns of the widened click on a stream."""
    out = _fed(spark, folder, "events", event_part(), lambda stream, out: job.start_flag_job(
        tables.event_clicks(stream), out, f"{out}/checkpoint",
        lambda flagged: widen.wide_clicks(flagged, keep=("seq",)), None))
    return spark.read.parquet(f"{out}/rows").drop("batch_id")


def stream_user_history(spark, folder):
    """The visitor history the large-batch job leaves behind."""
    part = order_part(tables.read_table(spark, folder, "orders"))
    out = _fed(spark, folder, "orders", part, lambda stream, out: job.start_bulk_click_job(
        tables.order_clicks(stream), out, f"{out}/checkpoint", trigger=None))
    return VisitorHistory(spark, out).snapshot()


def stream_state_history(spark, folder):
    """The visitor history of the low-latency job, read from its state after two restarts."""
    part = order_part(tables.read_table(spark, folder, "orders"))
    out = _fed(spark, folder, "orders", part, lambda stream, out: job.start_click_job(
        tables.order_clicks(stream), out, f"{out}/checkpoint", trigger=None))
    return state_history(spark, f"{out}/checkpoint")


def date_part():
    """Thirds of the orders by their date, so that a part is newer than all before it."""
    return F.least(F.floor((F.year("o_orderdate") - 1995) / 2.5), F.lit(2))


def stream_pvuv_rollup(spark, folder):
    """Hours, days and months summed inside the stream and emitted when they are over."""
    out = _fed(spark, folder, "orders", date_part(), lambda stream, out: job.start_rollup_job(
        tables.order_clicks(stream), f"{out}/rows", f"{out}/checkpoint", trigger=None))
    return spark.read.parquet(f"{out}/rows")


def stream_change_records(spark, folder):
    """Change entries fetched in four runs of the job, the second of them without entries."""
    out = work_folder(spark, "changes")
    texts = stores.load_entry_texts(spark, folder)
    part = F.floor(F.col("batchId") / 2) % 3
    for chosen in (part == 0, F.lit(False), part == 1, part == 2):
        texts.where(chosen).select("value").write.mode("append").text(f"{out}/input")
        stream = files.stream_entry_texts(spark, f"{out}/input")
        job.start_change_job(stream, out, f"{out}/checkpoint", trigger=None).awaitTermination()
    records = spark.read.parquet(f"{out}/records")
    return stores.spread_columns(records)


# Entries per input file, about, where there are enough of them for more than five files.
FILE_ENTRIES = 100_000


def stream_change_fetches(spark, folder):
    """Change entries in fetches of 100, numbered on over the files of a batch and over three runs."""
    out = work_folder(spark, "fetches")
    texts = stores.load_entry_texts(spark, folder).select(F.lit("log").alias("logFile"), "position", "value")
    # made once, not for the count and each part again; in short files, as no task reads less than a row group
    with setting(spark, spark__sql__files__maxRecordsPerFile=FILE_ENTRIES):
        texts = keep_table(texts, "entries")
    newest, entries = texts.agg(F.max("position"), F.count(F.lit(1))).first()
    third, per_part = newest // 3 + 1, max(5, entries // (3 * FILE_ENTRIES))
    for part in range(3):
        # a task sorts what it reads, to deal it out
        with setting(spark, spark__sql__files__maxPartitionBytes=job.ENTRY_READ):
            texts.where(F.floor(F.col("position") / third) == part).repartition(per_part).write.mode("append").parquet(f"{out}/input")
        stream = files.stream_files(spark, f"{out}/input", texts.schema)
        job.start_change_job(stream, out, f"{out}/checkpoint", trigger=None, fetch_entries=100).awaitTermination()
    return stores.spread_columns(spark.read.parquet(f"{out}/records"))


QUERIES = {f.__name__: f for f in [
    stream_parse, stream_new_visitor_flags, stream_pvuv, stream_freshness, stream_hot,
    stream_hot_last_window, stream_late_rows, stream_totals, stream_batch_counts, stream_bulk_late_rows,
    stream_bulk_totals, stream_click_wide, stream_user_history, stream_state_history,
    stream_pvuv_rollup, stream_change_records, stream_change_fetches,
]}


# --- The same results in SQL ------------------------------------------------------------

FIRED = """
fired AS (
  SELECT * REPLACE ((ms + {shift}) // 3000 * 3000 AS "windowStart") FROM flagged
  WHERE (ms + {shift}) // 3000 * 3000 + 3000 <= (SELECT max(ms) + {shift} - 2000 FROM flagged))"""


def _fired(shift: int = 0) -> str:
    return FIRED.replace("{shift}", str(shift))


def _of_fired(spread: str) -> str:
    return spread.replace("FROM flagged", "FROM fired")


STEPPED = """
stepped AS (
  SELECT *, (day(make_timestamp(ms * 1000)) - 1) // 8
            + CASE seq % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS step
  FROM clicks),
dated AS (
  SELECT *, make_timestamp(ms * 1000) AS ts,
         lag(make_timestamp(ms * 1000)) OVER (
           PARTITION BY "userID", "channelID" ORDER BY step, seq) AS past
  FROM stepped)"""

# Each step is a run to the end, so the watermark has caught up with all steps before it.
IN_TIME = """
marks AS (
  SELECT s.step, (SELECT max(ms) - 2000 FROM stepped WHERE stepped.step <= s.step - 1) AS mark
  FROM (SELECT DISTINCT step FROM stepped) s),
fired AS (
  SELECT flagged.* FROM flagged JOIN marks USING (step)
  WHERE "windowStart" + 3000 > coalesce(mark, 0)
    AND "windowStart" + 3000 <= (SELECT max(ms) - 2000 FROM flagged))"""

# The large-batch job knows the batch right before, and its windows need not be over.
BULK_IN_TIME = """
marks AS (
  SELECT s.step, (SELECT max(ms) - 2000 FROM stepped WHERE stepped.step <= s.step - 1) AS mark
  FROM (SELECT DISTINCT step FROM stepped) s),
fired AS (
  SELECT flagged.* FROM flagged JOIN marks USING (step)
  WHERE "windowStart" + 3000 > coalesce(mark, 0))"""

ONLY_FLAGS = batch.FLAGS[batch.FLAGS.index("flagged AS"):]

_with = batch._with

ORACLES = {
    "stream_parse": _with(batch.EVENTS, then="SELECT seq, ms + 500 AS \"arrivalMs\", " + ", ".join(
        f'"{n}"' if n in ("channelID", "produceID", "userID")
        else f'CAST(NULL AS VARCHAR) AS "{n}"' for n in batch.CLICK_FIELDS)
        + ', "count", ms AS "timestamp" FROM clicks'),
    "stream_new_visitor_flags": batch.ORACLES["new_visitor_flags"],
    "stream_pvuv": _with(batch.EVENTS, batch.FLAGS, _fired(500), _of_fired(batch.PVUV), then=f"""
SELECT "windowStart", "channelId", "yearMonthDayHour", {batch.SUM_PVUV}
FROM spread GROUP BY 1, 2, 3"""),
    "stream_freshness": _with(batch.EVENTS, batch.FLAGS, _fired(), _of_fired(batch.FRESHNESS),
                              then=f"""
SELECT "windowStart", "channelId", date, {batch.SUM_FRESHNESS} FROM spread GROUP BY 1, 2, 3"""),
    "stream_hot": _with(batch.EVENTS, batch.FLAGS, _fired(), then="""
SELECT "windowStart", "channelID" AS "channelId", CAST(sum("count") AS BIGINT) AS visited
FROM fired GROUP BY 1, 2"""),
    "stream_hot_last_window": _with(batch.EVENTS, batch.FLAGS, _fired(), """
windows AS (
  SELECT "windowStart", "channelID" AS "channelId", CAST(sum("count") AS BIGINT) AS visited
  FROM fired GROUP BY 1, 2)""", then="""
SELECT "channelId", arg_max(visited, "windowStart") AS visited FROM windows GROUP BY 1"""),
    "stream_late_rows": _with(batch.EVENTS, STEPPED, ONLY_FLAGS, IN_TIME, _of_fired(batch.PVUV),
                              then=f"""
SELECT "windowStart", "channelId", "yearMonthDayHour", {batch.SUM_PVUV}
FROM spread GROUP BY 1, 2, 3"""),
    "stream_totals": _with(batch.EVENTS, STEPPED, ONLY_FLAGS, IN_TIME, _of_fired(batch.PVUV),
                           then=f"""
SELECT "channelId", "yearMonthDayHour", {batch.SUM_PVUV} FROM spread GROUP BY 1, 2"""),
    "stream_batch_counts": _with(batch.EVENTS, STEPPED.replace("seq % 10", "seq // 10 % 10"), """
marks AS (
  SELECT s.step, (SELECT max(ms) - 2000 FROM stepped WHERE stepped.step < s.step AND seq % 10 IN (5, 7, 8, 9)) AS mark
  FROM (SELECT DISTINCT step FROM stepped) s)""", then="""
SELECT CAST(step AS BIGINT) AS batch, CAST(count(*) FILTER (seq % 10 IN (5, 7, 8, 9)) AS BIGINT) AS good,
       CAST(count(*) FILTER (seq % 10 NOT IN (5, 7, 8, 9)) AS BIGINT) AS bad,
       CAST(count(*) FILTER (seq % 10 IN (5, 7, 8, 9) AND ms // 3000 * 3000 + 3000 <= mark) AS BIGINT) AS late
FROM stepped JOIN marks USING (step) GROUP BY step"""),
    "stream_bulk_late_rows": _with(
        batch.EVENTS, STEPPED, ONLY_FLAGS, BULK_IN_TIME, _of_fired(batch.FRESHNESS), then=f"""
SELECT "windowStart", "channelId", date, {batch.SUM_FRESHNESS} FROM spread GROUP BY 1, 2, 3"""),
    "stream_bulk_totals": batch.ORACLES["channel_pvuv"],
    "stream_click_wide": batch.ORACLES["click_wide"],
    "stream_user_history": batch.ORACLES["user_history"],
    "stream_state_history": batch.ORACLES["user_history"],
    "stream_pvuv_rollup": _with(batch.ORDERS, """
stepped AS (
  SELECT *, least((year(make_timestamp(ms * 1000)) - 1995) * 2 // 5, 2) AS step FROM clicks),
dated AS (
  SELECT *, make_timestamp(ms * 1000) AS ts,
         lag(make_timestamp(ms * 1000)) OVER (
           PARTITION BY "userID", "channelID" ORDER BY step, seq) AS past
  FROM stepped)""", ONLY_FLAGS, batch.PVUV, """
ends AS (
  SELECT *, CASE length("yearMonthDayHour")
      WHEN 10 THEN strptime("yearMonthDayHour", '%Y%m%d%H') + INTERVAL 1 HOUR
      WHEN 8 THEN strptime("yearMonthDayHour", '%Y%m%d') + INTERVAL 1 DAY
      ELSE strptime("yearMonthDayHour" || '01', '%Y%m%d') + INTERVAL 1 MONTH END AS over_at
  FROM spread)""", then=f"""
SELECT "channelId", "yearMonthDayHour", {batch.SUM_PVUV} FROM ends
WHERE epoch_ms(over_at) <= (SELECT max(ms) - 2000 FROM clicks) GROUP BY 1, 2"""),
    "stream_change_records": _with(stores.ENTRIES, """
numbered AS (
  SELECT *, CAST(("batchId" // 2) % 3 + 1 AS INTEGER) AS "emptyCount" FROM kinds
  WHERE k % 6 NOT IN (0, 4, 5))""", stores.RECORDS, then=stores.SPREAD),
    "stream_change_fetches": _with(stores.ENTRIES, """
numbered AS (
  SELECT * FROM (
    SELECT *, CAST((row_number() OVER (ORDER BY k, "entryType") - 1) // 100 + 1 AS INTEGER) AS "emptyCount"
    FROM kinds)
  WHERE k % 6 NOT IN (0, 4, 5))""", stores.RECORDS, then=stores.SPREAD),
}

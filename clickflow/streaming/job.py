"""The click job from raw records to running totals, and the change-record job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from clickflow.operators import changes, envelope
from clickflow.operators.batchlog import BatchLog, write_batch
from clickflow.operators.history import JOIN_SETTINGS, VisitorHistory
from clickflow.operators.metrics import GRAINS, WINDOW_MS, hourly_sums, window_start
from clickflow.operators.numbering import number_by
from clickflow.operators.totals import TOTALS, Ledger
from clickflow.operators.visitors import FLAG_NAMES, VISITOR_KEY, hot_visitors
from clickflow.operators.widen import with_hour_key
from clickflow.schemas import CLICK_FIELDS
from clickflow.session import ROCKSDB_PROVIDER, setting
from clickflow.streaming.visitors import stream_visitor_flags
from clickflow.streaming.windows import LATENESS_MS, event_ms, pvuv_rollup, window_sums

TRIGGER = "5 seconds"

# Batches between two foldings of the tables a job keeps.
FOLD_EVERY = 500

# What one task of the change job reads: entries of one kind pack to a tenth of their size, and so much to
# some 400,000 of them.
ENTRY_READ = "32m"

# What the metrics read of a click; everything else is dropped before the state.
METRIC_COLUMNS = ["seq", "userID", "channelID", "count", "timestamp", "arrivalMs"]


def parse_raw(raw: DataFrame, fields: list[str] = CLICK_FIELDS) -> DataFrame:
    """Raw records to flat clicks with the named fields, bad records left out."""
    keep = tuple(n for n in ("seq", "arrivalMs") if n in raw.columns)
    messages = envelope.parse_messages(raw, keep=keep, fields=fields)
    return envelope.flatten_messages(envelope.good_messages(messages), keep)


def bad_raw(raw: DataFrame) -> DataFrame:
    """The bad raw records with their reason, for a stream of their own."""
    return envelope.bad_messages(envelope.parse_messages(raw))


def start(writer, spark: SparkSession, checkpoint: str, trigger: str | None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Starts a query; ``trigger=None`` works off what is there and ends.

    State is kept in RocksDB and saved as changes, so a batch costs what it changed and not
    what all visitors take up. It is split over ``state_partitions``, by default one per core, for as long as the
    checkpoint lives.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(
        availableNow=True)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    with setting(spark, spark__sql__shuffle__partitions=partitions,
                 spark__sql__streaming__stateStore__providerClass=ROCKSDB_PROVIDER,
                 spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true"):
        return writer.start()


def _metric_clicks(clicks: DataFrame, tasks: tuple[str, ...]) -> tuple[DataFrame, bool]:
    """The columns the wanted result tables need, and whether they need visitor flags."""
    if not tasks or set(tasks) - set(TOTALS):
        raise ValueError(f"tasks must be some of {sorted(TOTALS)}")
    narrow = clicks.select(*[n for n in METRIC_COLUMNS if n in clicks.columns])
    return narrow, set(tasks) != {"channel"}


def _unflagged(clicks: DataFrame) -> DataFrame:
    """Clicks with all flags 0, for channel heat, which does not look at them."""
    return with_hour_key(clicks).withColumns({n: F.lit(0) for n in FLAG_NAMES})


def start_click_job(clicks: DataFrame, folder: str, checkpoint: str,
                    tasks: tuple[str, ...] = ("channel_pvuv",), trigger: str | None = TRIGGER,
                    state_partitions: int | None = None,
                    fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Keeps the ledger below ``folder`` up to date from a stream of clicks.

    ``Ledger(spark, folder).totals(table)`` gives the running totals of each wanted table.
    """
    spark = clicks.sparkSession
    ledger = Ledger(spark, folder)
    narrow, need_flags = _metric_clicks(clicks, tasks)
    if need_flags:
        passed = [n for n in ("channelID", "count", "arrivalMs") if n in narrow.columns]
        flagged = stream_visitor_flags(narrow, passed)
    else:
        flagged = _unflagged(narrow)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with setting(batch.sparkSession, spark__sql__adaptive__enabled="true"):
            ledger.append(batch, batch_id)
            ledger.maintain(batch_id, fold_every)

    writer = window_sums(flagged).writeStream.outputMode("append").foreachBatch(handle)
    return start(writer, spark, checkpoint, trigger, state_partitions)


def start_rollup_job(clicks: DataFrame, folder: str, checkpoint: str,
                     grains: tuple[str, ...] = GRAINS, trigger: str | None = TRIGGER,
                     state_partitions: int | None = None) -> StreamingQuery:
    """Appends views and unique visitors of periods that are over to Parquet files, each once."""
    narrow, _ = _metric_clicks(clicks, ("channel_pvuv",))
    passed = [n for n in ("channelID", "count", "arrivalMs") if n in narrow.columns]
    rows = pvuv_rollup(stream_visitor_flags(narrow, passed), grains)
    return start_file_sink(rows, folder, checkpoint, trigger, state_partitions)


class Highest:
    """One whole number per batch, of which only the highest so far is ever asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.log = BatchLog(spark, folder, "number bigint")

    def before(self, batch_id: int | None = None) -> int | None:
        """The highest number of the batches before one, or of all."""
        done = self.log.folded_up_to()
        return self._highest(done, self.log.batches(done, None if batch_id is None else batch_id - 1)).first()[0]

    def _highest(self, done: int, fresh: DataFrame) -> DataFrame:
        every = self.log.base("base", done, self.log.schema).unionByName(fresh.select("number"))
        return every.agg(F.max("number").alias("number"))

    def append(self, number: int, batch_id: int) -> None:
        one = self.log.spark.range(1).select(F.lit(number).cast("bigint").alias("number"))
        self.log.append(one, batch_id)

    def maintain(self, batch_id: int, every: int) -> None:
        self.log.maintain(batch_id, every, lambda upto: self.log.fold(
            upto, lambda done, fresh: {"base": self._highest(done, fresh)}))


COUNTS = "batch bigint, good bigint, bad bigint, late bigint"


class ClickBatches:
    """What a job of large batches keeps below its folder, and how a batch of clicks adds to it."""

    def __init__(self, spark: SparkSession, folder: str, tasks: tuple[str, ...], fold_every: int = FOLD_EVERY,
                 **hot_limits):
        self.ledger, self.history = Ledger(spark, folder), VisitorHistory(spark, folder)
        self.newest = Highest(spark, f"{self.ledger.folder}/newest")
        self.count_log = BatchLog(spark, f"{self.ledger.folder}/counts", COUNTS)
        self.need_flags, self.fold_every, self.hot_limits = set(tasks) != {"channel"}, fold_every, hot_limits

    def add(self, clicks: DataFrame, batch_id: int) -> None:
        """Adds a batch of stored clicks, some of which may be marked ``bad``: they are counted only.

        One pass, the one that fills the store, finds the batch's newest click and its counts.
        """
        seen = self.newest.before(batch_id)
        bad = F.col("bad") if "bad" in clicks.columns else F.lit(False)
        clicks = clicks.withColumn("_ms", event_ms(clicks)).withColumn("windowStart", window_start("_ms"))
        over = F.lit(False) if seen is None else F.col("windowStart") + WINDOW_MS <= seen - LATENESS_MS
        found = clicks.agg(F.max(F.when(~bad, F.col("_ms"))), F.count_if(~bad), F.count_if(bad),
                           F.count_if(~bad & over)).first()
        if found[0] is not None:
            self._add_windows(clicks.where(~bad).drop("bad"), batch_id, found[0], over)
        self.count_log.append(self.ledger.log.spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch"),
            *[F.lit(n).cast("bigint").alias(name) for name, n in zip(("good", "bad", "late"), found[1:])]), batch_id)
        for table in (self.ledger, self.history, self.newest):
            table.maintain(batch_id, self.fold_every)
        self.count_log.maintain(batch_id, self.fold_every, lambda upto: self.count_log.fold(
            upto, lambda done, fresh: {"base": self._counts(done, fresh).coalesce(1)}))

    def _add_windows(self, clicks: DataFrame, batch_id: int, latest: int, over: Column) -> None:
        if self.need_flags:
            flagged = self.history.flag(clicks, batch_id, hot_visitors(clicks, **self.hot_limits))
        else:
            flagged = _unflagged(clicks)
        self.ledger.append(hourly_sums(flagged.where(~over), "windowStart"), batch_id)
        if self.need_flags:
            self.history.append(clicks, batch_id)
        self.newest.append(latest, batch_id)

    def _counts(self, done: int, fresh: DataFrame) -> DataFrame:
        return self.count_log.base("base", done, COUNTS).unionByName(fresh.drop("batch_id"))

    def counts(self) -> DataFrame:
        """Per batch its good and bad records, and the good ones that were too late for their window."""
        done = self.count_log.folded_up_to()
        return self._counts(done, self.count_log.batches(done))

    def over_windows(self, table: str, **options) -> DataFrame:
        """A result table per window, of the windows that are over: no click in time can follow."""
        newest = self.newest.before()
        windows = self.ledger.windows(table, **options)
        return windows.where("false") if newest is None else windows.where(
            F.col("windowStart") + WINDOW_MS <= newest - LATENESS_MS)


def start_bulk_click_job(clicks: DataFrame, folder: str, checkpoint: str,
                         tasks: tuple[str, ...] = ("channel_pvuv",),
                         trigger: str | None = "1 minute", fold_every: int = FOLD_EVERY,
                         shuffle_partitions: int | None = None, **hot_limits) -> StreamingQuery:
    """The same ledger from large micro-batches, with the visitor history as a table.

    Every step is an ordinary batch query: no Python runs, and a visitor or robot that sends
    a large part of all clicks is split over many tasks. Each batch reads the buckets of the
    history that its visitors are in. All that a batch
    writes follows from its input and from what earlier batches wrote, so a replay rewrites
    the same rows. Clicks whose window had ended two seconds before the newest click of the
    batches before theirs are late: they count for the history but for no window.
    ``ClickBatches(spark, folder, tasks)`` reads the windows that are over and the batches' counts.
    """
    narrow, _ = _metric_clicks(clicks, tasks)
    batches = ClickBatches(clicks.sparkSession, folder, tasks, fold_every, **hot_limits)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Streams run with adaptive execution off; these queries are plain batch queries.
        batch = batch.persist()
        with batch_settings(batch.sparkSession, shuffle_partitions):
            try:
                batches.add(batch, batch_id)
            finally:
                batch.unpersist()

    return start(narrow.writeStream.foreachBatch(handle), clicks.sparkSession, checkpoint, trigger)


def start_raw_click_job(raw: DataFrame, folder: str, checkpoint: str,
                        tasks: tuple[str, ...] = ("channel_pvuv",),
                        trigger: str | None = "1 minute", fold_every: int = FOLD_EVERY,
                        shuffle_partitions: int | None = None, **hot_limits) -> StreamingQuery:
    """As ``start_bulk_click_job``, from raw records, each read and parsed once: good, bad and late ones of
    a batch are counted in that pass."""
    _metric_clicks(raw, tasks)
    batches = ClickBatches(raw.sparkSession, folder, tasks, fold_every, **hot_limits)
    keep = tuple(n for n in ("seq", "arrivalMs") if n in raw.columns)

    def handle(batch: DataFrame, batch_id: int) -> None:
        messages = envelope.parse_messages(batch, keep=keep, fields=VISITOR_KEY)
        flat = envelope.flatten_messages(
            messages.withColumn("bad", F.col("badReason").isNotNull()), (*keep, "bad"))
        clicks = flat.select("bad", *[n for n in METRIC_COLUMNS if n in flat.columns]).persist()
        with batch_settings(batch.sparkSession, shuffle_partitions):
            try:
                batches.add(clicks, batch_id)
            finally:
                clicks.unpersist()

    return start(raw.writeStream.foreachBatch(handle), raw.sparkSession, checkpoint, trigger)


def batch_settings(spark: SparkSession, shuffle_partitions: int | None):
    """Settings of the batch queries inside a micro-batch, chosen anew with every start.

    The number a stream's own checkpoint keeps is for its state, which these jobs do not have.
    """
    more = {"spark__sql__shuffle__partitions": shuffle_partitions} if shuffle_partitions else {}
    return setting(spark, spark__sql__adaptive__enabled="true", **JOIN_SETTINGS, **more)


def start_flag_job(clicks: DataFrame, folder: str, checkpoint: str,
                   shape: Callable[[DataFrame], DataFrame] = lambda flagged: flagged,
                   trigger: str | None = "1 minute", fold_every: int = FOLD_EVERY,
                   shuffle_partitions: int | None = None, **hot_limits) -> StreamingQuery:
    """Writes a stream's clicks with their visitor flags to ``folder/rows``, batch by batch.

    All on the JVM: the click before is found inside the batch, and in the visitor history for
    a visitor's first click of the batch. ``shape`` chooses the columns written. A replay
    rewrites its own batch's rows. ``VisitorHistory(spark, folder).snapshot()`` reads the
    history.
    """
    spark = clicks.sparkSession
    history = VisitorHistory(spark, folder)

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        with batch_settings(batch.sparkSession, shuffle_partitions):
            try:
                flagged = history.flag(batch, batch_id, hot_visitors(batch, **hot_limits))
                write_batch(shape(flagged), f"{folder}/rows", batch_id)
                history.append(batch, batch_id)
                history.maintain(batch_id, fold_every)
            finally:
                batch.unpersist()

    return start(clicks.writeStream.foreachBatch(handle), spark, checkpoint, trigger)


def start_file_sink(stream: DataFrame, folder: str, checkpoint: str,
                    trigger: str | None = TRIGGER,
                    state_partitions: int | None = None) -> StreamingQuery:
    """Appends a stream's rows to Parquet files, each row exactly once."""
    writer = stream.writeStream.format("parquet").option("path", folder)
    return start(writer, stream.sparkSession, checkpoint, trigger, state_partitions)


def start_change_job(texts: DataFrame, folder: str, checkpoint: str,
                     pattern: str = changes.ALL_TABLES,
                     trigger: str | None = TRIGGER, fold_every: int = FOLD_EVERY,
                     send: Callable[[DataFrame], None] | None = None,
                     shuffle_partitions: int | None = None, fetch_entries: int | None = None,
                     order: tuple[str, ...] = ("logFile", "position", "value")) -> StreamingQuery:
    """Flattens a stream of change-entry texts into ``folder/records``, ``folder/bad`` beside it.

    Non-empty micro-batches are numbered 1, 2, 3, ... across restarts. With ``fetch_entries`` it is
    fetches of so many entries that are numbered, markers and unreadable entries among them: the entries of a
    micro-batch are put in the ``order`` of the log (columns beside the text), and a fetch may begin in
    one file or micro-batch and end in the next. ``send`` is given each
    batch's topic records, for example ``lambda r: write_topic(r, servers, topic)``; a replay
    sends the same keys again.
    """
    spark = texts.sparkSession
    fetches = Highest(spark, f"{folder.rstrip('/')}/fetches")

    def numbered(batch: DataFrame, batch_id: int) -> DataFrame:
        before = fetches.before(batch_id) or 0
        if fetch_entries is None:
            return batch.withColumn("emptyCount", F.lit(before + 1))
        place = F.floor((F.col("_entry") - 1 + before) / fetch_entries) + 1
        ranked = number_by(batch, list(order), "_entry", f"{folder.rstrip('/')}/in-order")
        return ranked.withColumn("emptyCount", place.cast("int"))

    def handle_entries(parsed: DataFrame, batch_id: int) -> None:
        entries = parsed.count()
        if not entries:
            return
        fetches.append((fetches.before(batch_id) or 0) + (entries if fetch_entries else 1), batch_id)
        fetches.maintain(batch_id, fold_every)
        records = changes.flatten_entries(changes.subscribe(changes.good_entries(parsed), pattern))
        write_batch(records, f"{folder}/records", batch_id)
        if send:
            send(changes.topic_records(records))
        write_batch(changes.bad_entries(parsed), f"{folder}/bad", batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Read and parsed once, into a table, for the test whether there is anything and for all that is written:
        # cached entries take several times the room of their texts, and that in the executors' memory.
        path = f"{folder.rstrip('/')}/parsed"
        with batch_settings(batch.sparkSession, shuffle_partitions), \
                setting(batch.sparkSession, spark__sql__files__maxPartitionBytes=ENTRY_READ):
            parsed = changes.parse_entries(numbered(batch, batch_id), keep=("emptyCount",))
            parsed = parsed.withColumn("raw", F.when(F.col("badReason").isNotNull(), F.col("raw")))
            parsed.write.mode("overwrite").parquet(path)
            handle_entries(batch.sparkSession.read.schema(parsed.schema).parquet(path), batch_id)

    return start(texts.writeStream.foreachBatch(handle), spark, checkpoint, trigger)

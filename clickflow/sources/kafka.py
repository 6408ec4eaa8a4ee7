"""Topic options and topic reads and writes. Needs Spark's Kafka connector on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, **settings) -> dict[str, str]:
    """Client options for a topic source or sink, e.g. ``retries=1``, ``linger_ms=1``,
    ``batch_size=1024``, ``buffer_memory=33554432``, ``group_id="clicks"``."""
    options = {"kafka.bootstrap.servers": servers}
    for name, value in settings.items():
        key = name.replace("_", ".")
        options["kafka." + key] = str(value)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               records_per_batch: int | None = None, **settings) -> DataFrame:
    """A streaming topic as raw records: text, arrival number and broker time.

    Read offsets are kept in the query's checkpoint, not committed to the broker. Give
    ``records_per_batch`` to work through a backlog in steps the cluster can hold; clicks are
    late by the batches before theirs, so steps also decide which clicks those are.
    """
    stream = (
        spark.readStream.format("kafka").options(**kafka_options(servers, **settings))
        .option("subscribe", topic).option("startingOffsets", starting)
    )
    if records_per_batch:
        stream = stream.option("maxOffsetsPerTrigger", records_per_batch)
    return number_topic_records(stream.load())


def number_topic_records(records: DataFrame) -> DataFrame:
    """Topic columns to raw records, numbered by broker time, then partition, then offset.

    The three stand side by side in one decimal of 38 digits: 14 for the time, 5 for the
    partition, 19 for the offset. So numbers are unique and rise within a partition.
    """
    arrival = F.unix_millis("timestamp")
    seq = F.expr(
        "CAST(CAST(unix_millis(timestamp) AS DECIMAL(14,0)) * CAST('1000000000000000000000000' AS DECIMAL(25,0))"
        " + CAST(`partition` AS DECIMAL(5,0)) * CAST('10000000000000000000' AS DECIMAL(20,0))"
        " + CAST(`offset` AS DECIMAL(19,0)) AS DECIMAL(38,0))")
    return records.select(
        F.col("value").cast("string").alias("value"), seq.alias("seq"), arrival.alias("arrivalMs"))


def even_out(records: DataFrame, partitions: int | None) -> DataFrame:
    """Deals records out in turn over a number of tasks, whatever their keys."""
    return records.repartition(partitions) if partitions else records


def write_topic(records: DataFrame, servers: str, topic: str,
                partitions: int | None = None, **settings) -> None:
    """Writes ``value`` (and ``key``, if there is one) records to a topic as one batch."""
    (
        even_out(records, partitions).write.format("kafka")
        .options(**kafka_options(servers, **settings)).option("topic", topic).save()
    )


def start_topic_sink(records: DataFrame, servers: str, topic: str, checkpoint: str, **settings):
    """Writes a stream of ``value`` (and ``key``) records to a topic as it arrives."""
    return (
        records.writeStream.format("kafka").options(**kafka_options(servers, **settings))
        .option("topic", topic).option("checkpointLocation", checkpoint).start()
    )

"""Message topics. Rows have ``value BINARY`` and the other columns of a topic read.

The topic connector is a separate Spark package. Where it is absent, the same jobs run
on files of messages (:func:`read_message_files_stream`), which have the same ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_options(
    servers: str,
    topic: str,
    starting: str | None = None,
    ending: str | None = None,
    fail_on_data_loss: bool = True,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options: where to start, whether expired offsets fail, and the rate limit."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting:
        options["startingOffsets"] = starting
    if ending:
        options["endingOffsets"] = ending
    options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded read of one topic from ``earliest`` or ``latest``."""
    options = topic_options(servers, topic, starting, None, fail_on_data_loss, max_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic_batch(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    fail_on_data_loss: bool = False,
) -> DataFrame:
    """Bounded read of one topic, for baseline statistics."""
    options = topic_options(servers, topic, starting, ending, fail_on_data_loss)
    return spark.read.format("kafka").options(**options).load()


def read_message_files_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of messages."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(F.col("value").cast("binary").alias("value"))


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    """The same folder as a table of messages."""
    return spark.read.text(path).select(F.col("value").cast("binary").alias("value"))

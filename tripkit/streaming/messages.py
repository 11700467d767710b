"""Keyed JSON messages: building them, reading them from a topic or files, publishing results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a trip message, and the form of its times.
TRIP_MESSAGE = T.StructType(
    [
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("pickup_borough", T.StringType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
    ]
)
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_keyed_json(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """``key`` and ``value`` text columns; timestamps are written in ISO form."""
    names = columns or df.columns
    options = {"timestampNTZFormat": ISO_FORMAT, "timestampFormat": ISO_FORMAT, "ignoreNullFields": "false"}
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*names), options).alias("value")
    )


def parse_json(messages: DataFrame, schema: T.StructType = TRIP_MESSAGE, keep_key: bool = True) -> DataFrame:
    """Fields of JSON messages; a field that is absent or of the wrong type is null."""
    value = F.from_json(F.col("value").cast("string"), schema, {"timestampNTZFormat": ISO_FORMAT})
    key = [F.col("key").cast("string").alias("key")] if keep_key else []
    return messages.select(*key, value.alias("_v")).select(*(["key"] if keep_key else []), "_v.*")


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic from its beginning. Needs the Spark Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    return reader.options(**options).load().select("key", "value")


def file_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Messages appended to a folder of Parquet files with ``key`` and ``value``."""
    reader = spark.readStream.schema("key string, value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def publish(df: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Send ``key`` / ``value`` rows to a topic, as a batch or as a stream."""
    if df.isStreaming:
        return (
            df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start()
        )
    return df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def replay_order(df: DataFrame, time: str = "pickup_datetime", *ids: str) -> DataFrame:
    """Rows in the order a replay sends them."""
    return df.orderBy(time, *ids)


def print_stream(df: DataFrame, checkpoint: str | None = None, mode: str = "append"):
    """Write a stream to the console."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", False)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def run_available(df: DataFrame, output: str, checkpoint: str) -> None:
    """Process what has arrived, append it to Parquet and stop."""
    query = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def latest_per_key(df: DataFrame, key: str, seq: str, columns: list[str]) -> DataFrame:
    """The values of the row with the highest ``seq`` for each key (batch or stream)."""
    last = F.max_by(F.struct(seq, *columns), F.col(seq)).alias("_last")
    return df.groupBy(key).agg(last).select(key, "_last.*")

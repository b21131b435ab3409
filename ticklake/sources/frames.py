"""Frame tables and streams.

A frame table is ``(frame_id long, recv_ts timestamp_ntz, frame binary)``;
price and order frames live in separate tables/streams (the feed tells them
apart only by the connection they arrive on).  Text messages are not
frames: rows with a null frame are skipped by the splitters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: A task sorts and writes a file (half a GB of order packets), and a micro-batch of the callback query reads two.
MIN_FILES, PRICE_PACKETS, ORDER_PACKETS = 4, 125_000, 500_000

FRAME_SCHEMA = T.StructType([
    T.StructField("frame_id", T.LongType()),
    T.StructField("recv_ts", T.TimestampNTZType()),
    T.StructField("frame", T.BinaryType()),
])

CONTROL_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("instrument_key", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("mode", T.StringType()),
])


def read_frames(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FRAME_SCHEMA).parquet(path)


def stream_frames(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Frames arriving as Parquet files in a folder (a Kafka source with the
    same columns plugs in the same way)."""
    r = spark.readStream.schema(FRAME_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def stream_control(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(CONTROL_SCHEMA).parquet(path)


def files_for(packets: int, per_file: int) -> int:
    """Number of files for so many packets: files keep their size and grow in number; 4 at least."""
    return max(MIN_FILES, -(-packets // per_file))


def write_frames(frames: DataFrame, path: str, files: int = 4) -> None:
    """Land frames as Parquet, each file a contiguous range of arrival order
    (so a file-by-file stream sees frames in order).  One task sorts and writes
    each file, and a reader takes it as a whole: see ``files_for``."""
    (frames.repartitionByRange(files, "recv_ts", "frame_id")
     .sortWithinPartitions("recv_ts", "frame_id")
     .write.mode("overwrite").parquet(path))


def stream_frames_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                        starting_offsets: str = "latest") -> DataFrame:
    """S4/S5 from Kafka: one record per frame.  ``frame_id`` packs
    (partition, offset) as ``partition * 2^35 + offset`` — unique, increasing
    within a partition, and inside the 2^56 bound of the packed arrival order
    (up to two million partitions of 34 billion offsets); ``recv_ts`` is the broker
    timestamp as wall-clock.  Needs
    the Spark Kafka connector on the classpath (not bundled here, so this
    path is not exercised by the tests)."""
    from pyspark.sql import functions as F
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .load())
    return raw.select(
        (F.col("partition").cast("long") * F.lit(2 ** 35) + F.col("offset")).alias("frame_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("recv_ts"),
        F.col("value").alias("frame"))

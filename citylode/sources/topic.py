"""Topic scan of station states."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from citylode.schemas import STATION_STATE
from citylode.sources.files import CORRUPT


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", messages_per_batch: int = 1_000_000,
) -> DataFrame:
    """Stream of JSON messages (value, position). Needs Spark's Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic).option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", messages_per_batch).load()
    )
    return raw.select(
        F.col("value").cast("string").alias("value"), F.col("offset").cast("double").alias("position"))


def read_message_files(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """The same stream from text files, one message per line; the position is the file's arrival."""
    arrived = F.unix_micros(F.col("_metadata.file_modification_time")).cast("double")
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path).select("value", arrived.alias("position"))


def decode(messages: DataFrame) -> DataFrame:
    """Message fields and position; a message that is no object of the expected types is in ``bad_message``.

    One parse per message: what does not fit is left in the corrupt-record field.
    """
    schema = StructType([*STATION_STATE.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.select("*", F.from_json("value", schema, options).alias("state_"))
    state, bad = F.col("state_"), F.col(f"state_.{CORRUPT}").isNotNull()
    empty = reduce(lambda a, b: a & b, [state[f.name].isNull() for f in STATION_STATE.fields])
    bad = state.isNull() | bad | (empty & ~F.trim("value").startswith("{"))
    return parsed.select(
        *[F.when(~bad, state[f.name]).alias(f.name) for f in STATION_STATE.fields], "position",
        F.when(bad, F.coalesce("value", F.lit(""))).alias("bad_message"))

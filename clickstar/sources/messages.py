"""JSON messages from a topic or from files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..schema import ALLOWED_COLLECTIONS, CANARY_MESSAGE, EVENT


# Fixed value: the type of a heartbeat message.
CANARY = "canary"


def kafka_options(
    bootstrap_servers: str,
    topic: str,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    sasl_jaas_config: str | None = None,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **more: str,
) -> dict[str, str]:
    """Options of a Kafka source; `more` takes minPartitions, maxOffsetsPerTrigger and so on."""
    given = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "kafka.security.protocol": security_protocol,
        "kafka.sasl.mechanism": sasl_mechanism,
        "kafka.sasl.jaas.config": sasl_jaas_config,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **more,
    }
    return {name: value for name, value in given.items() if value is not None}


def read_message_stream(
    spark: SparkSession,
    source_format: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Unbounded messages with a `value` column: kafka, or text files with a message a line."""
    return spark.readStream.format(source_format).options(**(options or {})).load(path)


def read_messages(
    spark: SparkSession,
    source_format: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """The same, bounded: for a backfill from files or from an offset range of a topic."""
    return spark.read.format(source_format).options(**(options or {})).load(path)


def parse_messages(messages: DataFrame, schema: T.StructType = EVENT) -> DataFrame:
    """Messages to event columns. What is not a JSON object gives a row of nulls."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("data.*")


def allowed_events(
    events: DataFrame, collections: Sequence[str] = ALLOWED_COLLECTIONS
) -> DataFrame:
    """Events of the types the warehouse takes in. Others, and canaries without one, go."""
    return events.where(F.col("collection").isin(list(collections)))


def accepted_events(
    events: DataFrame, collections: Sequence[str] = ALLOWED_COLLECTIONS
) -> DataFrame:
    """Allowed events that have an id, without which the fact has no key."""
    return allowed_events(events, collections).where(F.col("id").isNotNull())


def intake_counts(
    messages: DataFrame,
    collections: Sequence[str] = ALLOWED_COLLECTIONS,
    canaries_apart: bool = False,
) -> DataFrame:
    """Messages by what becomes of them, so that nothing is dropped unseen. Heartbeats are messages
    without a collection, unless they are counted apart."""
    value = F.col("value").cast("string")
    event = F.col("event")
    heartbeat = F.lit(canaries_apart) & (F.col("type") == CANARY)
    fate = (
        F.when(event["collection"].isNull() & F.col("json").isNull(), "malformed")
        .when(event["collection"].isNull() & heartbeat, "canary")
        .when(event["collection"].isNull(), "no_collection")
        .when(~event["collection"].isin(list(collections)), "not_allowed")
        .when(event["id"].isNull(), "no_id")
        .otherwise("accepted")
    )
    return (
        messages.select(
            F.from_json(value, EVENT).alias("event"),
            F.get_json_object(value, "$").alias("json"),
            F.get_json_object(value, "$.type").alias("type"),
        )
        .select(fate.alias("fate"))
        .groupBy("fate")
        .agg(F.count("*").alias("messages"))
    )


def canary_messages(messages: DataFrame) -> DataFrame:
    """The heartbeats among the messages of a topic."""
    sent = messages.select(
        F.from_json(
            F.col("value").cast("string"),
            "message_id string, message string, timestamp string, type string",
        ).alias("canary")
    ).select("canary.*")
    return sent.where(F.col("type") == CANARY).select(
        "message_id",
        "message",
        F.col("timestamp").try_cast(CANARY_MESSAGE["timestamp"].dataType).alias("timestamp"),
        "type",
    )


def relay(
    messages: DataFrame,
    sink_format: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
) -> DataStreamWriter:
    """Writer that passes messages on, each read as JSON and written anew.

    Every field is kept, known or not; what is no JSON is not passed on.
    """
    anew = messages.select(
        F.get_json_object(F.col("value").cast("string"), "$").alias("value")
    ).where(F.col("value").isNotNull())
    writer = (
        anew.writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    return writer.option("path", path) if path else writer

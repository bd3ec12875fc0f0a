"""Publishing the party view to a stream and reading it back as one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from entigrid.schema import STREAM_SCHEMA, VIEW_SCHEMA


def stream_records(view: DataFrame) -> DataFrame:
    """The eleven fields as published; the legal name goes by ``name``."""
    return view.select(
        *(F.col(v.name).alias(s.name) for v, s in zip(VIEW_SCHEMA, STREAM_SCHEMA))
    )


def publish(view: DataFrame, path: str) -> None:
    """Append every party to a file stream; each call publishes all of them again."""
    stream_records(view).write.mode("append").parquet(path)


def publish_kafka(view: DataFrame, servers: str, topic: str = "parties") -> None:
    """Append every party to a Kafka topic as JSON keyed by id (needs the Kafka package)."""
    records = stream_records(view)
    message = records.select(
        F.col("id").alias("key"), F.to_json(F.struct(*records.columns)).alias("value")
    )
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    message.write.format("kafka").options(**options).save()


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Published parties as a stream, from the beginning."""
    reader = spark.readStream.schema(STREAM_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str = "parties", offsets_per_trigger: int | None = None
) -> DataFrame:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = offsets_per_trigger
    scan = spark.readStream.format("kafka").options(**options).load()
    record = F.from_json(F.col("value").cast("string"), STREAM_SCHEMA)
    return scan.select(record.alias("r")).select("r.*")

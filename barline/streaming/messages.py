"""Decoding of the bar topic: wire header, payload, good rows and dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.timeunits import floor_div, market_date
from ..schemas import BAR_MESSAGE, STREAM_BRONZE
from . import avro

#: Magic byte and schema id that the serializer puts before each payload.
HEADER_BYTES = 5
KAFKA_OPTIONS = {"startingOffsets": "latest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "3000", "kafka.security.protocol": "SASL_SSL"}
STREAM_ONLY = ("startingOffsets", "maxOffsetsPerTrigger")


def kafka_stream(spark: SparkSession, topic: str, servers: str, **options: str) -> DataFrame:
    """The live topic. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**KAFKA_OPTIONS | {"kafka.bootstrap.servers": servers, "subscribe": topic} | options).load()


def kafka_batch(spark: SparkSession, topic: str, servers: str, start_ms: int, end_ms: int, **options: str) -> DataFrame:
    """A bounded read of [start_ms, end_ms) for a replay; gaps in the log are no error here."""
    kept = {k: v for k, v in (KAFKA_OPTIONS | options).items() if k not in STREAM_ONLY} | {"failOnDataLoss": "false"}
    bounds = {"startingTimestamp": str(start_ms), "endingTimestamp": str(end_ms)}
    return spark.read.format("kafka").options(**kept | {"kafka.bootstrap.servers": servers, "subscribe": topic} | bounds).load()


def has_avro(spark: SparkSession) -> bool:
    """Whether Spark's Avro package is on the class path."""
    loader = spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
    return loader.getResource("org/apache/spark/sql/avro/AvroDataToCatalyst.class") is not None


def payload(value, header: int = HEADER_BYTES):
    """A message's bytes behind the wire header."""
    return F.expr(f"substring({value}, {header + 1}, greatest(length({value}) - {header}, 0))")


def decoded(messages: DataFrame, avro_schema: str | None = None, shape: T.StructType = BAR_MESSAGE, header: int = HEADER_BYTES) -> DataFrame:
    """Adds ``data``, null where the payload cannot be read. With avro_schema payloads are Avro, by Spark's
    functions where their package is on the class path and by our own decoder where it is not; without,
    payloads are JSON."""
    body = payload("value", header)
    if avro_schema is not None:
        if not has_avro(messages.sparkSession):
            return messages.withColumn("data", avro.from_avro(body, avro_schema))
        from pyspark.sql.avro.functions import from_avro

        return messages.withColumn("data", from_avro(body, avro_schema, {"mode": "PERMISSIVE"}))
    parsed = F.from_json(body.cast("string"), T.StructType([*shape, T.StructField("__bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    readable = parsed["__bad"].isNull() & parsed["symbol"].isNotNull()
    return messages.withColumn("data", F.when(readable, F.struct(*[parsed[f.name].alias(f.name) for f in shape])))


def split_messages(messages: DataFrame, correlation_id: str, **how) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters) of one decoded source; ingestion time goes from milliseconds to seconds."""
    told = decoded(messages, **how)
    kafka = [F.col(c).alias(n) for c, n in (("timestamp", "kafka_ingestion_timestamp"), ("topic", "topic"), ("partition", "partition"), ("offset", "offset"))]
    rows = told.where("data IS NOT NULL")
    fields = [F.col(f"data.{f.name}").alias(f.name) for f in BAR_MESSAGE if f.name != "ingestion_timestamp"]
    good = rows.select(*fields, floor_div(F.col("data.ingestion_timestamp"), 1000).alias("ingestion_timestamp"), *kafka)
    dead = told.where("data IS NULL").select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("binary").alias("raw_value"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("quarantine_timestamp"),
        F.lit(correlation_id).alias("correlation_id"),
        F.lit("undecodable").alias("quarantine_reason"),
    )
    return with_bronze_columns(good, correlation_id), dead


def with_bronze_columns(rows: DataFrame, correlation_id: str, source: str = "stream") -> DataFrame:
    """Lineage, unit and the exchange's date, in the shape of the streamed table."""
    out = rows.withColumns(
        {
            "processing_timestamp": F.current_timestamp(),
            "correlation_id": F.lit(correlation_id),
            "source": F.lit(source),
            "ts_unit": F.lit("ms"),
        }
    )
    return out.withColumn("date", market_date(F.col("start_timestamp"), F.col("ts_unit"))).select(*STREAM_BRONZE.names)


def replay(messages: DataFrame, start_ms: int, end_ms: int, correlation_id: str, **how) -> DataFrame:
    """Good rows of messages in [start_ms, end_ms) by their time in the log, for a backfill from files."""
    inside = messages.where((F.unix_millis("timestamp") >= start_ms) & (F.unix_millis("timestamp") < end_ms))
    return split_messages(inside, correlation_id, **how)[0]


KAFKA_SINK = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "snappy", "kafka.linger.ms": "100"}


def as_messages(rows: DataFrame, schema_id: int = 0, avro_schema: str | None = None) -> DataFrame:
    """Bars as (key, value): keyed by symbol, JSON or Avro behind the wire header of a zero byte and a schema id."""
    header = F.lit(b"\0" + schema_id.to_bytes(4, "big"))
    record = F.struct(*[F.col(f.name) for f in BAR_MESSAGE if f.name in rows.columns])
    body = F.to_json(record).cast("binary") if avro_schema is None else avro.to_avro(record, avro_schema)
    return rows.select(F.col("symbol").cast("binary").alias("key"), F.concat(header, body).alias("value"))


def send(rows: DataFrame, topic: str, servers: str, **options: str) -> None:
    """Writes bars to a topic. Needs the Kafka connector on the class path."""
    as_messages(rows).write.format("kafka").options(**KAFKA_SINK | {"kafka.bootstrap.servers": servers, "topic": topic} | options).save()

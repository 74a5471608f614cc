"""Log sources: a Kafka topic or a folder of JSON lines, and their parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tonearm.functions.unroll import once
from tonearm.schemas import LOG_SCHEMA, RAW_LOG_SCHEMA, strings


def kafka_options(
    servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of the topic; `more` overrides any of them. Offsets that are gone stop the
    stream, as Spark has it, unless the caller says otherwise."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return {**opts, **more}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Record values as text. Needs Spark's Kafka package on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return raw.select(F.col("value").cast("string").alias("value")).where("value is not null")


def line_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same record texts from a folder that files arrive in."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_log(lines: DataFrame) -> DataFrame:
    """Record texts to log records, with the text itself as `value`; a text that does not
    parse gives nulls.

    Each text is parsed once; as a plain projection the parse would be pulled into
    every later filter and done once per field.
    """
    parsed = once(lines, {"r": f"from_json(value, '{LOG_SCHEMA.simpleString()}')", "value": "value"})
    return parsed.select("r.*", "value")


def parse_records(lines: DataFrame, record: str, fields: list[str]) -> DataFrame:
    """The records of one type, parsed to the asked fields of `common` only. Texts of other
    types are told by their type alone and never parsed."""
    schema = StructType([
        StructField("common", strings(fields)), StructField("channel", StringType()),
        StructField("type", StringType()), StructField("ts", LongType()),
    ])
    mine = lines.where(F.get_json_object("value", "$.type") == record)
    parsed = once(mine, {"r": f"from_json(value, '{schema.simpleString()}')", "value": "value"})
    return parsed.select("r.*", "value")


def parse_raw_log(lines: DataFrame) -> DataFrame:
    """The generic raw layer, `common` as a map; bad JSON is skipped."""
    parsed = once(lines, {"r": f"from_json(value, '{RAW_LOG_SCHEMA.simpleString()}')"})
    return parsed.select("r.*").where("type is not null")


def typed_log(records: DataFrame) -> DataFrame:
    return records.where(F.col("type").isNotNull())

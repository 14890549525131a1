"""JSON message sources with quarantine of bad rows.

The transport is a parameter: ``kafka`` in deployment (needs the Kafka
connector on the classpath), a JSON/text file folder in tests. Decoding is
shared and is what the tests cover.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def kafka_options(topic: str, bootstrap_servers: str, group_id: str | None = None,
                  startup_mode: str = "latest-offset") -> dict[str, str]:
    """Kafka source options from the reference's connector settings.

    Both the current (``scan.startup.mode``) and the legacy
    (``connector.startup-mode``) spellings map to ``startingOffsets``.
    """
    starting = STARTUP_MODES.get(startup_mode, startup_mode)
    opts = {"subscribe": topic, "kafka.bootstrap.servers": bootstrap_servers,
            "startingOffsets": starting}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


# Connector option names of the two spellings the reference's
# jobs use (current, then legacy), mapped to Spark Kafka reader options.
CONNECTOR_OPTIONS = {
    "topic": "subscribe",
    "connector.topic": "subscribe",
    "properties.bootstrap.servers": "kafka.bootstrap.servers",
    "connector.properties.bootstrap.servers": "kafka.bootstrap.servers",
    "properties.group.id": "kafka.group.id",
    "connector.properties.group.id": "kafka.group.id",
    "scan.startup.mode": "startingOffsets",
    "connector.startup-mode": "startingOffsets",
}
STARTUP_MODES = {"latest-offset": "latest", "earliest-offset": "earliest"}


def kafka_options_from_connector(props: dict[str, str]) -> dict[str, str]:
    """Spark Kafka options from a connector option map (either spelling).

    Options without a Spark counterpart (format, version, sink-side
    settings) are left out.
    """
    out = {}
    for k, v in props.items():
        target = CONNECTOR_OPTIONS.get(k)
        if target == "startingOffsets":
            v = STARTUP_MODES.get(v, v)
        if target:
            out[target] = v
    return out


def decode_json(raw: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode a string/binary column of JSON objects into typed columns.

    PERMISSIVE parsing: a malformed message or one whose fields do not fit
    the schema keeps its text in ``_corrupt_record`` instead of failing the
    job. Extra columns in ``keep`` (e.g. Kafka partition/offset) pass through.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col).cast("string"), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = raw.select(*keep, parsed.alias("_m"), F.col(value_col).cast("string").alias("_raw"))
    cols = [F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields]
    # from_json yields an all-null struct (not a corrupt record) for some truncated
    # inputs; a message whose fields are all NULL is bad only if it isn't a JSON object.
    all_null = F.lit(True)
    for f in schema.fields:
        all_null = all_null & F.col(f"_m.{f.name}").isNull()
    bad = F.when(F.col(f"_m.{CORRUPT}").isNotNull(), F.col(f"_m.{CORRUPT}")) \
        .when(all_null & F.json_object_keys("_raw").isNull(), F.col("_raw"))
    return out.select(*keep, *cols, bad.alias(CORRUPT))


#: Columns that say where a message stands in the arrival order.
ARRIVAL = ("partition", "offset")


def read_segments(spark: SparkSession, path: str, start: str = "earliest", since: str | None = None, streaming: bool = True,
                  options: dict[str, str] | None = None) -> DataFrame:
    """Messages kept as parquet files of one column ``value`` (the segments of a log), in arrival order.

    ``partition`` is the name of a message's file and ``offset`` its row there, both from
    the file source's metadata. ``start="latest"`` takes only files written after ``since`` (a timestamp;
    default: now), ``"earliest"`` all of them."""
    if start not in ("earliest", "latest"):
        raise ValueError(f"start is earliest or latest, not {start!r}")
    reader = (spark.readStream if streaming else spark.read).schema("value string")
    raw = reader.options(**(options or {})).parquet(path)
    if start == "latest":
        when = F.lit(since).cast("timestamp") if since else F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
        raw = raw.where(F.col("_metadata.file_modification_time") > when)
    return raw.select("value", F.col("_metadata.file_name").alias("partition"), F.col("_metadata.row_index").alias("offset"))


def read_json_stream(spark: SparkSession, schema: T.StructType, transport: str = "kafka",
                     path: str | None = None, options: dict[str, str] | None = None,
                     streaming: bool = True) -> DataFrame:
    """Read JSON messages into ``schema`` columns plus ``_corrupt_record``.

    ``transport="kafka"`` reads the ``value`` of each record (``options`` from
    :func:`kafka_options`); ``"segments"`` reads parquet files of messages
    (:func:`read_segments`; ``startingOffsets`` in ``options`` is its ``start``). Both keep
    ``partition`` and ``offset``, the arrival order. ``"text"`` reads one JSON object per line from files.
    """
    options = dict(options or {})
    if transport == "segments":
        start = STARTUP_MODES.get(options.get("startingOffsets"), options.get("startingOffsets", "earliest"))
        known = {k: v for k, v in options.items() if k not in set(CONNECTOR_OPTIONS.values())}
        return decode_json(read_segments(spark, path, start, streaming=streaming, options=known), schema, "value", keep=ARRIVAL)
    reader = spark.readStream if streaming else spark.read
    if transport == "kafka":
        return decode_json(reader.format("kafka").options(**options).load(), schema, "value", keep=ARRIVAL)
    return decode_json(reader.format("text").options(**options).load(path), schema, "value")


def with_event_time(df: DataFrame, src: str, dst: str = "ts", fmt: str = EVENT_TIME_FORMAT) -> DataFrame:
    """Parse a text event time; unparsable text gives NULL, never an error."""
    return df.withColumn(dst, F.try_to_timestamp(F.col(src), F.lit(fmt)))


def split_quarantine(df: DataFrame, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows failed to decode or lack a required field.

    Both halves are plain filters over the same input, so a streaming
    caller writes them as two sinks (or one ``foreachBatch``).
    """
    ok = F.col(CORRUPT).isNull()
    for c in required:
        ok = ok & F.col(c).isNotNull()
    good = df.where(ok).drop(CORRUPT)
    bad = df.where(~ok)
    return good, bad

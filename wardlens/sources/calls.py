"""Emergency-call topics and files, and decoding of their JSON values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlens.sources.schemas import CALL

CORRUPT = "_corrupt"


def read_calls_stream(spark: SparkSession, fmt: str = "text", starting: str = "latest",
                      **options: str) -> DataFrame:
    """Streaming frame with the call JSON in ``value``.

    ``fmt="kafka"`` needs the Kafka package on the class path and the usual options
    (``kafka.bootstrap.servers``, ``subscribe``); offsets live in the query's checkpoint, and
    ``starting`` only applies to its first run. Any other format is a directory of files with one
    document per line, given as ``path``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", starting)
    return reader.load()


def _instant(text: Column, zone: str, session_zone: str) -> Column:
    """ISO-8601 text as a timestamp; text without an offset is local time in ``zone``."""
    if zone == session_zone:
        return text.try_cast("timestamp")
    local = F.convert_timezone(F.lit(zone), F.lit(session_zone), text.try_cast("timestamp_ntz"))
    return (F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), text.try_cast("timestamp"))
            .otherwise(local.cast("timestamp")))


def decode_text(df: DataFrame, schema: T.StructType = CALL, column: str = "value",
                required: tuple[str, ...] = ()) -> DataFrame:
    """Replace JSON text (or bytes) by its fields; undecodable text is kept in ``_corrupt``.

    Null and blank documents, and those without a ``required`` field, count as undecodable; a null
    one is kept as empty text. Other columns get the prefix ``record_``. The fields come out of a
    generator, so that a filter on one of them does not make the optimizer decode the text twice.
    """
    target = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(column).cast("string")
    decoded = F.from_json(text, target, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    kept = [F.col(name).alias(f"record_{name}") for name in df.columns if name != column]
    rows = df.select(*kept, F.inline(F.array(F.struct(decoded.alias("_decoded"), text.alias("_text")))))
    unfit = F.col("_text").isNull() | (F.trim("_text") == "")
    for name in required:
        unfit |= F.col(f"_decoded.{name}").isNull()
    corrupt = F.coalesce(F.col(f"_decoded.{CORRUPT}"), F.when(unfit, F.coalesce("_text", F.lit(""))))
    return rows.select(*(name for name in rows.columns if name not in ("_decoded", "_text")),
                       *(F.col(f"_decoded.{field.name}") for field in schema.fields), corrupt.alias(CORRUPT))


def parse_calls(df: DataFrame, event_time: str = "payload", zone: str = "UTC") -> DataFrame:
    """Flat call columns plus ``ts`` and ``_corrupt`` from JSON in ``value``.

    Documents without a ``call_id`` are set aside in ``_corrupt`` like undecodable ones.
    ``event_time="record"`` takes the topic's record time instead of the document's timestamp.
    """
    decoded = decode_text(df, required=("call_id",))
    ts = (F.col("record_timestamp").cast("timestamp") if event_time == "record"
          else _instant(F.col("timestamp"), zone,
                        df.sparkSession.conf.get("spark.sql.session.timeZone")))
    return decoded.select(
        "call_id", "timestamp", ts.alias("ts"), "call_type", "incident_type", "priority",
        "location.address", "location.area_name", "location.latitude", "location.longitude",
        "caller_info.phone_number", "caller_info.is_anonymous",
        "dispatch_info.units_dispatched", "dispatch_info.response_time_minutes",
        "dispatch_info.is_dispatched", "status", CORRUPT,
    )

"""Incidents and calls derived from the given tables.

Every row of ``lineitem`` becomes an incident and every row of ``events`` a call. The expressions
below run in Spark and in DuckDB, so both engines start from the same rows. Areas and dates are
shifted for some orders (never filtered), so that all trends and risk levels occur.
"""

from __future__ import annotations

import hashlib
import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.functions.rules import RAW_DATE_FORMAT, RAW_TO_CLEAN
from wardlens.operators.incidents import with_case_columns
from wardlens.plans.batch import build_metrics
from wardlens.session import scratch_dir
from wardlens.sinks import write_gold, write_metrics, write_silver
from wardlens.sources import Lake, load_area_stats, read_metrics, read_silver
from wardlens.sources.lake import RAW_TEXT

# Orders with the area and date of their incidents, step by step.
AREA = "CASE WHEN c_nationkey % 3 <> 0 AND o_orderkey % 5 = 0 THEN c_nationkey - c_nationkey % 3 ELSE c_nationkey END"
BASE_DATE = "CAST(o_orderdate AS DATE) - CASE WHEN year(o_orderdate) >= 2001 THEN 2192 ELSE 0 END"
DATE = """base_date + CASE WHEN area_key % 3 = 0 AND year(base_date) = 1999 AND o_orderkey % 4 = 1 THEN 365
 WHEN area_key % 3 = 1 AND year(base_date) = 2000 AND o_orderkey % 4 = 1 THEN -366 ELSE 0 END"""

DESCRIPTIONS = [
    "CRIMINAL HOMICIDE", "RAPE, FORCIBLE", "ROBBERY", "BATTERY - SIMPLE ASSAULT",
    "ASSAULT WITH DEADLY WEAPON", "KIDNAPPING", "BURGLARY", "THEFT PLAIN", "VEHICLE THEFT",
    "VEHICLE - STOLEN", "VANDALISM - FELONY", "ARSON", "DRUGS, TO A MINOR", "EMBEZZLEMENT",
    "FORGERY / COUNTERFEIT", "INTIMATE PARTNER - THREATS", "DISTURBING THE PEACE", "DRUNK ROLL",
    "SHOTS FIRED AT DWELLING", None,
]
PREMISES = ["SINGLE FAMILY DWELLING HOUSE", "STREET", "PARKING LOT", "APARTMENT", None]
WEAPONS = ["HAND GUN", "KITCHEN KNIFE", "CLUB/BAT", "STRONG-ARM (HANDS, FIST)", "VEHICLE", "FIRE",
           "CHEMICAL SPRAY", "VERBAL THREAT", None, None, "STUN GUN"]
SEXES = ["M", "F", "X", "H", " m ", "female", None]
DESCENTS = ["H", "W", "B", "A", "-", None]


def _pick(key: str, values: list[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} % {len(values)} {cases} END"


INCIDENT = {
    "id": "l_orderkey*8 + l_linenumber",
    "date_reported": "occurred + CAST((l_orderkey*7 + l_linenumber*13) % 47 - 2 AS INT)",
    "date_occured": "occurred",
    "time_occured": "CAST(((l_orderkey*37) % 25)*100 + l_partkey % 60 AS INT)",
    "area_id": "CAST(n_nationkey + 1 AS INT)",
    "area_name": "replace(n_name, 'NATION', 'Area')",
    "reporting_district_id": "CAST(n_nationkey*100 + l_suppkey % 100 AS INT)",
    "part_1_2": "CAST(1 + l_linenumber % 2 AS INT)",
    "crime_code": "CAST(100 + l_partkey % 20 AS INT)",
    "crime_description": _pick("l_partkey", DESCRIPTIONS),
    "mocodes": "CAST(l_suppkey % 1000 AS STRING)",
    "victim_age": "CAST(l_quantity*3 - 5 AS INT)",
    "victim_sex": _pick("l_suppkey", SEXES),
    "victim_descent": _pick("l_partkey", DESCENTS),
    "premise_code": "CAST(l_suppkey % 5 AS INT)",
    "premise_description": _pick("l_suppkey", PREMISES),
    "weapon_code": "CAST(l_partkey % 11 AS INT)",
    "weapon_description": _pick("l_partkey", WEAPONS),
    "status": """CASE WHEN (l_orderkey*31 + l_linenumber) % 100 < 30 + 3*n_nationkey THEN 'AA'
 WHEN l_partkey % 13 = 0 THEN 'CC' ELSE 'IC' END""",
    "status_description": "CAST(NULL AS STRING)",
    "crime_code_1": "CAST(100 + l_partkey % 20 AS INT)",
    "crime_code_2": "CAST(NULL AS INT)",
    "crime_code_3": "CAST(NULL AS INT)",
    "crime_code_4": "CAST(NULL AS INT)",
    "street_address": """CASE WHEN l_suppkey % 9 = 0 THEN NULL
 WHEN l_suppkey % 9 = 1 THEN CAST(l_partkey AS STRING) || ' oak st'
 WHEN l_suppkey % 9 = 2 THEN CAST(l_partkey AS STRING) || ' Melrose  AVE'
 ELSE '  ' || CAST(l_partkey AS STRING) || '   Main  ST ' END""",
    "cross_street": "CAST(NULL AS STRING)",
    "lat": """CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE)
 ELSE CAST(33.65 AS DOUBLE) + CAST((l_orderkey*17) % 800 AS DOUBLE)/CAST(1000 AS DOUBLE) END""",
    "lon": """CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE)
 ELSE CAST(-118.95 AS DOUBLE) + CAST((l_orderkey*29) % 1400 AS DOUBLE)/CAST(1000 AS DOUBLE) END""",
}

# One month of events, packed into 12 hours, so that 5-minute windows hold several calls. Response
# times are multiples of 1/32, so that their sums are exact in any order.
_DISPATCHED = "(event_type <> 'error' AND event_type <> 'view')"
_UNIT_COUNT = f"CASE WHEN {_DISPATCHED} THEN CAST(event_id % 5 AS INT) ELSE 0 END"
CALL = {
    "call_id": "CAST(event_id AS STRING)",
    "call_type": _pick("event_id", ["EMERGENCY", "NON_EMERGENCY", "TRANSFER"]),
    "incident_type": _pick("event_id", ["ASSAULT", "robbery", "FIRE", "WEAPON VIOLATION", "THEFT",
                                        "FRAUD", None]),
    "priority": "CAST(1 + event_id % 5 AS INT)",
    "address": "CAST(100 + user_id % 9000 AS STRING) || ' MAIN ST'",
    "area_name": """CASE WHEN (user_id % 21) % 2 = 0 THEN 'Area_' ELSE 'AREA_' END
 || CAST(user_id % 21 AS STRING)""",
    "latitude": "CAST(33.7 AS DOUBLE) + CAST(event_id % 600 AS DOUBLE)/CAST(1000 AS DOUBLE)",
    "longitude": "CAST(-118.6 AS DOUBLE) + CAST(user_id % 500 AS DOUBLE)/CAST(1000 AS DOUBLE)",
    "phone_number": "'XXX-XXX-' || CAST(1000 + event_id % 9000 AS STRING)",
    "is_anonymous": "event_id % 4 = 0",
    "response_time_minutes": f"CASE WHEN {_DISPATCHED} THEN 2 + floor(value*3.2)/32 END",
    "is_dispatched": _DISPATCHED,
    "status": _pick("event_id", ["RECEIVED", "PROCESSING", "DISPATCHED", "CLOSED"]),
}
SPARK_CALL = {
    "ts": """timestamp_micros(1704067200000000
 + (unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) DIV 60)""",
    "units_dispatched": f"slice(array('LAPD-1','LAFD-2','EMS-3','XYZ-9'), 1, {_UNIT_COUNT})",
}
DUCKDB_CALL = {
    "ts": "make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000)//60)",
    "units_dispatched": f"list_slice(['LAPD-1','LAFD-2','EMS-3','XYZ-9'], 1, {_UNIT_COUNT})",
}


def _select(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in expressions.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incident_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents in clean types. Orders meet customers first: lineitem is shuffled only once."""
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .select("o_orderkey", F.expr(AREA).alias("area_key"), F.expr(BASE_DATE).alias("base_date"))
        .join(table(spark, sf_dir, "nation"), F.expr("area_key = n_nationkey"))
        .select("o_orderkey", "n_nationkey", "n_name", F.expr(DATE).alias("occurred"))
    )
    lines = table(spark, sf_dir, "lineitem")
    return _select(lines.join(orders, F.expr("l_orderkey = o_orderkey")), INCIDENT)


#: Headers of raw files that differ: some columns only, in an order of their own.
RAW_LAYOUTS = [
    ["DR_NO", "AREA ", "AREA NAME", "DATE OCC", "Status"],
    ["Status", "DATE OCC", "DR_NO", "LAT", "LON"],
    ["AREA NAME", "DR_NO", "Vict Age"],
]


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents as the raw file has them: its 28 headers and dates as text."""
    rows = incident_rows(spark, sf_dir).withColumns({
        name: F.date_format(name, RAW_DATE_FORMAT) for name in ("date_reported", "date_occured")})
    return rows.select(*[F.col(clean).alias(raw) for raw, clean in RAW_TO_CLEAN.items()])


def write_raw(rows: DataFrame, folder: str) -> None:
    """Add ``rows`` to a folder of compressed CSV files with headers, texts as they are."""
    (rows.write.mode("append").options(**RAW_TEXT).option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(folder))


def calls_of(events: DataFrame) -> DataFrame:
    """Calls from a batch or streaming frame of events."""
    rows = _select(events, CALL | SPARK_CALL)
    return rows.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


#: Faults put into call documents, by the event's id.
FAULTS = {
    "bad_priority": "event_id % 11 = 3",
    "quoted_priority": "event_id % 17 = 5",
    "unknown_type": "event_id % 13 = 4",
    "no_area_point": "event_id % 23 = 6",
    "cut_off": "event_id % 19 = 7",
}


def faulty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value): every call as a JSON document, some of them with faults."""
    from wardlens.operators.calls import encode_json, nest_calls

    calls = calls_of(table(spark, sf_dir, "events")).drop("ts").withColumn("event_id", F.col("call_id").cast("long"))
    is_ = {name: F.expr(text) for name, text in FAULTS.items()}
    calls = calls.withColumns({
        "priority": F.when(is_["bad_priority"], F.lit(9)).otherwise(F.col("priority")),
        "call_type": F.when(is_["unknown_type"], F.lit("PRANK")).otherwise(F.col("call_type")),
        "latitude": F.when(~is_["no_area_point"], F.col("latitude")),
    })
    nested = nest_calls(calls)
    text = F.to_json(F.struct(*[c for c in nested.columns if c != "event_id"]))
    text = F.when(is_["quoted_priority"], F.regexp_replace(text, r'"priority":([0-9]+)', r'"priority":"$1"')).otherwise(text)
    return nested.select("event_id", F.when(is_["cut_off"], F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text).alias("value"))


def out_of_order(calls: DataFrame) -> DataFrame:
    """Calls whose ``ts`` is three hours ahead in one area and two hours behind for some ids."""
    user = F.substring_index("area_name", "_", -1)
    ahead = F.when(user == "4", F.expr("INTERVAL '3' HOUR")).otherwise(F.expr("INTERVAL '0' HOUR"))
    behind = F.when(F.col("call_id").cast("long") % 17 == 0, F.expr("INTERVAL '2' HOUR")).otherwise(F.expr("INTERVAL '0' HOUR"))
    return calls.withColumn("ts", F.col("ts") + ahead - behind)


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_of(table(spark, sf_dir, "events"))


# ---- the events in order of time, as files for streams ---------------------------------------

PARTS, FILES_PER_PART = 4, 2
#: Part of an event's time slice; both engines divide whole microseconds.
PART = f"(micros - low) * {PARTS} {{div}} (high - low + 1)"
#: Clocks of one area run ahead and some calls report late, so that calls come out of order.
AHEAD = "user_id % 21 = 4"
BEHIND = "event_id % 17 = 0"


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream of all events: time slice by time slice, one per micro-batch; files are written once."""
    lake = lake_of(spark, sf_dir)
    folder = f"{lake.root}/events"
    events = table(spark, sf_dir, "events")

    def write() -> None:
        micros = F.expr("unix_micros(CAST(ts AS TIMESTAMP))")
        low, high = events.agg(F.min(micros), F.max(micros)).first()
        part = F.expr(PART.format(div="DIV").replace("micros", "unix_micros(CAST(ts AS TIMESTAMP))")
                      .replace("low", f"{low}L").replace("high", f"{high}L"))
        for k in range(PARTS):  # files are streamed in order of their time of writing
            events.filter(part == k).repartition(FILES_PER_PART).write.mode("append").parquet(folder)

    _once(lake, "events", write)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_PER_PART).parquet(folder)


# ---- zones derived from the tables, built once per application and table folder -----------

_built: set[tuple[str, str]] = set()
_building = threading.RLock()


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    return Lake(f"{scratch_dir(spark)}/lake-{digest}")


def _once(lake: Lake, step: str, build: Callable[[], None]) -> None:
    with _building:
        if (lake.root, step) not in _built:
            build()
            _built.add((lake.root, step))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = lake_of(spark, sf_dir)
    _once(lake, "silver", lambda: write_silver(with_case_columns(incident_rows(spark, sf_dir)), lake, rebalance=False))
    return read_silver(spark, lake)


def metrics(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    silver(spark, sf_dir)
    lake = lake_of(spark, sf_dir)
    _once(lake, "metrics", lambda: build_metrics(spark, lake, enriched=False))
    return read_metrics(spark, lake, name)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live-call lookup from the published gold tables."""
    lake = lake_of(spark, sf_dir)
    tables = {name: metrics(spark, sf_dir, name) for name in ("area_summary", "yoy_stats")}

    def publish() -> None:
        write_gold(tables["area_summary"], lake, "gold_bm_area_summary")
        write_gold(tables["yoy_stats"], lake, "gold_bm_yoy_crime_trends")
        write_metrics(load_area_stats(spark, lake), lake, "area_stats")

    _once(lake, "gold", publish)
    return read_metrics(spark, lake, "area_stats")

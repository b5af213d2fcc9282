"""Declared schemas: no source infers its types, which would cost a pass over the data."""

from pyspark.sql import types as T

from wardlens.functions.rules import RAW_TO_CLEAN

_RAW_TYPES = {
    "DR_NO": T.LongType(),
    "TIME OCC": T.IntegerType(),
    "AREA ": T.IntegerType(),
    "Rpt Dist No": T.IntegerType(),
    "Part 1-2": T.IntegerType(),
    "Crm Cd": T.IntegerType(),
    "Vict Age": T.IntegerType(),
    "Premis Cd": T.IntegerType(),
    "Weapon Used Cd": T.IntegerType(),
    "Crm Cd 1": T.IntegerType(),
    "Crm Cd 2": T.IntegerType(),
    "Crm Cd 3": T.IntegerType(),
    "Crm Cd 4": T.IntegerType(),
    "LAT": T.DoubleType(),
    "LON": T.DoubleType(),
}

RAW_INCIDENT = T.StructType([
    T.StructField(name, _RAW_TYPES.get(name, T.StringType())) for name in RAW_TO_CLEAN
])

CALL = T.StructType([
    T.StructField("call_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("call_type", T.StringType()),
    T.StructField("incident_type", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("location", T.StructType([
        T.StructField("address", T.StringType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ])),
    T.StructField("caller_info", T.StructType([
        T.StructField("phone_number", T.StringType()),
        T.StructField("is_anonymous", T.BooleanType()),
    ])),
    T.StructField("dispatch_info", T.StructType([
        T.StructField("units_dispatched", T.ArrayType(T.StringType())),
        T.StructField("response_time_minutes", T.DoubleType()),
        T.StructField("is_dispatched", T.BooleanType()),
    ])),
    T.StructField("status", T.StringType()),
])

# What a call document must hold, as a schema document.
CALL_DOCUMENT = {
    "type": "object",
    "properties": {
        "call_id": {"type": "string"},
        "timestamp": {"type": "string", "format": "date-time"},
        "call_type": {"type": "string", "enum": ["EMERGENCY", "NON_EMERGENCY", "TRANSFER"]},
        "incident_type": {"type": "string"},
        "priority": {"type": "integer", "minimum": 1, "maximum": 5},
        "location": {
            "type": "object",
            "properties": {
                "address": {"type": "string"},
                "area_name": {"type": "string"},
                "latitude": {"type": "number"},
                "longitude": {"type": "number"},
            },
            "required": ["latitude", "longitude"],
        },
        "caller_info": {
            "type": "object",
            "properties": {"phone_number": {"type": "string"}, "is_anonymous": {"type": "boolean"}},
        },
        "dispatch_info": {
            "type": "object",
            "properties": {
                "units_dispatched": {"type": "array", "items": {"type": "string"}},
                "response_time_minutes": {"type": "number"},
                "is_dispatched": {"type": "boolean"},
            },
        },
        "status": {"type": "string", "enum": ["RECEIVED", "PROCESSING", "DISPATCHED", "CLOSED"]},
    },
    "required": ["call_id", "timestamp", "call_type", "incident_type", "priority", "location", "status"],
}

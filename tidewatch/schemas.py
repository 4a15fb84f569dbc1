"""Declared schemas of the raw inputs; nothing is inferred at read time."""

from pyspark.sql import types as T

from tidewatch import fixed

PORTS = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in fixed.PORT_DOUBLE_COLUMNS else T.StringType())
        for c in fixed.PORT_COLUMNS
    ]
)

VESSELS = T.StructType([T.StructField(c, T.StringType()) for c in fixed.VESSEL_COLUMNS])

EVENT_ROW = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in fixed.EVENT_DOUBLE_COLUMNS else T.StringType())
        for c in fixed.EVENT_COLUMNS
    ]
)

EVENT_CDC_ROW = T.StructType(EVENT_ROW.fields + [T.StructField("__deleted", T.StringType())])

_PROPERTIES = T.StructType([f for f in EVENT_ROW.fields if f.name not in ("unid", "action")])

EVENT_MESSAGE = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField(
            "data",
            T.StructType([T.StructField("id", T.StringType()), T.StructField("properties", _PROPERTIES)]),
        ),
    ]
)

FEATURE_COLLECTION = T.StructType(
    [
        T.StructField(
            "features",
            T.ArrayType(
                T.StructType([T.StructField("id", T.StringType()), T.StructField("properties", _PROPERTIES)])
            ),
        )
    ]
)

CDC_ENVELOPE = T.StructType(
    [
        T.StructField("before", EVENT_ROW),
        T.StructField("after", EVENT_ROW),
        T.StructField("op", T.StringType()),
    ]
)

ALIASES = T.StructType(
    [T.StructField("RAW_NAME", T.StringType()), T.StructField("MAPPED_NAME", T.StringType())]
)

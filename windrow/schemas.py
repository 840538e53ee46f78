"""Data model of notices, labels and runway entries.

Entries are kept as raw JSON strings: number lexemes, key order and missing-versus-null all show in what is
rendered from them, and a typed struct would lose them. Typed values are derived where they are needed.
"""

from __future__ import annotations

from pyspark.sql import types as T

NOTICE_FIELDS = ("notam_id", "icao_location", "notam_text", "effective_start", "effective_end")
NOTICE = T.StructType([T.StructField(f, T.StringType()) for f in NOTICE_FIELDS])
LABELED = T.StructType([*NOTICE.fields, T.StructField("runway_entries", T.ArrayType(T.StringType())), T.StructField("min_confidence", T.DoubleType())])
PAGE = T.StructType([T.StructField("data", T.ArrayType(NOTICE)), T.StructField("pagination", T.StructType([T.StructField("total", T.LongType())]))])
PATCH = T.StructType([T.StructField("notam_id", T.StringType()), T.StructField("entry_idx", T.IntegerType()), T.StructField("op", T.StringType()), T.StructField("field", T.StringType()), T.StructField("value", T.StringType())])

# The entry's fields in their order, with the kind of value each takes.
ENTRY_FIELDS = {
    "runway": "string",
    "runwayClosed": "bool",
    "takeoffShortening": "number",
    "takeoffShorteningUnits": "string",
    "landingShortening": "number",
    "landingShorteningUnits": "string",
    "TORA": "number",
    "TORAUnits": "string",
    "TODA": "number",
    "TODAUnits": "string",
    "LDA": "number",
    "LDAUnits": "string",
    "obstacleHeight": "number",
    "obstacleHeightUnits": "string",
    "obstacleHeightMSL": "number",
    "obstacleHeightMSLUnits": "string",
    "obstacleDistance": "number",
    "obstacleDistanceUnits": "string",
    "obstacleBearing": "number",
    "obstacleCoordinates": "string",
    "obstacleReferencePoint": "string",
    "contaminations": "list",
    "requiredClimbGradient": "number",
    "requiredClimbGradientUnits": "string",
    "confidence": "number",
    "notes": "string",
}

# The types and depth units that a contamination may have.
CONTAMINATION_TYPES = ("water", "slush", "wetSnow", "drySnow", "ice", "compactedSnow", "sand", "mud", "rubber", "oil", "fuel", "gravel", "vegetation")
DEPTH_UNITS = ("in", "mm", "cm")

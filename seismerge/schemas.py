"""Fixed schemas of the three layers (bronze raw, silver canonical, gold fact)."""

from pyspark.sql import types as T

# The four agencies, highest preference first.
SOURCE_PRIORITY = ("AFAD", "KOERI", "EMSC", "USGS")

# Clustering thresholds: seconds, kilometres, magnitude units.
DT_WINDOW_S = 90.0
DIST_KM_WINDOW = 50.0
DM_WINDOW = 1.0

# Mean Earth radius in km used by the distance test.
EARTH_RADIUS_KM = 6371.0088

RAW = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("event_id", T.StringType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("received_at", T.TimestampType(), False),
    T.StructField("archive_uri", T.StringType(), True),
])

CANONICAL = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("depth_km", T.DoubleType(), True),
    T.StructField("magnitude", T.DoubleType(), True),
    T.StructField("mag_type", T.StringType(), True),
    T.StructField("place", T.StringType(), True),
    T.StructField("province", T.StringType(), True),
    T.StructField("district", T.StringType(), True),
])

HARMONIZED = T.StructType(CANONICAL.fields + [
    T.StructField("archive_uri", T.StringType(), True),
    T.StructField("harmonized_at", T.TimestampType(), False),
])

SOURCE_VALUE = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("magnitude", T.DoubleType(), True),
    T.StructField("mag_type", T.StringType(), True),
    T.StructField("depth_km", T.DoubleType(), True),
    T.StructField("event_time", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("place", T.StringType(), True),
])

FACT = T.StructType([
    T.StructField("event_uid", T.StringType(), False),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("depth_km", T.DoubleType(), True),
    T.StructField("magnitude", T.DoubleType(), True),
    T.StructField("mag_type", T.StringType(), True),
    T.StructField("place", T.StringType(), True),
    T.StructField("province", T.StringType(), True),
    T.StructField("district", T.StringType(), True),
    T.StructField("preferred_source", T.StringType(), False),
    T.StructField("agreement_level", T.ShortType(), False),
    T.StructField("sources", T.ArrayType(T.StringType(), False), False),
    T.StructField("source_values", T.MapType(T.StringType(), SOURCE_VALUE), False),
    T.StructField("first_seen_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType(), False),
])

# Search document (the strict mapping: no other field is accepted).
DOCUMENT = T.StructType([
    T.StructField("event_uid", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ])),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("depth_km", T.DoubleType()),
    T.StructField("magnitude", T.DoubleType()),
    T.StructField("mag_type", T.StringType()),
    T.StructField("place", T.StringType()),
    T.StructField("province", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("preferred_source", T.StringType()),
    T.StructField("agreement_level", T.IntegerType()),
    T.StructField("sources", T.ArrayType(T.StringType())),
    T.StructField("source_values", T.MapType(T.StringType(), SOURCE_VALUE)),
])

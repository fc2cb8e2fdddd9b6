"""Schemas of the three tables."""

from pyspark.sql import types as T

#: What stands for NULL in a purchase line.
NULL_MARK = "\\N"

PURCHASES = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("category", T.StringType()),
        T.StructField("ip", T.StringType()),
    ]
)

COUNTRIES = T.StructType(
    [
        T.StructField("geoname_id", T.LongType()),
        T.StructField("locale_code", T.StringType()),
        T.StructField("continent_code", T.StringType()),
        T.StructField("continent_name", T.StringType()),
        T.StructField("country_iso_code", T.StringType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("is_in_e", T.BooleanType()),
    ]
)

BLOCKS = T.StructType(
    [
        T.StructField("network", T.StringType()),
        T.StructField("geoname_id", T.LongType()),
        T.StructField("registered_country_geoname_id", T.LongType()),
        T.StructField("represented_country_geoname_id", T.LongType()),
        T.StructField("is_anonymous_proxy", T.BooleanType()),
        T.StructField("is_satellite_provider", T.BooleanType()),
    ]
)

# Result schemas of the stored reports. Counts are 64-bit.
TOP_CATEGORIES = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("cnt", T.LongType()),
    ]
)

TOP_PRODUCTS = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("cnt", T.LongType()),
    ]
)

TOP_IP_COUNTRIES = T.StructType(
    [
        T.StructField("sump", T.DoubleType()),
        T.StructField("ip", T.StringType()),
        T.StructField("geoname_id", T.LongType()),
        T.StructField("country_name", T.StringType()),
        T.StructField("network", T.StringType()),
    ]
)

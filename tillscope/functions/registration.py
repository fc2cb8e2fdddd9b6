"""Registration of the address functions for SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillscope.functions import address


def register_functions(spark: SparkSession, *, null_as_zero: bool = False) -> None:
    """Create the temporary SQL functions getIP, getStartIP, getEndIP, getNetworkAddress,
    getBroadcastAddress and isInRange.

    They are SQL functions: the analyzer inlines their bodies, so calls are optimized like
    any built-in expression. `null_as_zero` makes NULL addresses and blocks 0.
    """
    first = address.cidr_first_sql("cidr")
    last = address.cidr_last_sql("cidr")
    bodies = {
        "getIP(ip STRING) RETURNS BIGINT": address.ip_to_long_sql(
            "ip", null_as_zero=null_as_zero
        ),
        "getStartIP(cidr STRING) RETURNS BIGINT": address.cidr_first_sql(
            "cidr", null_as_zero=null_as_zero
        ),
        "getEndIP(cidr STRING) RETURNS BIGINT": address.cidr_last_sql(
            "cidr", null_as_zero=null_as_zero
        ),
        "getNetworkAddress(cidr STRING) RETURNS STRING": address.long_to_ip_sql(f"({first})"),
        "getBroadcastAddress(cidr STRING) RETURNS STRING": address.long_to_ip_sql(f"({last})"),
        "isInRange(ip STRING, cidr STRING) RETURNS BOOLEAN": address.cidr_contains_sql(
            "ip", "cidr"
        ),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")

"""Timestamps of purchase lines.

Purchase times carry no zone, so they are TIMESTAMP_NTZ and none of the expressions
here depends on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOMENT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?$"


def parse_moment_sql(text: str) -> str:
    # The cast alone would also take a bare date or year, and drop a zone.
    return f"IF(trim({text}) RLIKE '{MOMENT}', try_cast(trim({text}) AS TIMESTAMP_NTZ), NULL)"


def parse_moment(text: str) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.fraction]' to a timestamp; NULL for anything else, a zone included."""
    return F.expr(parse_moment_sql(text))


def epoch_ms_sql(ts: str, zone: str = "UTC") -> str:
    local = ts if zone == "UTC" else f"convert_timezone('{zone}', 'UTC', {ts})"
    return (
        f"(CAST(unix_date(CAST({local} AS DATE)) AS BIGINT) * 86400000L"
        f" + hour({local}) * 3600000L + minute({local}) * 60000L"
        f" + CAST(floor(extract(SECOND FROM {local}) * 1000) AS BIGINT))"
    )


def epoch_ms(ts: str, zone: str = "UTC") -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock time read in `zone`."""
    return F.expr(epoch_ms_sql(ts, zone))


def day_text(ts: str) -> Column:
    """Day of a timestamp as 'yyyy-MM-dd', the value of the dt partition."""
    return F.expr(f"date_format({ts}, 'yyyy-MM-dd')")

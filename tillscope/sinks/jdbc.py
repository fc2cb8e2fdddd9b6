"""Database sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
    connections: int = 8,
    batch_size: int = 10_000,
    keep_definition: bool = False,
) -> None:
    """Write rows to a table, from at most `connections` tasks at a time.

    `properties` are those of the connection, such as user, password and driver.
    `keep_definition` empties an existing table on overwrite instead of dropping it, which
    keeps its types, indexes and grants.
    """
    (
        df.write.option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", keep_definition)
        .jdbc(url, table, mode=mode, properties=dict(properties or {}))
    )

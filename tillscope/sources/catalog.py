"""Catalog tables over existing files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillscope.sources.files import purchases_sql


def lines_table(table: str) -> str:
    return f"{table}_lines"


def create_purchase_table(
    spark: SparkSession, table: str, location: str, *, batches: bool = False
) -> None:
    """View `table` of the purchases in a `dt=yyyy-MM-dd` tree of lines.

    The lines are an external table; the view has the rule of `read_purchases`, so both see
    the same rows. `batches` is for the tree of an ingest sink, which has a directory for
    each batch below the day. Partitions are found in the directory tree, so there is no
    fixed list of days; call `refresh_partitions` after new days or batches have arrived.
    """
    lines = lines_table(table)
    below = ", batch_id" if batches else ""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {lines}")
    spark.sql(
        f"""CREATE TABLE {lines} (value STRING, dt STRING{", batch_id BIGINT" if batches else ""})
            USING text PARTITIONED BY (dt{below}) LOCATION '{location}'"""
    )
    refresh_partitions(spark, table)
    spark.sql(f"CREATE VIEW {table} AS {purchases_sql(lines, 'dt')}")


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition directory that exists now."""
    spark.sql(f"MSCK REPAIR TABLE {lines_table(table)}")

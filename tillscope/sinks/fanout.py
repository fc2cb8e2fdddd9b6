"""One result to several sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def write_all(df: DataFrame, *writers: Callable[[DataFrame], None]) -> None:
    """Compute `df` once and hand it to every writer.

    The cached blocks spill to disk and keep their lineage, so a lost executor costs a
    recomputation of its part and nothing else.
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writers:
            write(df)
    finally:
        df.unpersist()

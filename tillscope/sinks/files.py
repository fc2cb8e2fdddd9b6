"""File sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.sources.schemas import NULL_MARK

LAYOUTS = ("flat", "dt", "ymd")


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    *,
    mode: str = "overwrite",
    max_records_per_file: int = 0,
) -> None:
    """Write the columns as CSV that the quoted readers take back unchanged."""
    (
        (df.select(*columns) if columns else df)
        .write.mode(mode)
        .option("quote", '"')
        .option("escape", "\\")
        .option("charToEscapeQuoteEscaping", "\\")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", max_records_per_file)
        .csv(path)
    )


def flags_as_ints(df: DataFrame) -> DataFrame:
    """Boolean columns as 0/1, the way the country and block files store them."""
    flags = [name for name, kind in df.dtypes if kind == "boolean"]
    return df.withColumns({name: F.col(name).cast("int") for name in flags}) if flags else df


def layout_columns(layout: str, ts: str = "event_ts") -> dict[str, Column]:
    """Partition columns of a layout: none, dt=yyyy-MM-dd, or year= / month= / day=."""
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout: {layout}")
    if layout == "flat":
        return {}
    if layout == "dt":
        return {"dt": F.date_format(ts, "yyyy-MM-dd")}
    return {
        part: F.date_format(ts, pattern)
        for part, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))
    }


def append_lines(
    lines: DataFrame,
    path: str,
    layout: str = "flat",
    *,
    max_records_per_file: int = 0,
    gather: bool = False,
) -> None:
    """Append raw lines (`value`, and `event_ts` for a dated layout) as text files.

    Each task writes the days it holds. `gather` first brings the lines of a day together,
    for input spread over many days and tasks; a day that holds most of the lines is still
    split over several tasks.
    """
    parts = layout_columns(layout)
    rows = lines.withColumns(parts) if parts else lines
    if gather and parts:
        rows = rows.hint("rebalance", *parts)
    (
        rows.select("value", *parts)
        .write.mode("append")
        .partitionBy(*parts)
        .option("maxRecordsPerFile", max_records_per_file)
        .text(path)
    )


def lines_of(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as comma-separated text lines in `value`; NULL becomes an empty field."""
    return df.select(
        F.concat_ws(
            ",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        ).alias("value")
    )


def write_purchases(purchases: DataFrame, path: str) -> None:
    """Purchases as lines that `read_purchases` reads back as they are.

    The lines have no quoting, so a text that would not come back (with a comma or a line
    break, with blanks around, or the mark of a NULL) fails the write.
    """
    def text(name: str) -> Column:
        value = F.col(name)
        lost = value.rlike("[,\\n\\r]") | (value != F.trim(value, F.lit(" \t"))) | (value == NULL_MARK)
        refused = F.raise_error(F.concat(F.lit(f"no purchase line can hold {name}: "), value)).cast("string")
        return F.when(lost, refused).otherwise(F.coalesce(value, F.lit(NULL_MARK)))

    fields = [
        text("name"), F.col("price").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        text("category"), text("ip"),
    ]
    purchases.select(F.concat_ws(",", *fields).alias("value")).write.mode("overwrite").text(path)

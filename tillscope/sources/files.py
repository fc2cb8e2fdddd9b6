"""Text file readers. All have explicit schemas, so no pass over the data infers one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.functions import cidr_first, cidr_last, cidr_prefix
from tillscope.functions.moments import parse_moment_sql
from tillscope.functions.money import PRICE_LIMIT
from tillscope.operators.computed import compute_once
from tillscope.sources import schemas
from tillscope.sources.schemas import NULL_MARK

REJECTED = "rejected_line"

def _text(i: int) -> str:
    """Field i without blanks around; the mark of a NULL is NULL."""
    return f"nullif(trim(BOTH ' \\t' FROM get(_fields, {i})), '{NULL_MARK.replace(chr(92), 2 * chr(92))}')"


# The rule of a good purchase line, shared by the reader, the ingest and the catalog view.
_PRICE = "try_cast(get(_fields, 1) AS DOUBLE)"
_TIME = parse_moment_sql("get(_fields, 2)")
_GOOD = (
    f"(size(_fields) >= {len(schemas.PURCHASES)} AND price IS NOT NULL AND NOT isnan(price)"
    f" AND abs(price) < {PRICE_LIMIT} AND ts IS NOT NULL)"
)
_COLUMNS = {
    name: name if name in ("price", "ts") else _text(i)
    for i, name in enumerate(schemas.PURCHASES.names)
}


def purchases_sql(lines: str, *others: str) -> str:
    """`parse_purchases` as a query over a table of lines, for a view in the catalog."""
    columns = ", ".join([*[f"{e} AS {n}" for n, e in _COLUMNS.items()], *others])
    return (
        f"SELECT {columns} FROM {lines}"
        " LATERAL VIEW explode(array(split(value, ','))) AS _fields"
        f" LATERAL VIEW inline(array(named_struct('price', {_PRICE}, 'ts', {_TIME}))) AS price, ts"
        f" WHERE {_GOOD}"
    )


def parse_purchases(
    lines: DataFrame, *, strict: bool = False, keep_rejected: bool = False
) -> DataFrame:
    """Purchase lines `value` = `name,price,ts,category,ip` to typed columns.

    A line with fewer fields, with a time that does not parse, or with a price that does not,
    is no finite number or reaches PRICE_LIMIT, is dropped. It is kept, with its text in
    `rejected_line` and no other value, with `keep_rejected`, and fails the query with `strict`. Further fields are ignored and there is no quoting.
    Which lines are good does not depend on the columns a query takes. Other columns of
    `lines` are kept.
    """
    # Every good line needs the fields, the price and the time, so each is computed once.
    fields = compute_once(lines, "_fields", F.split("value", ","))
    typed = F.struct(F.expr(_PRICE).alias("price"), F.expr(_TIME).alias("ts"))
    parsed = fields.select("*", F.inline(F.array(typed)))
    good, columns = _GOOD, _COLUMNS
    others = [c for c in lines.columns if c != "value"]
    if keep_rejected:
        return parsed.select(
            *[F.expr(f"IF({good}, {e}, NULL)").alias(n) for n, e in columns.items()],
            *others,
            F.expr(f"IF({good}, NULL, value)").alias(REJECTED),
        )
    if strict:
        good = f"IF({good}, true, CAST(raise_error(concat('not a purchase: ', value)) AS BOOLEAN))"
    return parsed.where(good).select(
        *[F.expr(e).alias(n) for n, e in columns.items()], *others
    )


def read_purchases(
    spark: SparkSession,
    path: str,
    *,
    strict: bool = False,
    keep_rejected: bool = False,
    partitioned: bool = False,
) -> DataFrame:
    """Purchases from text files; see `parse_purchases`.

    `partitioned` reads a `dt=yyyy-MM-dd` directory tree: dt becomes a string column, and
    filters on it prune directories.
    """
    if partitioned:
        # Below the day an ingest sink has a directory for each batch.
        lines = spark.read.schema("value STRING, dt STRING").text(path).drop("batch_id")
    else:
        lines = spark.read.schema("value STRING").text(path)
    return parse_purchases(lines, strict=strict, keep_rejected=keep_rejected)


def _flag_columns(schema: T.StructType) -> list[Column]:
    """0/1 columns as booleans; the CSV reader itself only knows true/false."""
    return [
        F.col(f.name).cast("boolean").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
        for f in schema.fields
    ]


def _read_quoted(
    spark: SparkSession, path: str, schema: T.StructType, *, strict: bool, keep_rejected: bool
) -> DataFrame:
    stored = T.StructType(
        [
            T.StructField(
                f.name, T.IntegerType() if isinstance(f.dataType, T.BooleanType) else f.dataType
            )
            for f in schema.fields
        ]
    )
    rows = (
        spark.read.schema(stored.add(REJECTED, T.StringType()))
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", "\\")
        .option("charToEscapeQuoteEscaping", "\\")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        # Which lines are good must not depend on the columns a query takes.
        .option("columnPruning", False)
        .csv(path)
    )
    # Out of a generator, so that every column is read whichever of them a query takes.
    whole = rows.select(F.inline(F.array(F.struct(*rows.columns))))
    good = F.col(REJECTED).isNull()
    if keep_rejected:
        kept = [F.when(good, c).alias(n) for n, c in zip(schema.names, _flag_columns(schema))]
        return whole.select(*kept, F.col(REJECTED))
    if strict:
        refused = F.raise_error(F.concat(F.lit(f"not {', '.join(schema.names)}: "), F.col(REJECTED)))
        good = F.when(good, F.lit(True)).otherwise(refused.cast("boolean"))
    return whole.where(good).select(*_flag_columns(schema))


def read_countries(
    spark: SparkSession, path: str, *, strict: bool = False, keep_rejected: bool = False
) -> DataFrame:
    """Country names; quoted names may hold commas. An empty field is NULL.

    A line with fewer or more fields, or with one that is not of its type, is left out. With
    `keep_rejected` it is kept, with its text in `rejected_line` and no other value, and with
    `strict` it fails the query.
    """
    return _read_quoted(spark, path, schemas.COUNTRIES, strict=strict, keep_rejected=keep_rejected)


def read_blocks(
    spark: SparkSession, path: str, *, strict: bool = False, keep_rejected: bool = False
) -> DataFrame:
    """Address blocks with their first and last address; an empty id is NULL. Bad lines as in
    `read_countries`; a network that is no block is not one, and matches nothing."""
    rows = _read_quoted(spark, path, schemas.BLOCKS, strict=strict, keep_rejected=keep_rejected)
    return with_bounds(rows)


def with_bounds(blocks: DataFrame) -> DataFrame:
    """Add prefix_len, start_ip and end_ip to rows that have a `network`."""
    return blocks.withColumns(
        {
            "prefix_len": cidr_prefix("network"),
            "start_ip": cidr_first("network"),
            "end_ip": cidr_last("network"),
        }
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines in one column `value`, of files that may lie in partition directories."""
    return spark.read.text(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows. Reads only as many partitions as it takes to find them."""
    return df.limit(n)

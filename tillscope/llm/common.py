"""What several operators need: words as column expressions, row keys, written tables."""

from __future__ import annotations

import string
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.session import scratch_path

#: Between two words: all of ASCII but digits and letters (after lower-casing), or white space.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[\x20\x09-\x0D]+"


def whole_text(text) -> Column:
    """The text, empty instead of NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def split_words(text: Column, between: str) -> Column:
    """The words of a text in order, as an array without empty members."""
    return F.filter(F.split(text, between), lambda w: w != "")


def alnum_words(text) -> Column:
    """Words of digits, a-z and all characters from U+0080, A-Z lower-cased first."""
    return split_words(ascii_lower(whole_text(text)), NOT_WORD)


def spaced_words(text) -> Column:
    """Words between ASCII white space, as they are written."""
    return split_words(whole_text(text), SPACE)


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once, wherever and however often it is used.

    A lambda over an expression computes that expression again for every element; over the
    variable of this lambda it does not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names, so others cannot clash with them."""
    return df.select(*[F.col(f"`{theirs}`").alias(own) for own, theirs in columns.items()])


def unused(name: str, columns) -> str:
    """The name, with as many underscores behind it as none of the columns has."""
    while name in columns:
        name += "_"
    return name


_listening: list[list[str]] = []


@contextmanager
def scratch_noted():
    """A list of the folders that `saved` writes meanwhile, for who lets them go later."""
    made: list[str] = []
    _listening.append(made)
    try:
        yield made
    finally:
        _listening[:] = [x for x in _listening if x is not made]


def let_go(spark, paths: list[str], readers: DataFrame) -> list[str]:
    """Delete the folders of which `readers` reads none; those that are left."""
    read = readers.inputFiles() if paths else []
    left = [p for p in paths if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in read)]
    for path in set(paths) - set(left):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    for noted in _listening:
        noted[:] = [p for p in noted if p in left or p not in paths]
    return left


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends here.

    A lost executor costs a later stage nothing but its own tasks, and a plan that uses the
    rows twice computes them once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for made in _listening:
        made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Largest table that is sent to every executor, in bytes of its values; a larger one is shuffled.
SENT = 16 << 20


def sent_if_small(df: DataFrame, size: Column) -> DataFrame:
    """A written table, marked for broadcast if the sum of `size` over its rows is at most SENT."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= SENT else df


#: A group of more than one row in HEAVY is a large one, so there are fewer large ones than HEAVY.
HEAVY = 10_000


def joined_to_groups(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """Rows with what is known of their group: `groups` has each key once, and n, its rows.

    The large groups among `total` rows, fewer than HEAVY, are sent to every task, so that no
    task gets all rows of one; the others are shuffled.
    """
    large = groups.filter(F.col("n") * HEAVY > total)
    small = groups.filter(F.col("n") * HEAVY <= total)
    rest = rows.join(F.broadcast(large.select(key)), key, "left_anti")
    return rows.join(F.broadcast(large), key).unionByName(rest.join(small, key))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

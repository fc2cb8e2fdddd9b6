"""IPv6 addresses and blocks as column expressions: 128 bits as two BIGINTs, high and low.

The BIGINTs are the bits as they are, so the high one of an address from 8000:: up is negative.
Text is read with string functions alone: groups are padded to four digits, `::` is filled up to
32 digits, and a dotted tail is turned into two groups first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillscope.functions.address import _IPV4, ip_to_long_sql

BITS = 128
_GROUP = "[0-9a-f]{1,4}"
_GROUPS = f"{_GROUP}(:{_GROUP})*"
_WHOLE = f"^{_GROUP}(:{_GROUP}){{7}}$"
_SHORT = f"^({_GROUPS})?::({_GROUPS})?$"
_LENGTH = "^(12[0-8]|1[01][0-9]|[0-9]{1,2})$"


def _groups_sql(ip: str) -> str:
    """Lower-case text with a dotted tail as two groups."""
    text = f"lower(trim({ip}))"
    tail = f"substring_index({text}, ':', -1)"
    digits = f"lpad(hex({ip_to_long_sql(tail)}), 8, '0')"
    as_groups = f"lower(concat(left({digits}, 4), ':', right({digits}, 4)))"
    head = f"left({text}, length({text}) - length({tail}))"
    return (
        f"CASE WHEN NOT contains({text}, '.') THEN {text}"
        f" WHEN {tail} RLIKE '^{_IPV4}$' THEN concat({head}, {as_groups}) END"
    )


def digits_sql(ip: str) -> str:
    """The 32 hexadecimal digits of an address; NULL if the text is none."""
    # Each group gets zeros before it and keeps its last four digits.
    padded = (
        "regexp_replace(regexp_replace(g, '([0-9a-f]+)', '000$1'), '[0-9a-f]*([0-9a-f]{4})(?![0-9a-f])', '$1')"
    )
    before = "replace(substring_index(p, '::', 1), ':', '')"
    behind = "replace(substring_index(p, '::', -1), ':', '')"
    filled = f"concat({before}, repeat('0', 32 - length({before}) - length({behind})), {behind})"
    whole = "replace(p, ':', '')"
    # An address of eight groups has no `::`, and one with `::` leaves out a group or more.
    value = (
        f"CASE WHEN g RLIKE '{_WHOLE}' THEN {whole}"
        f" WHEN g RLIKE '{_SHORT}' AND length({before}) + length({behind}) <= 28 THEN {filled} END"
    )
    # The text is prepared once, as the variables of lambdas.
    return (
        f"element_at(transform(transform(array({_groups_sql(ip)}), g -> named_struct('g', g, 'p', {padded})),"
        f" s -> {value.replace('g RLIKE', 's.g RLIKE').replace('(p,', '(s.p,')}), 1)"
    )


def ip6_parts(ip: str) -> tuple[Column, Column]:
    """High and low BIGINT of an IPv6 address; both NULL if the text is none. Blanks around it are
    ignored, and zones (`%eth0`) are not read."""
    digits = digits_sql(ip)
    return tuple(F.expr(f"CAST(conv(substring({digits}, {start}, 16), 16, -10) AS BIGINT)") for start in (1, 17))


def cidr6_prefix(cidr: str) -> Column:
    """Prefix length of an IPv6 block, 0 to 128; NULL if what is behind the slash is none."""
    length = f"trim(substring_index({cidr}, '/', -1))"
    return F.expr(f"IF(contains({cidr}, '/') AND {length} RLIKE '{_LENGTH}', CAST({length} AS INT), NULL)")


def mask6(length: str) -> tuple[Column, Column]:
    """The bits of a prefix, high and low. A shift by all 64 bits would shift by none."""
    high = f"CASE WHEN {length} <= 0 THEN 0L WHEN {length} >= 64 THEN -1L ELSE shiftleft(-1L, 64 - {length}) END"
    low = f"CASE WHEN {length} <= 64 THEN 0L WHEN {length} >= 128 THEN -1L ELSE shiftleft(-1L, 128 - {length}) END"
    return F.expr(high), F.expr(low)


def network6(high: str, low: str, length: str) -> tuple[Column, Column]:
    """First address of the block of this length that holds the address."""
    first, second = mask6(length)
    return F.col(high).bitwiseAND(first), F.col(low).bitwiseAND(second)


def last6(high: str, low: str, length: str) -> tuple[Column, Column]:
    """Last address of the block of this length that holds the address."""
    first, second = mask6(length)
    return F.col(high).bitwiseOR(F.bitwise_not(first)), F.col(low).bitwiseOR(F.bitwise_not(second))


def ip6_text(high: str, low: str) -> Column:
    """Eight groups of four digits, without `::`."""
    digits = F.lower(F.concat(*[F.lpad(F.hex(F.col(c)), 16, "0") for c in (high, low)]))
    return F.concat_ws(":", *[F.substring(digits, 4 * i + 1, 4) for i in range(8)])

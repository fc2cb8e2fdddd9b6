"""IPv4 addresses and CIDR blocks as column expressions.

Every function takes SQL expressions (usually column names) and returns a Column. The
`*_sql` twins return the expression text, which is also the body of the registered SQL
functions. Nothing here needs a Python worker, and nothing is a higher-order function or a
regular expression on the path of an address, so the expressions stay inside whole-stage
code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
_IPV4 = f"{_OCTET}(?:[.]{_OCTET}){{3}}"
_CIDR = f"^ *{_IPV4}/(3[0-2]|[0-2]?[0-9]) *$"


def ip_to_long_sql(ip: str, *, strict: bool = False, null_as_zero: bool = False) -> str:
    # Trailing dots open no further octet, and missing octets count as 0.
    padded = f"concat(rtrim('.', {ip}), '.0.0.0')"
    octets = [f"substring_index({padded}, '.', 1)"] + [
        f"substring_index(substring_index({padded}, '.', {i}), '.', -1)" for i in (2, 3, 4)
    ]
    value = " + ".join(
        f"CAST(try_cast({octet} AS INT) % 256 AS BIGINT) * {256 ** (3 - i)}L"
        for i, octet in enumerate(octets)
    )
    if strict:
        error = f"raise_error(concat('not an IPv4 address: ', {ip}))"
        value = f"IF({ip} IS NULL, NULL, coalesce({value}, CAST({error} AS BIGINT)))"
    if null_as_zero:
        value = f"IF({ip} IS NULL, 0L, {value})"
    return f"({value})"


def ip_to_long(ip: str, *, strict: bool = False, null_as_zero: bool = False) -> Column:
    """Dotted address to integer: octet i counts 256^(3-i), octets wrap at 256.

    Short addresses are left-aligned ('1.2' is 1*256^3 + 2*256^2) and octets after the
    fourth add nothing. Blanks around octets are ignored. A text octet gives NULL, or an
    error with `strict`; a NULL address gives NULL, or 0 with `null_as_zero`.
    """
    return F.expr(ip_to_long_sql(ip, strict=strict, null_as_zero=null_as_zero))


def long_to_ip_sql(n: str) -> str:
    octets = [f"CAST(shiftright({n}, {shift}) & 255 AS STRING)" for shift in (24, 16, 8, 0)]
    return "concat(" + ", '.', ".join(octets) + ")"


def long_to_ip(n: str) -> Column:
    """Integer to dotted address."""
    return F.expr(long_to_ip_sql(n))


def network_of_sql(n: str, prefix: str) -> str:
    return f"({n} & shiftleft(-1L, 32 - {prefix}))"


def network_of(n: str, prefix: str) -> Column:
    """First address of the block of length `prefix` that holds `n`."""
    return F.expr(network_of_sql(n, prefix))


def last_of_sql(n: str, prefix: str) -> str:
    return f"({n} | (shiftleft(1L, 32 - {prefix}) - 1L))"


def last_of(n: str, prefix: str) -> Column:
    """Last address of the block of length `prefix` that holds `n`."""
    return F.expr(last_of_sql(n, prefix))


def cidr_prefix_sql(cidr: str) -> str:
    return f"try_cast(regexp_extract({cidr}, '{_CIDR}', 1) AS INT)"


def cidr_prefix(cidr: str) -> Column:
    """Prefix length of a block; NULL unless the text is four octets, '/', 0 to 32."""
    return F.expr(cidr_prefix_sql(cidr))


def cidr_address_sql(cidr: str) -> str:
    return ip_to_long_sql(f"substring_index({cidr}, '/', 1)")


def cidr_address(cidr: str) -> Column:
    """The address before the slash, host bits included."""
    return F.expr(cidr_address_sql(cidr))


def cidr_first_sql(cidr: str, *, null_as_zero: bool = False) -> str:
    value = network_of_sql(cidr_address_sql(cidr), cidr_prefix_sql(cidr))
    return f"IF({cidr} IS NULL, 0L, {value})" if null_as_zero else value


def cidr_first(cidr: str, *, null_as_zero: bool = False) -> Column:
    """First address of a block as an integer. Host bits in the text are masked off."""
    return F.expr(cidr_first_sql(cidr, null_as_zero=null_as_zero))


def cidr_last_sql(cidr: str, *, null_as_zero: bool = False) -> str:
    value = last_of_sql(cidr_address_sql(cidr), cidr_prefix_sql(cidr))
    return f"IF({cidr} IS NULL, 0L, {value})" if null_as_zero else value


def cidr_last(cidr: str, *, null_as_zero: bool = False) -> Column:
    """Last address of a block as an integer."""
    return F.expr(cidr_last_sql(cidr, null_as_zero=null_as_zero))


def cidr_contains_sql(ip: str, cidr: str) -> str:
    # The address lies in the block if no bit of the prefix differs.
    address = f"IF({ip} RLIKE '^ *{_IPV4} *$', {ip_to_long_sql(ip)}, NULL)"
    difference = f"{address} ^ {cidr_address_sql(cidr)}"
    return f"(shiftright({difference}, 32 - {cidr_prefix_sql(cidr)}) = 0L)"


def cidr_contains(ip: str, cidr: str) -> Column:
    """Whether the block holds the address, both ends included."""
    return F.expr(cidr_contains_sql(ip, cidr))

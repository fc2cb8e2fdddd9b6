"""Column functions. Each has one SQL body, used by the DataFrame form and by the
registered SQL function alike."""

from tillscope.functions.address import (
    cidr_contains,
    cidr_first,
    cidr_last,
    cidr_prefix,
    ip_to_long,
    long_to_ip,
    network_of,
)
from tillscope.functions.moments import day_text, epoch_ms, parse_moment
from tillscope.functions.money import exact_money, money_of
from tillscope.functions.registration import register_functions

__all__ = [
    "exact_money",
    "cidr_contains",
    "cidr_first",
    "cidr_last",
    "cidr_prefix",
    "day_text",
    "epoch_ms",
    "ip_to_long",
    "long_to_ip",
    "money_of",
    "network_of",
    "parse_moment",
    "register_functions",
]

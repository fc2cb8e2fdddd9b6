"""Building blocks of the reports."""

from tillscope.operators.aggregates import (
    count_by,
    spend_by_ip,
    spend_by_ip_long,
    with_category_total,
)
from tillscope.operators.computed import compute_once
from tillscope.operators.geojoin import BlockIndex, block_index, cidr_join
from tillscope.operators.pruning import in_reach_of_top, top_sums
from tillscope.operators.ranking import top_k, top_k_per_group

__all__ = [
    "BlockIndex",
    "block_index",
    "cidr_join",
    "compute_once",
    "count_by",
    "in_reach_of_top",
    "spend_by_ip",
    "spend_by_ip_long",
    "top_k",
    "top_k_per_group",
    "top_sums",
    "with_category_total",
]

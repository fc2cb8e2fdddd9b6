"""Writers of reports and of raw lines."""

from tillscope.sinks.fanout import write_all
from tillscope.sinks.files import append_lines, write_csv
from tillscope.sinks.jdbc import write_jdbc

__all__ = ["append_lines", "write_all", "write_csv", "write_jdbc"]

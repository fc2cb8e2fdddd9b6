"""The registered queries over the star-schema test tables, and their SQL twins."""

from tillscope.registered.queries import QUERIES
from tillscope.registered.twins import SQL_TWINS

__all__ = ["QUERIES", "SQL_TWINS"]

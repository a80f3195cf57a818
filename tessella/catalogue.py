"""Queries by name, and their SQL."""

from .plans.oracle import SQL as ORACLE
from .plans.queries import ALL

QUERIES = {f.__name__: f for f in ALL}

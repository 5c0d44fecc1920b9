"""Importing the modules registers their queries, in this order."""

# isort: off
from comarca.queries import operator_queries
from comarca.queries import table_queries
from comarca.queries import report_queries
from comarca.queries import file_queries
# isort: on
from comarca.queries.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "file_queries",
    "operator_queries",
    "report_queries",
    "table_queries",
]

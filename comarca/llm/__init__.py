"""Operators on training documents, and their queries.

The queries are loaded when they are asked for: Spark's Python workers, which import this package to
find one function, then load one module and what it needs.
"""


def __getattr__(name: str):
    if name in ("QUERIES", "SQL"):
        from comarca.llm import queries

        return getattr(queries, name)
    raise AttributeError(name)

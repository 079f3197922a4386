"""Registered queries over the test tables, and the SQL they are compared with."""

from catalog import queries, loads  # noqa: E402, F401, I001

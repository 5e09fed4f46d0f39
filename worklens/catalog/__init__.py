"""The registry behind ``__spark_entry__``: every query key and its oracle SQL."""

from worklens.catalog import reports, trends  # noqa: F401,I001  (register keys, in order)
from worklens.catalog import blocks  # noqa: F401,E402
from worklens.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

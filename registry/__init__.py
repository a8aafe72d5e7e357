"""Every operator as a query on the driver tables, with the same result in plain SQL."""

from registry import (  # noqa: F401
    calls, datasets, dimensions, evaluation, filters, inference, jobs, jsons, joins, sources, text,
)
from registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

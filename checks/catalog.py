"""All registered queries and their SQL."""

from checks import cleaning, combining, flows, kept, rowwise, star  # noqa: F401  (registration)
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries over the driver's test tables, and their SQL oracles."""

from sievekit.plans.queries import QUERIES, flagship  # noqa: F401
from sievekit.plans.oracle import ORACLE_SQL  # noqa: F401

"""Registered queries: the operators of the package on the driver's tables, with SQL to check them."""

from contract.registry import ORACLES, QUERIES
from contract import (  # noqa: F401  (each module registers its queries)
    q_sources, q_sinks, q_select, q_joins, q_aggregates, q_functions, q_grid, q_catalogue, q_maintain, q_runs,
)

__all__ = ["ORACLES", "QUERIES"]

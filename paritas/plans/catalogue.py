"""Every registered query; importing a module registers its queries."""

from paritas.plans import relational, storage, upkeep, validation, views  # noqa: F401
from paritas.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

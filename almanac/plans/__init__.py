"""The registered queries: every analysis bound to the Parquet tables, with the SQL it must agree with."""

from almanac.plans import bars, calendar, classes, contrasts, density, weekly  # noqa: F401  (they register)
from almanac.plans.registry import oracles, queries

__all__ = ["oracles", "queries"]

"""All queries of the library with their SQL."""

from gazetta.plans import hierarchies, logs, records, scans, storage, updates  # noqa: F401  they register themselves
from gazetta.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

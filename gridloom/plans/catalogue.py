"""All queries: importing this module registers them."""

from . import analysis, cleaning, files, functions, inventory, lineage, physical, scans, streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

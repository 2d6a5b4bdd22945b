"""All registered queries of the linkage library."""

from __future__ import annotations

from . import detection, more  # noqa: F401  they register themselves
from .queries import ORACLES, QUERIES


def queries_and_oracles():
    """All queries by name, and the SQL of those that have one."""
    return QUERIES, ORACLES

"""All registered queries and their oracles."""

from emiscope.plans.catalog import (  # noqa: F401  (imports register the queries)
    control, joins, jobs, profiles, rows, scalars, scans, streams, windows,
)
from emiscope.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

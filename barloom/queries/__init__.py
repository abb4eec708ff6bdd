"""Named queries over the driver tables, each with its DuckDB counterpart.

Importing the modules below fills `QUERIES` and `ORACLES`.
"""

from barloom.queries.registry import ORACLES, QUERIES
from barloom.queries import (  # noqa: F401  (registration)
    bars,
    files,
    incremental,
    indicators,
    quality,
    relational,
    scalars,
)

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries (one per inventory operator) and their DuckDB oracles.

Every query reads the driver tables — most through the behaviour view that
``rankforge.sources.fixture`` builds over ``orders`` — and runs over the whole
table.  Computed doubles are rounded to 6 digits on both sides where the
inventory marks the check ``SQL~`` (exp/ln/pow, or sums whose order differs).
"""

from rankforge.catalog.base import ORACLES, QUERIES, register  # noqa: F401
from rankforge.catalog import core, splits_metrics, encoders, blends, projections, io_gates, fitting, boosting, runs  # noqa: F401,E402
from rankforge.catalog.core import cohort_risk  # noqa: F401,E402

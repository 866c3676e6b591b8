"""Every operator as a query over the given tables, with the SQL it must equal."""

from urbanlake.queries import (  # noqa: F401
    aggregates,
    cleaning,
    joins,
    landing,
    ledger,
    quality,
    reports,
    scalars,
    sinks,
    windows,
)
from urbanlake.queries.registry import ORACLE, QUERIES  # noqa: F401

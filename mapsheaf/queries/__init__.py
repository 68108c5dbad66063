"""Every operator as a query over the driver's tables, with its SQL counterpart."""

from mapsheaf.queries import (  # noqa: F401
    audits, catalog, classes, filters, inspection, lookups, tiles, views,
)
from mapsheaf.queries.registry import REGISTRY  # noqa: F401

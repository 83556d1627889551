"""All registered queries with their check SQL."""

from eavista.catalog import registry
from eavista.catalog import (  # noqa: F401  (importing a module registers its checks)
    aggregates, changes, derived, dimensions, eav, joins, predicates, reports, scalars, scans,
)


def queries():
    return dict(registry.QUERIES)


def oracle_sql():
    return dict(registry.ORACLES)

"""The registered queries: each a Spark job over the given tables and its SQL twin."""

from tablewright.catalogue import (  # noqa: F401  (importing registers the queries)
    aggregating,
    arrays,
    comparing,
    jobs,
    mapping,
    naming,
    projecting,
    sampling,
    scalars,
    storing,
    udfs,
)
from tablewright.catalogue.registry import REGISTRY, Query, table

__all__ = ["REGISTRY", "Query", "table"]

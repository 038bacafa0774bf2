"""The registered queries."""

from filmloom.workload import (  # noqa: F401
    aggregates,
    evaluation,
    features,
    joins,
    models,
    quality,
    recommenders,
    rows,
    streams,
)
from filmloom.workload.registry import QUERIES, SQL  # noqa: F401

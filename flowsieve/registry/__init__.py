"""All registered queries. Importing the package fills the registry."""

from flowsieve.registry import (  # noqa: F401
    alerting,
    decisions,
    evaluations,
    models,
    preparation,
    profiles,
    streams,
)
from flowsieve.registry.core import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

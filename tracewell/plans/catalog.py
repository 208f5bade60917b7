"""All registered queries. Importing the modules fills the registry."""

from tracewell.plans import (  # noqa: F401
    graph_queries, incremental_queries, relational_queries, root_cause_queries, series_queries,
    text_queries,
)
from tracewell.plans.registry import ORACLES, QUERIES  # noqa: F401

"""All registered queries; importing the modules registers them."""

from lodestar.plans import (  # noqa: F401
    queries_aggregates,
    queries_columns,
    queries_graph,
    queries_joins,
    queries_models,
    queries_rows,
    queries_similarity,
    queries_sources,
    queries_text,
    queries_time,
)
from lodestar.plans.registry import QUERIES, SQL  # noqa: F401

"""The query catalogue: every operation over the given tables, with its SQL counterpart."""

from millrace.plans import (  # noqa: F401
    array_queries,
    layout_queries,
    nested_queries,
    source_queries,
    stream_queries,
    table_queries,
)
from millrace.plans.catalogue import ORACLES, QUERIES  # noqa: F401

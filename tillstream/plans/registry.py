"""All queries over the test tables and their SQL equivalents."""

from __future__ import annotations

import functools

from tillstream.plans import (
    aggregate_queries,
    join_queries,
    pattern_queries,
    row_queries,
    stats_queries,
    stream_queries,
)
from tillstream.session import configure

_PARTS = [stats_queries, row_queries, aggregate_queries, join_queries, pattern_queries, stream_queries]



def _configured(query):
    """The query with the session settings applied where it begins, and nowhere else."""
    @functools.wraps(query)
    def begin(spark, sf):
        return query(configure(spark), sf)

    return begin


QUERIES = {name: _configured(query) for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}

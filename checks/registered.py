"""All queries and their SQL."""

from checks import (
    capture_queries, hazard_queries, place_queries, run_queries, text_queries, time_queries,
)

QUERIES, ORACLE = {}, {}
for _module in (
    text_queries, hazard_queries, place_queries, time_queries, capture_queries, run_queries,
):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)

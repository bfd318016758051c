"""All registered queries. Importing a query module registers what it defines."""

from contentgate.plans import file_queries, history_queries, record_queries, scan_queries, stream_queries, text_queries  # noqa: F401
from contentgate.plans.registered import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

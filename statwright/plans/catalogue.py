"""Collects the queries of all groups."""

from . import (cleaning_queries, curve_queries, inference_queries, regression_queries,  # noqa: F401
               series_queries, source_queries, table_queries)
from .registry import QUERIES, SQL  # noqa: F401

"""Every operator as a named query over the test tables, most with an equivalent SQL text."""

from ledgerlens.plans.catalog.registry import QUERIES, SQL_TEXTS
from ledgerlens.plans.catalog import (  # noqa: F401  (importing registers the queries)
    budgets, customers, drift, evaluation, lines, models, reports, segments, uplift, value,
)

__all__ = ["QUERIES", "SQL_TEXTS"]

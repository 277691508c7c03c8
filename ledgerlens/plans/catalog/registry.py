"""Registration of queries and composition of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.config import Settings

# The order dates of the test tables run from 1995-01-01 to 2001-08-01.
SETTINGS = Settings(
    observation_start=date(1995, 1, 1), observation_end=date(2000, 1, 1),
    holdout_start=date(2000, 1, 2), holdout_end=date(2001, 8, 1),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL_TEXTS: dict[str, str] = {}
# Inputs that the query being built has made so far; None outside a query.
_INPUTS: ContextVar[dict | None] = ContextVar("inputs", default=None)
# name → (names it builds on, SELECT)
FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}


def fragment(name: str, select: str, needs=()) -> None:
    FRAGMENTS[name] = (tuple(needs), select)


def compose(body: str, needs) -> str:
    """Prefix ``body`` with the common table expressions it needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for parent in FRAGMENTS[name][0]:
                visit(parent)
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return body
    parts = ",\n".join(f"{name} AS MATERIALIZED ({FRAGMENTS[name][1]})" for name in ordered)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def once(build: Callable[[SparkSession, str], DataFrame]):
    """An input that several parts of one query share: built on first use, and anew for every query."""

    @wraps(build)
    def get(spark: SparkSession, sf: str) -> DataFrame:
        made = _INPUTS.get()
        if made is None:
            return build(spark, sf)
        key = (build.__name__, sf)
        if key not in made:
            made[key] = build(spark, sf)
        return made[key]

    return get


def replace_input(name: str, sf: str, change: Callable[[], DataFrame]) -> None:
    """Let the rest of the query being built read ``change()`` for the input ``name``; done at most once."""
    made = _INPUTS.get()
    if made is not None and (name, sf, "replaced") not in made:
        made[name, sf] = made[name, sf, "replaced"] = change()


def query(name: str, sql: str | None = None, needs=()):
    """Register a query; with ``sql`` it is compared value by value."""

    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        @wraps(build)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            token = _INPUTS.set({})
            try:
                return build(spark, sf)
            finally:
                _INPUTS.reset(token)

        QUERIES[name] = run
        if sql is not None:
            SQL_TEXTS[name] = compose(sql, needs)
        return build

    return wrap

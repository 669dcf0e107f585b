"""Registry of the engine's queries and their SQL oracles."""

from __future__ import annotations

from tidemark.plans.control import control_queries
from tidemark.plans.control_sql import control_sql
from tidemark.plans.oracle import all_sql
from tidemark.plans.queries import all_queries, q_indicator_grid


def flagship(spark, sf_dir):
    return q_indicator_grid(spark, sf_dir)


def queries() -> dict:
    return all_queries() | control_queries()


def oracle_sql() -> dict:
    return all_sql() | control_sql()

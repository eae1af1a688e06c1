"""The check SQL of every query that SQL can express."""

from __future__ import annotations

from tillsight.plans import oracle_model, oracle_tables
from tillsight.plans.oracle_base import TABLES, compose
from tillsight.plans.oracle_types import as_doubles


def oracle() -> dict[str, str]:
    queries = {**oracle_tables.QUERIES, **oracle_model.QUERIES}
    tables = {**TABLES, **oracle_model.TABLES}
    return {name: compose(as_doubles(name, query), tables) for name, query in queries.items()}

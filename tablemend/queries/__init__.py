"""Registered queries over the shared test tables, each with equivalent SQL where SQL can say it."""

from tablemend.queries import expressions, filling, identities, jobs, joining, sets, shaping, sources, updating  # noqa: F401
from tablemend.queries.registry import oracle_sql, queries  # noqa: F401

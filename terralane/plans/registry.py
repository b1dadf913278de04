"""All queries of the library outside the training-data subpackage."""

from __future__ import annotations

from terralane.plans import classes, economy, extras, functions, more, places, problems, publishing, relational

MODULES = [problems, relational, functions, economy, places, classes, publishing, more, extras]
FLAGSHIP = "x14_inverse_distance_scores"


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}

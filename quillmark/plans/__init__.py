"""Named queries over the test tables (QUERIES) and the same queries as SQL (SQL)."""

from __future__ import annotations

from quillmark.plans import general, jobs, mining, models, monitoring, relational, scalar, searches

_MODULES = [general, jobs, mining, models, monitoring, relational, scalar, searches]
QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}

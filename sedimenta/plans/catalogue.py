"""All queries of the core and their SQL."""

from __future__ import annotations

from sedimenta.plans import aggregating, analysing, assembling, coding, curation, feeding, joining, resolving, texting, versioning

MODULES = [curation, coding, resolving, aggregating, joining, versioning, texting, analysing, feeding, assembling]
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}

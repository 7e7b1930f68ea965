"""All queries by name, with the SQL that an independent engine runs on the same tables."""

from . import deliveries, documented, enrichments, retail, stock, streams

_PARTS = (stock, retail, streams, enrichments, deliveries, documented)
QUERIES: dict = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLE: dict = {name: sql for part in _PARTS for name, sql in part.ORACLE.items()}

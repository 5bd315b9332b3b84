"""Registry of the library's own queries and their SQL counterparts."""

from __future__ import annotations

from lexweave.plans import checks, corpus, documents, molecules, warehouse

QUERIES: dict = {**corpus.QUERIES, **documents.QUERIES, **warehouse.QUERIES, **molecules.QUERIES, **checks.QUERIES}
ORACLES: dict[str, str] = {**corpus.ORACLES, **documents.ORACLES, **warehouse.ORACLES, **molecules.ORACLES, **checks.ORACLES}

"""All queries outside the optional subpackage, and their oracles."""

from __future__ import annotations

from . import data, functions, loading, reference

FLAGSHIP = "motif_coverage"

QUERIES = {**reference.QUERIES, **loading.QUERIES, **functions.QUERIES, **data.QUERIES}
ORACLES = {**reference.ORACLES, **loading.ORACLES, **functions.ORACLES, **data.ORACLES}

"""All queries of the engine's own operators, and the SQL that checks them."""

from . import postings, reports, upkeep

QUERIES: dict = {**reports.QUERIES, **postings.QUERIES, **upkeep.QUERIES}
ORACLES: dict = {**reports.ORACLES, **postings.ORACLES, **upkeep.ORACLES}

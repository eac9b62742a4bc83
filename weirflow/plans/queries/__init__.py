"""The registered queries: one per operator, each with the SQL that must give the same rows."""

from weirflow.plans.queries import checks, delivery, enrichment, ingestion, parsing, reliability, tables  # noqa: F401
from weirflow.plans.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

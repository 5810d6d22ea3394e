"""The registered queries, each with its SQL equivalent where SQL can state it."""

from contract import extraction, gates, plans, profiles, records, sources, tables  # noqa: F401
from contract.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]

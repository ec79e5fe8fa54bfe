"""The query catalogue."""

from tidewell.plans import expressions, formats, records, services, stores, streams, tables
from tidewell.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "expressions", "formats", "records", "services", "stores", "streams", "tables"]

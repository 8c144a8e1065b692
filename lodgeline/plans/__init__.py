"""All registered queries."""

from lodgeline.plans import bookings, logs, models, monitoring, reports, streams, tables
from lodgeline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "bookings", "logs", "models", "monitoring", "reports", "streams", "tables"]

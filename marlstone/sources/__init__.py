"""Readers: payloads of every feed format to raw events, each payload with a verdict.

Every reader takes payload rows (schemas.PAYLOAD), today and horizon_days and
returns PARSED rows: one per occurrence, or one without an event for a payload
that has none, so that a failure is a row and never an empty result.
"""

from marlstone.sources.base import ADAPTERS, events_of, read_source, reports_of

__all__ = ["ADAPTERS", "events_of", "read_source", "reports_of"]

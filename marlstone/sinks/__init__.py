"""Artifacts: iCalendar, RSS and JSON, rendered as columns, validated as aggregates, written atomically."""

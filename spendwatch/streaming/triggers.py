"""How often a stream runs: keyword arguments of `DataStreamWriter.trigger`."""

from __future__ import annotations

Trigger = dict[str, object]

# Drain what is there, then stop. A stream that runs on takes {"processingTime": "10 seconds"}.
AVAILABLE_NOW: Trigger = {"availableNow": True}

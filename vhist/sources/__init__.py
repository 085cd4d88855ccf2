"""Snapshot and history sources and sinks, and snapshots derived from the driver tables."""

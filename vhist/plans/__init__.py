"""Composite plans (processing one snapshot, chains of merges), size checks, and
the catalogue of queries run over the driver tables."""

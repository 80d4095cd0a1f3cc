"""Importing this module registers every query."""

from workload import derived, drifting, gold, ingest, modelling, profiles  # noqa: F401

"""Registered queries with their SQL twins."""

from funnelloom.catalog.registry import ORACLES, QUERIES  # noqa: F401

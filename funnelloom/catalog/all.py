"""Import every catalogue module, which registers its queries."""

from funnelloom.catalog import assigned, basics, boards, channels, cohorts, goals, profiles, streams, today  # noqa: F401

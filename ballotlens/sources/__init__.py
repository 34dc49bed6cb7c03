"""Sources: exported governance tables (catalog) and test fixtures."""

from ballotlens.sources.tables import Tables  # noqa: F401

"""Sources (catalog, parquet, JDBC, test-data binding) and sinks."""

from reachlens.sources.catalog import Catalog, normalise

__all__ = ["Catalog", "normalise"]

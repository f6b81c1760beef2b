"""All registered queries (importing the modules fills the registry)."""

from cellwise.plans import (  # noqa: F401
    catalog, catalog_governance, catalog_metrics, catalog_models, catalog_sources,
)
from cellwise.plans.catalog import ORACLE, QUERIES, clean_split_class_counts

__all__ = ["ORACLE", "QUERIES", "clean_split_class_counts"]

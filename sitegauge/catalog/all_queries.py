"""Imports every query module, which fills the registry."""

from sitegauge.catalog import (  # noqa: F401
    contact_queries,
    crawl_queries,
    gold_queries,
    page_queries,
    serving_queries,
    source_queries,
    text_queries,
)
from sitegauge.catalog.registry import ORACLES, QUERIES  # noqa: F401

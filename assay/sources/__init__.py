"""Sources: the nested downloads fact table, the driver's tables, the country set."""

from .countries import country_codes, country_dim
from .downloads import (
    DOWNLOADS_FIELDS,
    check_source_schema,
    downloads_from_events,
    read_downloads,
)
from .tables import TABLES, read_table

__all__ = [
    "DOWNLOADS_FIELDS",
    "TABLES",
    "check_source_schema",
    "country_codes",
    "country_dim",
    "downloads_from_events",
    "read_downloads",
    "read_table",
]

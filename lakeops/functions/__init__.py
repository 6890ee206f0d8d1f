from lakeops.functions.dates import (
    calendar_columns,
    chunk_ranges,
    coerce_date,
    compact_date,
    dashed_date,
    date_range_array,
    normalize_dt,
    normalize_dt_text,
    parse_date,
    previous_day,
    previous_day_utc,
)
from lakeops.functions.text import (
    ingest_order,
    join_location,
    json_sorted,
    location_parts,
    partition_location,
    partition_of,
    sanitize_key,
    sha256_text,
)

__all__ = [
    "calendar_columns",
    "chunk_ranges",
    "coerce_date",
    "compact_date",
    "dashed_date",
    "date_range_array",
    "ingest_order",
    "join_location",
    "json_sorted",
    "location_parts",
    "normalize_dt",
    "normalize_dt_text",
    "parse_date",
    "partition_location",
    "partition_of",
    "previous_day",
    "previous_day_utc",
    "sanitize_key",
    "sha256_text",
]

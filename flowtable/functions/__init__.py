from flowtable.functions.columns import (
    audit_timestamp,
    canonical_json,
    fingerprint,
    normalized_text,
    parses_as_timestamp,
    status_symbol,
    strict_timestamp,
    to_number,
    truncate,
    utc_now,
)

__all__ = [
    "audit_timestamp",
    "canonical_json",
    "fingerprint",
    "normalized_text",
    "parses_as_timestamp",
    "status_symbol",
    "strict_timestamp",
    "to_number",
    "truncate",
    "utc_now",
]

from voltlake.functions.columns import (
    canonical_json,
    content_hash,
    hour_of,
    local_day,
    normalized_key,
    period_of,
    share_pct,
    zero_if_null,
)

__all__ = [
    "canonical_json",
    "content_hash",
    "hour_of",
    "local_day",
    "normalized_key",
    "period_of",
    "share_pct",
    "zero_if_null",
]

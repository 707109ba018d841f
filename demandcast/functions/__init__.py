"""Column -> Column building blocks (all native Spark expressions, no UDFs)."""

from demandcast.functions.calendar import (
    as_timestamp_ntz,
    iso_week,
    month_of,
    require_not_null,
    week_start,
)
from demandcast.functions.hashing import (
    DEFAULT_SALT,
    digest_to_hex,
    hmac_pads,
    hmac_sha256_digest,
    hmac_sha256_hex,
)
from demandcast.functions.quantiles import clip_lower, half_blend

__all__ = [
    "DEFAULT_SALT",
    "as_timestamp_ntz",
    "clip_lower",
    "digest_to_hex",
    "half_blend",
    "hmac_pads",
    "hmac_sha256_digest",
    "hmac_sha256_hex",
    "iso_week",
    "month_of",
    "require_not_null",
    "week_start",
]

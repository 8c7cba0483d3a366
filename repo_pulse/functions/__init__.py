"""Column-level helpers: JSON access, safe casts, time arithmetic, money.

All are built-in Spark expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from repo_pulse.functions.json import (
    json_scalar,
    json_scalar_in_variant,
    label_names_csv,
    parse_payload,
)
from repo_pulse.functions.scalars import (
    days_between,
    discounted_amount,
    hours_between,
    parse_iso_ts,
    safe_bigint,
    safe_bool,
    safe_timestamp,
    strict_greatest,
    strict_least,
    to_ntz,
)

__all__ = [
    "json_scalar",
    "json_scalar_in_variant",
    "label_names_csv",
    "parse_payload",
    "days_between",
    "discounted_amount",
    "hours_between",
    "parse_iso_ts",
    "safe_bigint",
    "safe_bool",
    "safe_timestamp",
    "strict_greatest",
    "strict_least",
    "to_ntz",
]

"""Column expressions shared by the operators."""

from watchspan.functions.keys import surrogate_key
from watchspan.functions.ratios import pct_change, safe_ratio, z_score
from watchspan.functions.scopes import (
    is_high_risk,
    is_readonly,
    scope_family,
    scope_service,
    scope_service_census,
    scope_suffix,
)
from watchspan.functions.times import as_literal, day_of_week, event_hour, max_literal, parse_ts

__all__ = [
    "as_literal", "day_of_week", "event_hour", "is_high_risk", "is_readonly", "max_literal", "parse_ts",
    "pct_change", "safe_ratio", "scope_family", "scope_service", "scope_service_census", "scope_suffix",
    "surrogate_key", "z_score",
]

from finlake.functions.columns import (
    base_name,
    col,
    concat_codes,
    fiscal_type,
    first_char,
    month_start,
    null_tokens,
    parse_date,
    path_join,
    path_part,
    period_digits,
    route_feed,
    strict_long,
    trend_scenario,
)

__all__ = [
    "base_name",
    "col",
    "concat_codes",
    "fiscal_type",
    "first_char",
    "month_start",
    "null_tokens",
    "parse_date",
    "path_join",
    "path_part",
    "period_digits",
    "route_feed",
    "strict_long",
    "trend_scenario",
]

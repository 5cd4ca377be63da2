"""Column expressions. Everything here stays in the JVM; there are no Python UDFs."""

from feedkit.functions.arrays import (
    all_equal,
    common_elements,
    contains_all,
    flatten_once,
    maps_equal,
    sequences_equal,
)
from feedkit.functions.scalars import (
    SCORE_WEIGHTS,
    abbrev_initial,
    abbrev_last,
    clean_html,
    escape_quotes,
    format_date_sql,
    game_id,
    is_number,
    lacks_text,
    month_number,
    norm_nan,
    overtime_periods,
    parse_date,
    same_on_error,
    venue_is,
    weighted_score,
)

__all__ = [
    "SCORE_WEIGHTS",
    "abbrev_initial",
    "abbrev_last",
    "all_equal",
    "clean_html",
    "common_elements",
    "contains_all",
    "escape_quotes",
    "flatten_once",
    "format_date_sql",
    "game_id",
    "is_number",
    "lacks_text",
    "maps_equal",
    "month_number",
    "norm_nan",
    "overtime_periods",
    "parse_date",
    "same_on_error",
    "sequences_equal",
    "venue_is",
    "weighted_score",
]

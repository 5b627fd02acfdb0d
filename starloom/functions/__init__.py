"""Column -> Column functions (all JVM-side built-ins, no Python UDF)."""

from .arith import (coalesce_zero, deltas, ratio_or_zero, safe_add, safe_divide,
                    safe_subtract, width_bucket)
from .dates import (date_key, date_parts, day_name, iso_day_of_week, month_name,
                    season_label, season_start_year)
from .geo import haversine_distance
from .keys import check_hashable, surrogate_key
from .logic import (case, clock_to_minutes, like_any, like_classify, quartile_label,
                    regex_guarded_cast, row_argmax, threshold_count, thresholds_from_data, tier,
                    two_side_outcome)
from .text import slugify, slugify_col, strip_label
from .web import url_host, url_parameter, url_path

__all__ = [
    "coalesce_zero", "deltas", "ratio_or_zero", "safe_add", "safe_divide", "safe_subtract",
    "width_bucket", "date_key", "date_parts", "day_name", "iso_day_of_week", "month_name",
    "season_label", "season_start_year", "haversine_distance", "check_hashable",
    "surrogate_key", "case", "clock_to_minutes", "like_any", "like_classify",
    "regex_guarded_cast", "row_argmax", "threshold_count", "tier", "two_side_outcome",
    "quartile_label", "thresholds_from_data",
    "slugify", "slugify_col", "strip_label", "url_host", "url_parameter", "url_path",
]

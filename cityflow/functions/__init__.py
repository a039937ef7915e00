"""Column expressions and driver-side parameter helpers."""

from .calendar import report_window, rolling_window
from .scalar import (fixed_text, hour_label, hour_text, matching, midpoint, normalise_name, repaired_sign,
                     row_greatest, row_mean, row_total, safe_ratio, sanitise_name)

__all__ = ["report_window", "rolling_window", "fixed_text", "hour_label", "hour_text", "matching", "midpoint",
           "normalise_name", "repaired_sign", "row_greatest", "row_mean", "row_total", "safe_ratio", "sanitise_name"]

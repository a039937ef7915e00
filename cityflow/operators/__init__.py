"""DataFrame -> DataFrame operators; compose with ``df.transform``."""

from .aggregate import daily_fact, daily_stats, peak_slot, slot_counts, top_per_group
from .calendar import date_spine, dim_date, dim_date_range, numbers, spine_between, with_date_key, with_dim
from .clean import coerce, keep_dates, keep_range, mask_outside, repair_sign, require, union_conformed
from .exact import exact_totals
from .fill import fill_ordered, with_file_order_key, with_order_key
from .nested import parse_json, rows_as_json, zip_to_rows
from .numbering import with_dense_number
from .quality import (alert_rows, between, checked_write, failed_names, latest, not_null, report_text, rule_mask, run_suite,
                      summarise)
from .series import daily_change, densify
from .widen import fold_union, full_fold, ratio, row_greatest, row_mean, row_total, suffix_columns, widen
from .zones import assign_zones, zone_table

__all__ = [n for n in dir() if not n.startswith("_")]

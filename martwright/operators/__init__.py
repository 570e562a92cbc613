"""Table-level operators: thresholds, distinct, appends, shares, ordered scans."""

from martwright.operators.multiplicity import match_counts, repeated, with_matches
from martwright.operators.positions import with_positions
from martwright.operators.skew import heavy_keys, salted_join
from martwright.operators.table_ops import (append_rows, distinct_values, event_share,
                                            neighbour_diff, record_count, rows_at_or_below,
                                            take_until, threshold_summary)

__all__ = [
    "append_rows", "distinct_values", "event_share", "heavy_keys", "match_counts", "neighbour_diff",
    "record_count", "repeated", "rows_at_or_below", "salted_join", "take_until", "threshold_summary",
    "with_matches", "with_positions",
]

"""DataFrame -> DataFrame building blocks."""

from portolan.operators.aggregate import (first_values, mean_and_first, pivot_loss_report, pivot_sum,
                                          sum_by, two_level_mean)
from portolan.operators.colocated import join_colocated, save_colocated
from portolan.operators.joins import decode, lookup_join, unique_on
from portolan.operators.merge import latest_deliveries, merge_deliveries
from portolan.operators.quality import (DataQualityError, cast_loss_report, duplicate_key_report,
                                        null_key_report, orphan_report, raise_on_failure,
                                        row_count_report, sql_check_report, table_counts)
from portolan.operators.uniqueness import incremental_key_report, key_bitmaps

__all__ = [
    "DataQualityError", "cast_loss_report", "decode", "duplicate_key_report", "first_values",
    "incremental_key_report", "join_colocated", "key_bitmaps", "latest_deliveries", "lookup_join", "mean_and_first", "merge_deliveries",
    "null_key_report", "orphan_report", "pivot_loss_report", "pivot_sum", "raise_on_failure", "row_count_report", "save_colocated",
    "sql_check_report", "sum_by", "table_counts",
    "two_level_mean", "unique_on",
]

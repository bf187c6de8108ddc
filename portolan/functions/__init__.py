"""Column -> Column helpers."""

from portolan.functions.columns import (convert_types, drop_columns, fill_zero, lenient_cast,
                                        refactor_values, rename_columns)
from portolan.functions.dates import (convert_day_numbers, date_difference, date_parts,
                                      date_to_day_number, day_number_to_date, day_number_to_iso,
                                      iso_date)
from portolan.functions.text import clean_label, label_fallback, title_case

__all__ = [
    "clean_label", "convert_day_numbers", "convert_types", "date_difference", "date_parts",
    "date_to_day_number", "day_number_to_date", "day_number_to_iso", "drop_columns", "fill_zero",
    "iso_date", "label_fallback", "lenient_cast", "refactor_values", "rename_columns", "title_case",
]

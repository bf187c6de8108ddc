"""Sources and sinks: typed reads, partitioned writes, lookups, text extraction."""

from portolan.sources.io import load_data, overwrite_partitions, read_partitioned, save_data
from portolan.sources.labels import extract_pairs, label_entries, lookup_from_entries, number_lines
from portolan.sources.lookups import (country_lookup, mode_lookup, port_lookup, read_lookup,
                                      state_lookup, visa_lookup)

__all__ = [
    "country_lookup", "extract_pairs", "label_entries", "load_data", "lookup_from_entries", "mode_lookup", "number_lines",
    "overwrite_partitions", "port_lookup", "read_lookup", "read_partitioned", "save_data",
    "state_lookup", "visa_lookup",
]
